"""Corpus packing on Spark DataFrames: read, tokenize, mix, re-cut and export text corpora.

Start at `corploom.plans.pack`. This file imports nothing, so that Python workers load only what
their functions need.
"""
