"""Operators for training data: cleaning, deduplication, decontamination, encoding, sharding.

Nothing else in the library imports this subpackage.
"""
