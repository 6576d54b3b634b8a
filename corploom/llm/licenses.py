"""License scans by diagonal voting.

Every rolling word k-gram of every text meets the k-grams of the license templates in a join on
their hash. A hit votes for the diagonal (place in the text minus place in the template) of its
template; diagonals side by side, as inserted or missing words leave them, are merged, and a
template is found where the merged diagonals hold enough of its k-grams. Hits are verified word
by word in the join, so a hash met by chance does not vote.

Phrases are templates of one gram: each of its places is reported.

Words are lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII. Votes
are taken per distinct text, so copies are no hot group; a diagonal has at most as many votes as
its template has words. Null and empty texts have no words and no labels. Repeated rows get equal
results; a column named as the result is replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.llm.text import keeps_columns, let, lower_ascii, range_of, whole

GRAM = 3  # words of a k-gram; hashes go over the first two, so that shorter phrases join as well
NEAR = 3  # diagonals this close belong together
COVERAGE = 0.6
MOST_BROADCAST = 1_000_000  # template grams sent to all tasks; more are joined by a shuffle


@dataclass(frozen=True)
class Template:
    label: str
    text: str


# Phrases are found as they stand, two or three words each.
PHRASES = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)
# Usual license notices and the opening words of license texts.
TEMPLATES = (
    Template("all-rights-reserved", "all rights reserved"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    Template(
        "gpl", "this work is licensed under the gnu general public license version 3"
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
)


def license_words(text: Column) -> Column:
    split = F.split(lower_ascii(whole(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(split, lambda w: w != "")


def grams_of(words: Column) -> Column:
    """One struct (pos, hash, gram) per word with another one after it; the last gram of a text
    has two words."""
    return F.transform(
        range_of(F.size(words) - 1),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(F.get(words, i), F.get(words, i + 1)).alias("hash"),
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("gram"),
        ),
    )


def template_grams(spark, phrases: Sequence[Template], templates: Sequence[Template]) -> DataFrame:
    """(template, label, phrase, tpos, of, hash, part): the grams that hits must equal or begin with."""
    rows = []
    for number, template in enumerate([*phrases, *templates]):
        words = template.text.split()
        size = len(words) if number < len(phrases) else GRAM
        if not 2 <= size <= GRAM or len(words) < size:
            raise ValueError(f"phrases have 2 to {GRAM} words, templates {GRAM} at least")
        for k in range(len(words) - size + 1):
            part = words[k : k + size]
            rows.append(
                (number, template.label, number < len(phrases), k, len(words) - size + 1, *part[:2],
                 " ".join(part), size)
            )
    schema = (
        "template int, label string, phrase boolean, tpos int, of int, a string, b string, "
        "part string, size int"
    )
    table = spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64("a", "b"))
    return F.broadcast(table) if len(rows) <= MOST_BROADCAST else table


def find_licenses(
    texts: DataFrame, text: str, key: str, phrases: Sequence[Template] = PHRASES,
    templates: Sequence[Template] = TEMPLATES, coverage: float = COVERAGE,
) -> DataFrame:
    """One row per `key` (a digest of the text) with a find: (key, places, base_labels, labels,
    score, spans). Spans are structs (label, first word, last word, coverage)."""
    known = template_grams(texts.sparkSession, phrases, templates)
    grams = let(license_words(F.col(text)), grams_of)
    hits = (
        texts.select(F.col(key), F.explode(grams).alias("g"))
        .select(key, "g.*")
        .join(known, "hash")
        .where(F.expr("startswith(gram || ' ', part || ' ')"))
    )
    voted = hits.groupBy(key, "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("votes"),
        F.min("pos").alias("first"),
        F.max(F.col("pos") + F.col("size") - 1).alias("last"),
        *[F.first(c).alias(c) for c in ("label", "phrase", "of")],
    )
    order = Window.partitionBy(key, "template").orderBy("diagonal")
    # A place of a phrase stands for itself, whatever stands next to it.
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR)
    merged = (
        voted.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "template", "_run")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("n"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            *[F.first(c).alias(c) for c in ("label", "phrase", "of")],
        )
        .withColumn("coverage", F.col("n") / F.col("of"))
        .where(F.col("coverage") >= coverage)
    )
    base = F.when(F.col("phrase"), F.col("label"))
    span = F.struct("label", "first", "last", "coverage", "phrase")
    return merged.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col("phrase"), F.col("first")))).alias("places"),
        F.sort_array(F.collect_set(base)).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.max("coverage").alias("score"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    )


@keeps_columns
def with_licenses(
    df: DataFrame, text: str = "text", result: str = "licenses", **options
) -> DataFrame:
    """Adds `result`: struct (n_words, places, base_labels, labels, score, spans)."""
    keyed = df.drop(result).withColumn("_key", F.md5(whole(F.col(text))))
    found = find_licenses(keyed.select("_key", text), text, "_key", **options)
    fields = ["places", "base_labels", "labels", "score", "spans"]
    found = found.select("_key", F.struct(*fields).alias("_found"))
    none = {"score": F.lit(0.0)}
    return (
        keyed.withColumn("_n", F.size(license_words(F.col(text))).cast("bigint"))
        .join(found, "_key", "left")
        .withColumn(
            result,
            F.struct(
                F.col("_n").alias("n_words"),
                *[
                    F.coalesce(F.col("_found")[f], none.get(f, F.array().cast(_TYPES.get(f, "array<string>")))).alias(f)
                    for f in fields
                ],
            ),
        )
        .drop("_key", "_n", "_found")
    )


_TYPES = {
    "places": "array<int>",
    "spans": "array<struct<label:string,first:int,last:int,coverage:double,phrase:boolean>>",
}
