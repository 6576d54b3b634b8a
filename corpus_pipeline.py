"""The corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage to the
shared folder and reads it back as the next one's documents, so a lost executor costs a re-read.
Rows with nulls, repeated rows and further columns go through every stage as its operator states;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm.batches import small_batches
from corploom.llm.bpe import encode
from corploom.llm.decontamination import without_leaks
from corploom.llm.near_duplicates import one_per_class
from corploom.llm.pii import fit_model, redact, with_pii
from corploom.llm.quality import with_quality
from corploom.staging import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return with_quality(docs, result="_quality").where(F.col("_quality.kept")).drop("_quality")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id."""
    small_batches(spark)
    return one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark."""
    small_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of personal data; `n_chars` follows."""
    small_batches(spark)
    found = with_pii(docs, fit_model(docs), result="_pii")
    clean = redact(found, spans="_pii").drop("_pii")
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts: `ids` as little-endian unsigned 32-bit integers."""
    small_batches(spark)
    import public_tokenizers

    coded = encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "lang", "source", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids"
    )


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("pii", redact_pii),
    ("bpe", encode_texts),
]

# The trees behind the redaction are no SQL; the tests state the result by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
