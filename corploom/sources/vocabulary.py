"""Vocabulary tables: token_id int, token binary, size int, place bigint (order in the file)."""

from __future__ import annotations

import ast
import lzma

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the vocabulary format.
END_OF_TEXT_ID = 0
END_OF_TEXT = b"<|endoftext|>"

# What a vocabulary may hold, entries and 64 bytes for each of them, as it goes to every worker.
MAX_VOCABULARY_BYTES = 256 << 20
_ENTRY_BYTES = 64


@F.arrow_udf(T.BinaryType())
def _literal_bytes(literals: pa.Array) -> pa.Array:
    values = [ast.literal_eval(s) if s is not None else None for s in literals.to_pylist()]
    return pa.array([v.encode() if isinstance(v, str) else v for v in values], pa.binary())


@F.arrow_udf(T.StringType())
def _unpack_xz(contents: pa.Array) -> pa.Array:
    return pa.array([lzma.decompress(c.as_py()).decode() for c in contents], pa.string())


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Read lines `id literal byte_size` from a plain, .gz or .xz file.

    The literal is a Python string (taken as UTF-8) or bytes literal. A byte size that does not
    fit the literal fails the job.
    """
    if path.endswith(".xz"):
        whole = spark.read.format("binaryFile").load(path).select(_unpack_xz("content").alias("value"))
    else:
        whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\r?\n")).alias("place", "line"))
    pattern = r"^(\d+) +(.*\S) +(\d+)\s*$"
    entries = lines.where(F.col("line").rlike(r"\S")).select(
        F.regexp_extract("line", pattern, 1).cast("int").alias("token_id"),
        _literal_bytes(F.regexp_extract("line", pattern, 2)).alias("token"),
        F.regexp_extract("line", pattern, 3).cast("int").alias("size"),
        F.col("place").cast("bigint").alias("place"),
    )
    message = F.concat(
        F.lit("vocabulary id "), F.col("token_id").cast("string"), F.lit(": token size differs from "),
        F.col("size").cast("string"),
    )
    fits = F.octet_length("token") == F.col("size")
    checked = entries.withColumn("token", F.when(fits, F.col("token")).otherwise(F.raise_error(message)))
    return vocabulary_view(checked)


def vocabulary_view(entries: DataFrame) -> DataFrame:
    """One row per id, with id 0 set to the end-of-text token.

    The last line of an id gives its token, the first its place; id 0 comes last if missing.
    """
    if "place" not in entries.columns:
        entries = entries.withColumn("place", F.col("token_id").cast("bigint"))
    per_id = entries.groupBy("token_id").agg(
        F.max_by("token", "place").alias("token"), F.min("place").alias("place")
    )
    last = F.lit(1 << 62).cast("bigint")
    zero = entries.where(F.col("token_id") == END_OF_TEXT_ID).agg(
        F.lit(END_OF_TEXT_ID).alias("token_id"),
        F.lit(END_OF_TEXT).alias("token"),
        F.coalesce(F.min("place"), last).alias("place"),
    )
    view = per_id.where(F.col("token_id") != END_OF_TEXT_ID).unionByName(zero)
    return view.select("token_id", "token", F.octet_length("token").alias("size"), "place")


def _bounded_rows(vocab: DataFrame, max_bytes: int) -> list:
    """The table on the driver, computed once. `spark.driver.maxResultSize` bounds what may arrive
    there, `max_bytes` what may go on to the workers."""
    rows = vocab.select("token_id", "token").collect()
    held = sum(len(row.token) + _ENTRY_BYTES for row in rows)
    if held > max_bytes:
        raise ValueError(f"the vocabulary takes {held} bytes; max_bytes is {max_bytes}")
    return rows


def encoding_table(vocab: DataFrame, max_bytes: int = MAX_VOCABULARY_BYTES) -> dict[bytes, int]:
    """Token -> id; of equal tokens the id placed last wins."""
    place = "place" if "place" in vocab.columns else "token_id"
    winners = vocab.groupBy("token").agg(F.max_by("token_id", place).alias("token_id"))
    return {bytes(r.token): r.token_id for r in _bounded_rows(winners, max_bytes)}


def decoding_table(vocab: DataFrame, max_bytes: int = MAX_VOCABULARY_BYTES) -> dict[int, bytes]:
    """Id -> token."""
    return {r.token_id: bytes(r.token) for r in _bounded_rows(vocab, max_bytes)}
