"""Deterministic row keys and shuffle keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions.arithmetic import div

_COPIES_PER_BLOCK = 10_000


def shuffle_key(seed: int, *parts: Column | str) -> Column:
    """md5 of `seed:part:...`: sorting by it is a permutation fixed by seed and row key."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def with_content_keys(df: DataFrame, columns: Sequence[str], key: str = "row_key") -> DataFrame:
    """Unique string keys for rows that have none: md5 of the content, then a copy number.

    Rows of equal content cannot be told apart, so they are counted by their digest (with map-side
    combine), which moves each content once, and laid out again. Contents with more copies than a
    block are laid out block by block, so that no task holds all copies of a frequent row.
    """
    is_text = len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.StringType)
    content = F.col(columns[0]) if is_text else F.to_json(F.struct(*columns))
    counted = (
        df.groupBy(F.md5(content).alias("_digest"), F.octet_length(content).alias("_size"))
        .agg(F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
        .select("_row.*", "_digest", "_copies")
    )
    last_block = div(F.col("_copies") - 1, _COPIES_PER_BLOCK)
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), last_block))
    few = counted.where(F.col("_copies") <= _COPIES_PER_BLOCK)
    many = counted.where(F.col("_copies") > _COPIES_PER_BLOCK).withColumn("_block", blocks)
    many = many.repartition(F.col("_digest"), F.col("_block"))
    spread = few.withColumn("_block", F.lit(0).cast("bigint")).unionByName(many)
    first = F.col("_block") * _COPIES_PER_BLOCK
    last = F.least(F.col("_copies"), first + _COPIES_PER_BLOCK) - 1
    numbered = spread.withColumn("_copy", F.explode(F.sequence(first, last)))
    return numbered.select(*columns, F.concat_ws(":", "_digest", "_copy").alias(key))
