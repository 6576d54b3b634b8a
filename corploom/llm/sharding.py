"""Proportional stratified interleaving: shards of equal row counts that all match the mixture.

Rows are shuffled by seed within their source, ranked there, and lined up by fractional rank
(rank + 1/2) / rows of the source. Any stretch of that order holds every source in proportion, so
the order is cut into equal stretches, one a shard.

Neither rank nor place needs a sort in one task: hash buckets within a source, and buckets of
the fractional rank, are counted with partial aggregation, and a row adds the count before its
bucket to its place in the bucket. Buckets are evenly filled however large a source is. Only
bucket counts meet in one task, a number that follows the shuffle partitions, not the rows.

Null ids, texts and sources take part (null is a source of its own). Repeated rows get places of
their own; which of two equal rows gets which makes no difference. An empty table gives an empty
one. Columns named as the results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.llm.text import keeps_columns
from corploom.operators.running_totals import default_bits, hash_bucket

SEED = 101


def shuffle_key(seed: int, row_id: Column, text: Column) -> Column:
    """md5 that fixes a row's place in its source; rows equal in id and text share it."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string"), F.md5(text)))


@keeps_columns
def interleave(
    df: DataFrame,
    shards: int,
    source: str = "source",
    row_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    bits: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Adds `shard` (int, from 0) and `slot` (bigint, gapless from 0 in each shard). Counts of
    shards differ by one at most, and those of a source by a few at most. `keep` names the
    columns to go on with: texts that the result does not need are then not moved."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    bits = default_bits(df.sparkSession) if bits is None else bits
    keyed = df.drop("shard", "slot").withColumns(
        {
            "_source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")),
            "_key": shuffle_key(seed, F.col(row_id), F.col(text)),
        }
    )
    kept = [c for c in df.columns if c not in ("shard", "slot")] if keep is None else [*keep]
    keyed = keyed.select(
        *kept, "_source", "_key", hash_bucket(F.col("_key"), bits).alias("_bucket")
    )

    run = ["_source", "_bucket"]
    upto = Window.partitionBy("_source").orderBy("_bucket")
    sizes = keyed.groupBy(*run).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(
        *run,
        (F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_before"
        ),
        F.sum("_n").over(Window.partitionBy("_source")).alias("_rows"),
    )
    in_bucket = F.row_number().over(Window.partitionBy(*run).orderBy("_key"))
    ranked = (
        keyed.withColumn("_in", in_bucket)
        .join(sizes, run)
        .withColumn("_share", (F.col("_before") + F.col("_in") - F.lit(0.5)) / F.col("_rows"))
        .drop("_in", "_before", "_rows", "_bucket")
        .withColumn("_slice", F.floor(F.col("_share") * (1 << bits)).cast("int"))
    )

    counts = ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select(
        "_slice",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    order = Window.partitionBy("_slice").orderBy("_share", "_source", "_key")
    placed = (
        ranked.withColumn("_in", F.row_number().over(order))
        .join(counts, "_slice")
        .withColumn("_pos", F.col("_before") + F.col("_in") - 1)
        .withColumn("shard", div(F.col("_pos") * shards, F.col("_rows")).cast("int"))
    )
    # The first place of a shard is its number times rows over shards, rounded up.
    first = div(F.col("shard") * F.col("_rows") + (shards - 1), shards)
    return placed.withColumn("slot", F.col("_pos") - first).drop(
        "_source", "_key", "_slice", "_share", "_in", "_before", "_rows", "_pos"
    )
