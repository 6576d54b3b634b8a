"""Row order as data: seeded shuffles and source order as dense positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.functions.keys import shuffle_key
from corploom.operators.running_totals import default_bits, hash_bucket, with_running_totals

SHUFFLE_SEED = 101


def shuffle_rows(
    df: DataFrame,
    keys: list[str],
    seed: int = SHUFFLE_SEED,
    within: list[str] | None = None,
    sums: dict[str, str] | None = None,
    position: str = "pos",
    bits: int | None = None,
) -> DataFrame:
    """Seeded shuffle: positions by md5 of seed and key, ties by key.

    `within` keeps rows of equal values together and in that order, so `within=["source_ord"]`
    shuffles each source on its own and lines the sources up. `sums` adds running sums in the
    new order, such as `{"start": "n_tokens"}`.
    """
    bits = default_bits(df.sparkSession) if bits is None else bits
    keyed = df.withColumn("_key", shuffle_key(seed, *keys))
    keyed = keyed.withColumn("_bucket", hash_bucket(F.col("_key"), bits))
    levels = [[w] for w in within or []] + [["_bucket"]]
    ordered = with_running_totals(keyed, levels, ["_key", *keys], sums, position)
    return ordered.drop("_key", "_bucket")


def write_order(df: DataFrame, *order: str) -> DataFrame:
    """Lay rows out in `order` over the output files: range partitions, each one sorted."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
