"""Dense positions and running sums over a total order, without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MAX_BITS = 20  # five hex digits


def default_bits(spark: SparkSession) -> int:
    """Bucket bits that give some 16 to 32 hash buckets per shuffle partition, so that partitions
    are evenly filled. Results do not depend on it."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(_MAX_BITS, (16 * partitions - 1).bit_length())


def hash_bucket(hex_key: Column, bits: int) -> Column:
    """Leading `bits` of a hex digest as int: buckets in digest order, evenly filled."""
    leading = F.conv(F.substring(hex_key, 1, _MAX_BITS // 4), 16, 10).cast("int")
    # Never null, and known to be: joins on the bucket then need no filter that hashes again.
    return F.shiftright(F.coalesce(leading, F.lit(0)), _MAX_BITS - bits)


def with_running_totals(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    order: Sequence[Column | str],
    sums: dict[str, str] | None = None,
    position: str = "pos",
) -> DataFrame:
    """Number the rows from 0 and sum columns over all rows before each row.

    `levels` are columns that split the total order into ever finer runs: rows compare by the
    first level, then the second, and so on, then by `order` within the last level. Totals are
    built upwards with partial aggregation, their running sums downwards level by level, and
    every row adds the sum before its run to its place in the run. A window only ever holds the
    runs under one parent (or the rows of one finest run), so pick levels that keep those small.
    The totals join on the key the row window is partitioned by: if they are too large to
    broadcast, the rows still move once.
    """
    sums = sums or {}
    outs = [position, *sums]
    keys = [[name for level in levels[: i + 1] for name in level] for i in range(len(levels))]

    totals = [
        df.groupBy(*keys[-1]).agg(
            F.count(F.lit(1)).alias(position),
            *[F.sum(F.col(src).cast("bigint")).alias(out) for out, src in sums.items()],
        )
    ]
    for upper in reversed(keys[:-1]):
        totals.insert(0, totals[0].groupBy(*upper).agg(*[F.sum(o).alias(o) for o in outs]))

    before = None
    for depth, table in enumerate(totals):
        parents = keys[depth - 1] if depth else []
        runs = (
            Window.partitionBy(*parents)
            .orderBy(*levels[depth])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        table = table.select(
            *keys[depth], *[(F.sum(o).over(runs) - F.col(o)).alias(o) for o in outs]
        )
        if before is not None:
            upper = before.select(*parents, *[F.col(o).alias(f"_up_{o}") for o in outs])
            table = table.join(upper, parents).select(
                *keys[depth], *[(F.col(o) + F.col(f"_up_{o}")).alias(o) for o in outs]
            )
        before = table

    rows = Window.partitionBy(*keys[-1]).orderBy(*order)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {position: F.row_number().over(rows).cast("bigint") - 1}
    for out, src in sums.items():
        size = F.col(src).cast("bigint")
        local[out] = F.sum(size).over(so_far) - size
    base = before.select(*keys[-1], *[F.col(o).alias(f"_base_{o}") for o in outs])
    return (
        df.withColumns(local)
        .join(base, keys[-1])
        .withColumns({o: F.col(o) + F.col(f"_base_{o}") for o in outs})
        .drop(*[f"_base_{o}" for o in outs])
    )


def running_totals_by_position(
    df: DataFrame, sums: dict[str, str], position: str = "pos", block_bits: int = 12
) -> DataFrame:
    """Running sums for rows that already carry dense positions: runs of 2^block_bits rows."""
    return ranks_by_position(df, "_rank", position, sums, block_bits).drop("_rank")


def ranks_by_position(
    df: DataFrame,
    rank: str,
    position: str = "pos",
    sums: dict[str, str] | None = None,
    block_bits: int = 12,
) -> DataFrame:
    """Numbers the rows from 0 by their distinct positions, which may have gaps; with running sums."""
    blocks = {
        f"_block{i}": F.shiftright(F.col(position), block_bits * (3 - i)) for i in range(3)
    }
    leveled = df.withColumns(blocks)
    return with_running_totals(leveled, [[b] for b in blocks], [position], sums, position=rank).drop(*blocks)
