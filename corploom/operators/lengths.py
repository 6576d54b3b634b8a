"""Length distribution: groups of like length, cut into subchunks, shuffled on two levels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.functions.keys import shuffle_key
from corploom.operators.running_totals import default_bits, hash_bucket, with_running_totals
from corploom.staging import stage

MIN_ROWS = 4096
MIN_SUBCHUNK = 1024
LENGTH_SEED = 102
_BROADCAST_GROUPS = 100_000
_ROW_BITS = 20


def _partition_gcd(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    divisor = 0
    for batch in batches:
        if batch.num_rows:
            divisor = int(np.gcd(divisor, np.gcd.reduce(batch.column(0).to_numpy())))
    yield pa.record_batch({"gcd": pa.array([divisor], pa.int64())})


def length_gcd(df: DataFrame, length: str = "len") -> DataFrame:
    """Greatest common divisor of all lengths: one value a partition, then one in all."""
    per_partition = df.select(F.col(length).cast("bigint")).mapInArrow(_partition_gcd, "gcd bigint")
    return per_partition.repartition(1).mapInArrow(_partition_gcd, "gcd bigint")


def length_histogram(df: DataFrame, length: str = "len") -> DataFrame:
    return df.groupBy(length).agg(F.count(F.lit(1)).alias("n_rows"))


def length_stats(df: DataFrame, length: str = "len") -> DataFrame:
    """One row: rows, total length and gcd. The gcd only needs each length once."""
    histogram = length_histogram(df, length)
    totals = histogram.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n_rows") * F.col(length)), F.lit(0)).alias("total"),
    )
    return totals.withColumn("gcd", length_gcd(histogram, length).scalar())


def rank_by_length(df: DataFrame, length: str = "len", position: str = "pos") -> DataFrame:
    """Adds `rn` and `cum` (length before the row) in order of falling length, then position.

    Runs of 4,096 neighbouring lengths, then one length, then blocks of positions: a length
    that a third of all rows share is still ranked in many tasks.
    """
    runs = df.withColumns(
        {
            "_class": -F.shiftright(length, 12),
            "_falling": -F.col(length),
            "_block": F.shiftright(position, 22),
        }
    )
    levels = [["_class"], ["_falling"], ["_block"]]
    ranked = with_running_totals(runs, levels, [position], {"cum": length}, position="rn")
    return ranked.drop("_class", "_falling", "_block")


def stage_ranked(ranked: DataFrame) -> DataFrame:
    """Stage with runs of neighbouring ranks in one file, so that groups combine before a shuffle."""
    return stage(ranked.repartition(F.shiftright("rn", 12)), "by-length")


def _divisors(number: int) -> list[int]:
    found, rest, prime = [1], number, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        power, multiples = 1, found
        while rest % prime == 0:
            rest //= prime
            power *= prime
            multiples = multiples + [d * power for d in found]
        found = multiples
        prime += 1
    return sorted(found)


def group_size_candidates(n_rows: int, total: int, gcd: int, min_rows: int) -> list[int]:
    """Byte budgets for a group: divisors of the total from max(gcd, min_rows) to half of it.

    Up to `min_rows` times the mean length the row rule alone sets the groups (rows fall in
    length, so bytes never lag behind), all such budgets give the same groups and the smallest
    one stands for them.
    """
    sizes = [d for d in _divisors(total) if max(gcd, min_rows) <= d <= total // 2] if total else []
    by_rows = [d for d in sizes if d * n_rows <= min_rows * total]
    return by_rows[:1] + sizes[len(by_rows) :]


def group_number(budget: Column, min_rows: int) -> Column:
    """Group by bytes, but never ahead of `min_rows` rows a group."""
    by_bytes = div(F.col("cum"), budget)
    return F.least(by_bytes, div(F.col("rn"), min_rows))


def candidate_groups(ranked: DataFrame, budgets: list[int], min_rows: int, length: str = "len") -> DataFrame:
    """Rows and length of each group for each budget, a short last group joined to the one before.

    Budgets are tried on runs of equal length, not on rows: within a run, ranks and lengths before
    the rows grow by equal steps, so the rank at which a group begins is a quotient.
    """
    runs = ranked.groupBy(F.col(length).cast("bigint").alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("rn").alias("rn"), F.min("cum").alias("cum")
    )
    tried = runs.withColumn("budget", F.explode(F.lit(budgets).cast("array<bigint>")))
    end = F.col("rn") + F.col("n")
    last_cum = F.col("cum") + F.col("step") * (F.col("n") - 1)
    last = F.least(div(last_cum, F.col("budget")), div(end - 1, min_rows))
    spans = tried.withColumn(
        "group_id", F.explode(F.sequence(group_number(F.col("budget"), min_rows), last))
    )

    def begin(group: Column) -> Column:
        """First rank of the run in the group or beyond; the end of the run if there is none."""
        missing = group * F.col("budget") - F.col("cum")
        steps = F.when(F.col("step") > 0, div(missing + F.col("step") - 1, F.col("step")))
        by_bytes = F.when(missing <= 0, F.lit(0)).otherwise(F.coalesce(steps, F.col("n")))
        return F.least(end, F.greatest(F.col("rn"), F.col("rn") + by_bytes, group * min_rows))

    in_run = begin(F.col("group_id") + 1) - begin(F.col("group_id"))
    groups = (
        spans.select("budget", "group_id", "step", in_run.alias("n_rows"))
        .where(F.col("n_rows") > 0)
        .groupBy("budget", "group_id")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("n_rows") * F.col("step")).alias("total"))
    )
    last = groups.groupBy("budget").agg(
        F.max("group_id").alias("last_id"), F.max_by("n_rows", "group_id").alias("last_rows")
    )
    short = (F.col("last_rows") < min_rows) & (F.col("last_id") > 0)
    kept = F.when(short, F.col("last_id") - 1).otherwise(F.col("last_id"))
    merged = groups.join(last.select("budget", kept.alias("kept")), "budget").withColumn(
        "group_id", F.least("group_id", "kept")
    )
    return merged.groupBy("budget", "group_id").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total")
    )


def group_spread(groups: DataFrame) -> DataFrame:
    """Per budget: most minus least length of a group, number of groups, rows of the smallest."""
    return groups.groupBy("budget").agg(
        (F.max("total") - F.min("total")).alias("spread"),
        F.count(F.lit(1)).alias("n_groups"),
        F.min("n_rows").alias("smallest"),
    )


@dataclass(frozen=True)
class GroupPlan:
    """The chosen budget (None: one group), how many groups it gives and the smallest one's rows."""

    budget: int | None
    n_groups: int
    smallest: int
    min_rows: int


def choose_groups(ranked: DataFrame, min_rows: int = MIN_ROWS, length: str = "len") -> GroupPlan:
    """Budget with the least spread, the smaller one on ties; one group only if nothing else is left."""
    stats = length_stats(ranked, length).first()
    budgets = group_size_candidates(stats["n_rows"], stats["total"], stats["gcd"], min_rows)
    best = None
    if budgets:
        spread = group_spread(candidate_groups(ranked, budgets, min_rows, length))
        best = spread.orderBy(F.col("n_groups") == 1, "spread", "budget").first()
    if best is None:
        return GroupPlan(None, 1, stats["n_rows"], min_rows)
    return GroupPlan(best["budget"], best["n_groups"], best["smallest"], min_rows)


def assign_groups(ranked: DataFrame, plan: GroupPlan) -> DataFrame:
    if plan.budget is None:
        return ranked.withColumn("group_id", F.lit(0).cast("bigint"))
    number = group_number(F.lit(plan.budget), plan.min_rows)
    return ranked.withColumn("group_id", F.least(number, F.lit(plan.n_groups - 1)))


def assign_subchunks(grouped: DataFrame, plan: GroupPlan, min_subchunk: int = MIN_SUBCHUNK) -> DataFrame:
    """`sub_id`: runs of as many rows as the smallest group has, at least `min_subchunk`."""
    target = max(plan.smallest, min_subchunk)
    first = grouped.groupBy("group_id").agg(F.min("rn").alias("_first"))
    if plan.n_groups <= _BROADCAST_GROUPS:
        first = F.broadcast(first)
    sub = div(F.col("rn") - F.col("_first"), target)
    return grouped.join(first, "group_id").withColumn("sub_id", sub).drop("_first")


def shuffle_subchunks(
    df: DataFrame, keys: list[str], seed: int = LENGTH_SEED, largest: int | None = None
) -> DataFrame:
    """Subchunks in seeded order, and the rows inside each; `pos` is the new place of a row.

    Subchunks of more than a million rows (`largest`; None: of any size) are split by row key,
    so that no task sorts more of one.
    """
    bits = default_bits(df.sparkSession)
    row_bits = bits if largest is None else min(bits, (largest >> _ROW_BITS).bit_length())
    keyed = df.withColumns(
        {
            "_sub_key": shuffle_key(seed, "group_id", "sub_id"),
            "_row_key": shuffle_key(seed, *keys),
        }
    ).withColumns(
        {
            "_sub_bucket": hash_bucket(F.col("_sub_key"), bits),
            "_row_bucket": hash_bucket(F.col("_row_key"), row_bits),
        }
    )
    levels = [["_sub_bucket"], ["_sub_key", "group_id", "sub_id"]]
    levels += [["_row_bucket"]] if row_bits else []
    placed = with_running_totals(keyed, levels, ["_row_key", *keys])
    return placed.drop("_sub_key", "_row_key", "_sub_bucket", "_row_bucket")


def length_places(
    measured: DataFrame,
    keys: list[str],
    min_rows: int = MIN_ROWS,
    min_subchunk: int = MIN_SUBCHUNK,
    seed: int = LENGTH_SEED,
) -> DataFrame:
    """From `keys, pos, len` of each row its `group_id`, `sub_id` and new `pos`."""
    ranked = stage_ranked(rank_by_length(measured).drop("pos"))
    plan = choose_groups(ranked, min_rows)
    parts = assign_subchunks(assign_groups(ranked, plan), plan, min_subchunk)
    largest = max(plan.smallest, min_subchunk)
    return shuffle_subchunks(parts, keys, seed, largest).select(*keys, "len", "group_id", "sub_id", "pos")
