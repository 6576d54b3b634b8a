"""Cut ordered rows into shards by size, and write one file set per shard from inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.operators.running_totals import ranks_by_position, running_totals_by_position
from corploom.staging import stage

SHARD_BYTES = 500_000_000
_BLOCK_BITS = 16  # at most; see `_block_bits`
_LEAST_BITS = 8
_BLOCKS = 1 << 16
_BROADCAST_CUTS = 1_000_000
_STRETCH_ROWS = 1 << 16


def with_shards(
    staged: DataFrame,
    shard_bytes: int = SHARD_BYTES,
    size: str = "row_bytes",
    position: str = "pos",
    filled: bool = False,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """`shard`: bytes of all rows before, div `shard_bytes`; with `filled`, shards take whole rows until
    they exceed `shard_bytes`, see `filled_cuts`. Rows are never cut.

    `staged` is a table, as it is read twice: running sums need positions and sizes alone, and
    leave the cuts of each block of positions. Rows look their shard up there, so that they
    move only once, to the task that writes the shard. If several rows share a position, `sizes` has
    it once, with the size of all of them.
    """
    sizes = staged if sizes is None else sizes
    rows, held = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    bits = _block_bits(rows, held // shard_bytes)
    if filled:
        cuts = filled_cuts(sizes, shard_bytes, size, position)
        after = cuts.select((F.col("shard") - 1).alias("shard"), (F.col("since") - 1).alias("until"))
        cuts = cuts.join(after, "shard", "left").withColumn("until", F.coalesce("until", F.lit(rows - 1)))
        first, last = (F.shiftright(c, bits) for c in ("since", "until"))
        cuts = cuts.withColumn("_block", F.explode(F.sequence(first, last)))
    else:
        summed = running_totals_by_position(sizes.select(position, size), {"before": size}, position)
        block, shard = F.shiftright(position, bits), div(F.col("before"), shard_bytes)
        cuts = summed.groupBy(block.alias("_block"), shard.alias("shard")).agg(F.min(position).alias("since"))
    return _look_up(staged, cuts, bits, _fits(rows, bits, held // shard_bytes), position)


def _fits(rows: int, bits: int, shards: int) -> bool:
    """Each block has a cut, and each shard that begins in it adds one at most."""
    return (rows >> bits) + shards + 1 <= _BROADCAST_CUTS


def _block_bits(rows: int, shards: int) -> int:
    """Bits of a position within its block. Each row reads all cuts of its block, of which there may be
    one a row, so blocks are small: as small as some 65,000 of them allow if their cuts go to all
    tasks, else the smallest."""
    least = min(_LEAST_BITS, _BLOCK_BITS)
    bits = min(_BLOCK_BITS, max(least, (rows // _BLOCKS).bit_length()))
    return bits if _fits(rows, bits, shards) else least


def _look_up(staged: DataFrame, cuts: DataFrame, bits: int, few: bool, position: str) -> DataFrame:
    """Adds the `shard` of the last cut at or before each row; `cuts` has those of each block."""
    cuts = cuts.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("since", "shard"))).alias("_cuts"))
    if few:
        cuts = F.broadcast(cuts)
    reached = F.filter("_cuts", lambda cut: cut["since"] <= F.col(position))
    found = staged.withColumn("_block", F.shiftright(position, bits)).join(cuts, "_block")
    return found.withColumn("shard", F.element_at(reached, -1)["shard"]).drop("_block", "_cuts")


def filled_cuts(
    sizes: DataFrame, shard_bytes: int = SHARD_BYTES, size: str = "row_bytes", position: str = "pos"
) -> DataFrame:
    """`shard, since, bytes_before` of shards that take whole rows until they exceed `shard_bytes`,
    each counting anew: the next shard begins at the first row with more than `shard_bytes` more
    bytes before it than the shard's first row.

    Where a shard begins depends on all shards before it. Every row points to the row at
    which the shard after it would begin, were it a shard's first. A window of `shard_bytes` bytes of
    the stream holds at most one beginning, and no chain of pointers jumps over two windows with
    rows, so it enters every group of two. Pointers to the next group are joined with
    themselves, which doubles their reach and leaves half of the groups, until one
    pointer reaches the end; backwards, the beginnings found so far take those pointers to find
    the ones between. All joins are by position, and rounds halve what they read.

    Sizes must be positive; positions dense. An empty table gives no shards.
    """
    rows, total = sizes.agg(F.count(F.lit(1)), F.sum(size)).first()
    summed = running_totals_by_position(sizes.select(position, size), {"before": size}, position)
    starts = summed.select(F.col(position).alias("pos"), "before")
    if not rows:
        return starts.select(F.lit(0).cast("bigint").alias("shard"), F.col("pos").alias("since"), "before")
    starts = stage(starts, "starts")
    pointers = stage(_next_starts(starts, shard_bytes, max(1, _STRETCH_ROWS * total // rows)), "pointers")

    # Windows with rows are numbered without a gap; there are at most as many as full shards.
    window = div(F.col("before"), shard_bytes)
    windows = ranks_by_position(starts.select(window.alias("window")).distinct(), "rank", "window")
    windows = windows.select("window", F.shiftright("rank", 1).alias("group"))
    if total // shard_bytes < _BROADCAST_CUTS:
        windows = F.broadcast(windows)
    placed = starts.withColumn("window", window).join(windows, "window").select("pos", "group")
    first = stage(placed.join(pointers, "pos"), "first")  # pos, group, next
    onward = first.select(F.col("pos").alias("next"), F.col("group").alias("next_group"), F.col("next").alias("second"))
    stays = F.col("next_group") == F.col("group")
    level = first.join(onward, "next", "left").select(
        "pos",
        "group",
        F.when(stays, F.col("second")).otherwise(F.col("next")).alias("to"),
        F.when(stays, F.col("next")).alias("inner"),
    )
    inner = stage(level, "jumps")
    levels = [inner.select("pos", "group", "to")]
    groups = inner.agg(F.max("group")).first()[0] + 1
    while 1 << (len(levels) - 1) < groups:
        reach = 1 << len(levels)
        now = levels[-1]
        further = now.select(F.col("pos").alias("to"), F.col("to").alias("further"))
        jumped = now.where(F.col("group") % reach == 0).join(further, "to", "left")
        levels.append(stage(jumped.select("pos", "group", F.col("further").alias("to")), "jumps"))

    few = total // shard_bytes < _BROADCAST_CUTS
    begun = starts.where("pos = 0").select("pos")

    def taken(jumps: DataFrame, column: str) -> DataFrame:
        asked = F.broadcast(begun) if few else begun
        return jumps.where(F.col(column).isNotNull()).join(asked, "pos").select(F.col(column).alias("pos"))

    for jumps in reversed(levels):
        begun = stage(begun.unionByName(taken(jumps, "to")), "begun")
    begun = ranks_by_position(begun.unionByName(taken(inner, "inner")), "shard")
    begun = starts.join(F.broadcast(begun) if few else begun, "pos")
    return stage(begun.select("shard", F.col("pos").alias("since"), "before"), "cuts")


def _next_starts(starts: DataFrame, shard_bytes: int, stretch: int) -> DataFrame:
    """`pos, next`: the first row with more than `shard_bytes` more bytes before it, null if none.

    Row starts and the places asked for are merged in stretches of the stream of `stretch` bytes, which
    hold some `_STRETCH_ROWS` rows. What a stretch does not answer, the next one with rows does.
    """
    asked = starts.select((F.col("before") + shard_bytes).alias("at"), F.col("pos").alias("asks"), F.lit(None).cast("bigint").alias("starts"))
    begins = starts.select(F.col("before").alias("at"), F.lit(None).cast("bigint").alias("asks"), F.col("pos").alias("starts"))
    merged = asked.unionByName(begins).withColumn("stretch", div(F.col("at"), stretch))
    # From the end to the start; a row that starts right at an asked place is not beyond it.
    after = Window.partitionBy("stretch").orderBy(F.desc("at"), F.col("asks").isNull())
    after = after.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = merged.withColumn("next", F.min("starts").over(after)).where(F.col("asks").isNotNull())
    firsts = merged.groupBy("stretch").agg(F.min("starts").alias("first"))
    later = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("stretch", F.min("first").over(later).alias("later"))
    joined = found.join(firsts, "stretch")
    return joined.select(F.col("asks").alias("pos"), F.coalesce("next", "later").alias("next"))


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("row_bytes").alias("n_bytes")
    )


def in_shards(sharded: DataFrame, *order: str) -> DataFrame:
    """All rows of a shard in one partition, in order (of `pos` unless told otherwise)."""
    return sharded.repartition("shard").sortWithinPartitions("shard", *(order or ("pos",)))


def shard_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of sorted batches that belong to one shard."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield int(shards[a]), batch.slice(a, b - a)


def each_shard(
    batches: Iterator[pa.RecordBatch], start: Callable[[int], object]
) -> Iterator[pa.RecordBatch]:
    """Feed each shard to a writer made by `start`; its `finish` gives report rows in batches."""
    shard, writer = None, None
    for number, run in shard_runs(batches):
        if number != shard:
            if writer is not None:
                yield from writer.finish()
            shard, writer = number, start(number)
        writer.add(run)
    if writer is not None:
        yield from writer.finish()
