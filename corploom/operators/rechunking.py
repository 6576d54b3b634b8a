"""Re-cut an ordered token stream into rows of a fixed number of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.functions.packed_ids import ID_BYTES, id_count, pack_ids, unpack_ids
from corploom.operators.running_totals import running_totals_by_position

CHUNK_SIZE = 2048
SPLITS = 30
PAD_ID = 0
_BROADCAST_SPLITS = 50_000


def with_splits(df: DataFrame, splits: int = SPLITS, counted: DataFrame | None = None) -> DataFrame:
    """`split_id`: runs of `rows div splits` rows by `pos`, so at most 2 * splits - 1 runs.

    Fewer rows than splits make one run. `counted` is a table with as many rows that is cheaper
    to count, such as the stage that `df` was ordered from.
    """
    if splits == 1:
        return df.withColumn("split_id", F.lit(0).cast("bigint"))
    rows = F.count(F.lit(1))
    per_split = F.when(rows < splits, rows).otherwise(div(rows, splits))
    size = (df if counted is None else counted).agg(per_split.alias("per_split")).scalar()
    return df.withColumn("split_id", div(F.col("pos"), size))


def split_layout(rows: DataFrame, size: int) -> DataFrame:
    """Per split: first row and token, number of tokens, and how many chunks come before."""
    per_split = rows.groupBy("split_id").agg(
        F.min("pos").alias("split_pos"),
        F.min("start").alias("split_start"),
        F.sum("n_tokens").alias("split_tokens"),
    )
    chunks = F.greatest(F.lit(1), div(F.col("split_tokens") + (size - 1), size))
    earlier = Window.orderBy("split_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_split.withColumn("n_chunks", chunks).withColumn(
        "first_chunk", F.sum("n_chunks").over(earlier) - F.col("n_chunks")
    )


def rechunk(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    splits: int = SPLITS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join the ids of consecutive rows and cut every `size` tokens, split by split.

    Needs `pos` (dense) and packed `tokens`; `n_tokens` and `start` (tokens before the row) are
    used if they are there. The tail of each split is padded with id 0, and a split without
    tokens gives one row of padding. Returns `split_id, chunk_id, pos` (place in the output),
    `n_real` (ids that are not padding) and `tokens`. For a table with an `input_ids` array in
    place of `tokens`, arrays come back.

    Every row is cut where chunks end, and the pieces of a chunk, at most `size` tokens, meet by
    one hash exchange on the chunk: a long row or a hot source spreads over many chunks.
    """
    if "tokens" not in df.columns:
        packed = df.withColumn("tokens", pack_ids("input_ids")).drop("input_ids")
        return with_ids(rechunk(packed, size, splits, counted))
    if "n_tokens" not in df.columns:
        df = df.withColumn("n_tokens", id_count("tokens"))
    if "start" not in df.columns:
        df = running_totals_by_position(df, {"start": "n_tokens"})
    placed = with_splits(df, splits, counted)
    layout = split_layout(placed, size)
    if splits <= _BROADCAST_SPLITS:  # the layout has at most 2 * splits - 1 rows
        layout = F.broadcast(layout)

    at = F.col("start") - F.col("split_start")
    first, last = div(at, size), div(at + F.col("n_tokens") - 1, size)

    def piece(chunk: Column) -> Column:
        begin = F.greatest(at, chunk * size)
        end = F.least(at + F.col("n_tokens"), (chunk + 1) * size)
        first_byte = ((begin - at) * ID_BYTES + 1).cast("int")
        n_bytes = ((end - begin) * ID_BYTES).cast("int")
        return F.struct(
            chunk.alias("chunk_id"),
            begin.alias("at"),
            F.substring("tokens", first_byte, n_bytes).alias("tokens"),
        )

    # The first row of a split without tokens stands for its row of padding.
    stands_in = (F.col("split_tokens") == 0) & (F.col("pos") == F.col("split_pos"))
    pieces = (
        placed.join(layout, "split_id")
        .where((F.col("n_tokens") > 0) | stands_in)
        .select(
            "split_id",
            "first_chunk",
            F.explode(F.transform(F.sequence(first, last), piece)).alias("piece"),
        )
        .select(
            "split_id",
            F.col("piece.chunk_id").alias("chunk_id"),
            (F.col("first_chunk") + F.col("piece.chunk_id")).alias("pos"),
            F.col("piece.at").alias("at"),
            F.col("piece.tokens").alias("tokens"),
        )
    )
    joined = F.expr("listagg(tokens) WITHIN GROUP (ORDER BY at)")
    chunks = pieces.groupBy("split_id", "chunk_id", "pos").agg(joined.alias("tokens"))
    pad = F.lit(PAD_ID.to_bytes(ID_BYTES, "little"))
    return chunks.select(
        "split_id",
        "chunk_id",
        "pos",
        id_count("tokens").alias("n_real"),
        F.rpad("tokens", F.lit(size * ID_BYTES), pad).alias("tokens"),
    )


def with_ids(df: DataFrame) -> DataFrame:
    """Packed `tokens` turned into an `input_ids` array."""
    return df.withColumn("input_ids", unpack_ids("tokens")).drop("tokens")


def with_chunk_masks(df: DataFrame, pad_token_types: bool = False) -> DataFrame:
    """Masks of packed rows: attention 1 for real ids, 0 for padding.

    `token_type_ids` cover the real ids only, or the whole row with `pad_token_types`.
    """
    zero, one = F.lit(0).cast("tinyint"), F.lit(1).cast("tinyint")
    size, real = F.size("input_ids"), F.col("n_real")
    types = F.array_repeat(zero, size if pad_token_types else real)
    mask = F.concat(F.array_repeat(one, real), F.array_repeat(zero, size - real))
    return df.withColumns({"token_type_ids": types, "attention_mask": mask})
