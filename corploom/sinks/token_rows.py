"""What the sinks write: packed ids with their count of real ids, and the three export columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.functions.packed_ids import id_count, pack_ids
from corploom.operators.ordering import write_order
from corploom.operators.rechunking import with_chunk_masks, with_ids
from corploom.operators.tokenizing import with_masks
from corploom.staging import stage

ROWS_PER_FILE = 100_000


def packed_rows(df: DataFrame) -> DataFrame:
    """`pos, tokens, n_real` of ordered rows, whether their ids are packed or arrays."""
    tokens = F.col("tokens") if "tokens" in df.columns else pack_ids("input_ids")
    real = F.col("n_real") if "n_real" in df.columns else id_count("tokens")
    return df.select("pos", tokens.alias("tokens"), *[c for c in ["n_real"] if c in df.columns]).withColumn(
        "n_real", real
    )


def ordered_rows(df: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows for export, laid out in order of their dense positions over partitions of
    `rows_per_file`. Packed ids move; lists and masks are made behind the exchange."""
    if "attention_mask" in df.columns:
        return write_order(export_rows(df), "pos")
    staged = stage(packed_rows(df), "export")
    files = max(1, -(-staged.count() // rows_per_file))
    file = div(F.col("pos"), rows_per_file).cast("int")
    placed = staged.repartitionById(files, file).sortWithinPartitions("pos")
    return export_rows(placed)


def export_rows(df: DataFrame) -> DataFrame:
    """Rows with `input_ids, token_type_ids, attention_mask`; masks are derived if missing."""
    rows = with_ids(df) if "input_ids" not in df.columns else df
    if "attention_mask" in rows.columns:
        return rows
    return with_chunk_masks(rows) if "n_real" in rows.columns else with_masks(rows)


def train_test(df: DataFrame, position: str = "pos") -> dict[str, DataFrame]:
    """Train has all rows; test is the first row, which train keeps. Positions start at 0."""
    return {"train": df, "test": df.where(F.col(position) == 0)}
