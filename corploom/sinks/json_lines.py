"""JSON lines sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corploom.operators.ordering import write_order
from corploom.sinks.files import refuse_filled

COLUMNS = ["input_ids", "token_type_ids", "attention_mask"]


def write_json_lines(df: DataFrame, path: str, columns: list[str] | None = None, position: str = "pos"):
    """One object per row; files follow one another in order of `position`, if there is one.
    `path` must be new or empty."""
    refuse_filled(df.sparkSession, path)
    ordered = write_order(df, position) if position in df.columns else df
    ordered.select(*(columns or COLUMNS)).write.mode("overwrite").json(path)
