"""Line up sources and mix them: in order, shuffled, or evenly by length."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions.packed_ids import line_bytes, moved_small
from corploom.operators.lengths import length_places
from corploom.operators.ordering import SHUFFLE_SEED, shuffle_rows
from corploom.operators.rechunking import CHUNK_SIZE, SPLITS, rechunk

_TOKEN_SUMS = {"start": "n_tokens"}


def concat_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all sources, duplicates kept, with `source` and `source_ord` (given order)."""
    if not sources or not all(sources):
        raise ValueError("every source needs a name")
    tagged = [
        df.withColumns({"source_ord": F.lit(i), "source": F.lit(name)})
        for i, (name, df) in enumerate(sources.items())
    ]
    return reduce(DataFrame.unionByName, tagged)


def mix_concat(df: DataFrame, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Sources in order, each one shuffled; adds `pos` and `start`."""
    keys = ["source_ord", "row_key"]
    return moved_small(df, lambda rows: shuffle_rows(rows, keys, seed, ["source_ord"], _TOKEN_SUMS))


def mix_shuffle(df: DataFrame, seed: int = SHUFFLE_SEED) -> DataFrame:
    """One shuffle over all sources; adds `pos` and `start`."""
    keys = ["source_ord", "row_key"]
    return moved_small(df, lambda rows: shuffle_rows(rows, keys, seed, None, _TOKEN_SUMS))


def mix_inverse(
    df: DataFrame, seed: int = SHUFFLE_SEED, size: int = CHUNK_SIZE, splits: int = SPLITS
) -> DataFrame:
    """Rechunk the sources in order first, then shuffle the chunks; `pos` is the new place."""
    chunks = rechunk(mix_concat(df, seed), size, splits, df)
    keys = ["split_id", "chunk_id"]
    return moved_small(chunks.drop("pos"), lambda rows: shuffle_rows(rows, keys, seed))


def mix_by_length(df: DataFrame, length: Column | None = None, **options) -> DataFrame:
    """Spread rows of like length evenly; ties of length keep the order of the sources.

    Order and places come from keys and lengths; the token arrays join them once at the end.
    """
    keys = ["source_ord", "row_key"]
    measured = df.select(*keys, (line_bytes() if length is None else length).alias("len"))
    placed = length_places(shuffle_rows(measured, keys, within=["source_ord"]), keys, **options)
    return df.drop("len").join(placed, keys)
