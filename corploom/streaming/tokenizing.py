"""Filter, tokenize and mask an unbounded text stream: the row-local part of packing.

Order, chunks and length groups need all rows, so they run as batch jobs on what the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corploom.operators.tokenizing import Tokenizer, tokenize_corpus, with_masks
from corploom.sources.datasets import keyed_rows


def tokenize_stream(
    stream: DataFrame, vocab: DataFrame | None = None, fn: Tokenizer | None = None, key: str = "text"
) -> DataFrame:
    return with_masks(tokenize_corpus(keyed_rows(stream, key), vocab, fn, key))


def append_to_stage(tokens: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start writing to a Parquet stage; file sink and checkpoint make it exactly-once."""
    writer = tokens.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
