"""Read a binary token store by document number, slice or sub-range."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corploom.functions.arithmetic import div
from corploom.sinks.files import open_folder, worker_uri
from corploom.sinks.token_store import ITEM_BYTES, ITEM_INDEX, STORE_INDEX

_READ_BYTES = 64 << 20


class TokenStore:
    """Documents of a store written by `write_token_store`, as DataFrames of `doc_ord, input_ids`.

    The index table is filtered first, and tasks then read only the byte ranges that are left.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.index = spark.read.schema(STORE_INDEX).parquet(f"{path}/index")

    def __len__(self) -> int:
        return self.index.count()

    def documents(self) -> DataFrame:
        return self._read(self.index)

    def item(self, i: int) -> DataFrame:
        """Document `i`; a negative number counts from the end. There must be such a document."""
        return self._read(self.index.where(F.col("doc_ord") == self._ordinal(i)))

    def slice(self, start: int | None = None, stop: int | None = None, step: int = 1) -> DataFrame:
        """Documents `start` up to before `stop`."""
        if step != 1:
            raise ValueError("a slice of the store must be contiguous")
        if start is None or stop is None or start < 0 or stop < 0:
            start, stop, _ = slice(start, stop).indices(len(self))
        wanted = (F.col("doc_ord") >= start) & (F.col("doc_ord") < stop)
        return self._read(self.index.where(wanted))

    def get(self, i: int, offset: int = 0, length: int | None = None) -> DataFrame:
        """`length` ids of document `i` from `offset` on, by default and at most all the rest.
        Reads stay inside the document."""
        if offset < 0 or (length is not None and length < 0):
            raise ValueError("offset and length must not be negative")
        rest = F.greatest(F.col("size") - offset, F.lit(0))
        size = rest if length is None else F.least(rest, F.lit(length))
        part = self.index.where(F.col("doc_ord") == self._ordinal(i)).withColumns(
            {"size": size.cast("int"), "shard_pointer": F.col("shard_pointer") + offset * ITEM_BYTES}
        )
        return self._read(part)

    def _ordinal(self, i: int) -> int:
        count = len(self)
        if not -count <= i < count:
            raise IndexError(f"no document {i} in a store of {count}")
        return i if i >= 0 else i + count

    def _read(self, index: DataFrame) -> DataFrame:
        return read_ranges(self.spark, self.path, index, "doc_ord bigint")


class ItemStore:
    """Documents of several items, written by `write_token_store` from lists of id lists.

    `index` has a row for each item: its document, its place in it and its number in the whole
    store, and one without an item for each document that has none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = spark.read.schema(ITEM_INDEX).parquet(f"{path}/index")
        # A row a shard: the shards are few, whatever the number of items.
        earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        held = rows.groupBy("shard").agg(F.count("item").alias("n"))
        base = held.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
        self.index = rows.join(base, "shard").withColumn("item_ord", F.col("base") + F.col("shard_item")).drop("base")

    def items(self, wanted: Column | None = None) -> DataFrame:
        """`doc_ord, item, item_ord, input_ids` of the items, or of those that `wanted` picks by the
        columns of the index."""
        index = self.index.where("item is not null")
        index = index if wanted is None else index.where(wanted)
        return read_ranges(self.spark, self.path, index, "doc_ord bigint, item bigint, item_ord bigint")

    def item(self, i: int) -> DataFrame:
        """The item of that number in the whole store."""
        return self.items(F.col("item_ord") == i)

    def documents(self, wanted: Column | None = None) -> DataFrame:
        """`doc_ord, input_ids`: the lists of a document's items in order, an empty list for none."""
        index = self.index if wanted is None else self.index.where(wanted)
        parts = F.sort_array(F.collect_list(F.struct("item", "input_ids")))
        ids = F.transform(parts, lambda p: p["input_ids"])
        filled = self.items(wanted).groupBy("doc_ord").agg(ids.alias("input_ids"))
        none = F.array().cast("array<array<int>>")
        empty = index.where("item is null").select("doc_ord", none.alias("input_ids"))
        return filled.unionByName(empty)

    def document(self, i: int) -> DataFrame:
        return self.documents(F.col("doc_ord") == i)


def read_ranges(spark: SparkSession, path: str, index: DataFrame, keys: str) -> DataFrame:
    """`input_ids` of the byte ranges in an index, each with the columns `keys` of its row."""
    uri = worker_uri(spark, path)
    names = [key.split()[0] for key in keys.split(", ")]

    def read(batches):
        for batch in batches:
            yield from _read_ranges(uri, batch, names)

    # Tasks by data to read, not by size of the index.
    ranges = index.select(*names, "shard", "size", "shard_pointer").repartition(
        F.col("shard"), div(F.col("shard_pointer"), _READ_BYTES)
    )
    return ranges.mapInArrow(read, f"{keys}, input_ids array<int>")


def _read_ranges(path: str, batch: pa.RecordBatch, keys: list[str]):
    """Open each shard once and join neighbouring ranges to one read, up to 64 MB."""
    if not batch.num_rows:
        return
    batch = batch.sort_by([("shard", "ascending"), ("shard_pointer", "ascending")])
    shards, sizes, starts = (batch.column(c).to_numpy() for c in ("shard", "size", "shard_pointer"))
    sizes = sizes.astype(np.int64)
    ends = starts + sizes * ITEM_BYTES
    files, folder = open_folder(path)
    a = 0
    while a < len(starts):
        b = a + 1
        while (
            b < len(starts)
            and shards[b] == shards[a]
            and starts[b] == ends[b - 1]
            and ends[b] - starts[a] <= _READ_BYTES
        ):
            b += 1
        with files.open_input_file(f"{folder}/shard-{shards[a]:05d}.bin") as data:
            raw = data.read_at(int(ends[b - 1] - starts[a]), int(starts[a]))
        offsets = np.concatenate(([0], np.cumsum(sizes[a:b]))).astype(np.int32)
        ids = np.frombuffer(raw, "<u2").astype(np.int32)
        if len(ids) != offsets[-1]:
            raise ValueError(f"{keys[0]} {batch.column(keys[0])[b - 1]} reaches past the end of its shard")
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
        yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in keys), lists], [*keys, "input_ids"])
        a = b
