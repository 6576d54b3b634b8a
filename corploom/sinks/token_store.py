"""Binary token store: 16-bit ids back to back in `.bin`, sizes and pointers in `.idx`."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions.packed_ids import id_count, pack_ids, packed_ids
from corploom.operators.running_totals import running_totals_by_position
from corploom.sinks.files import AtomicFile, check_files, new_folder, worker_uri
from corploom.sinks.shards import SHARD_BYTES, each_shard, in_shards, with_shards
from corploom.sinks.token_rows import packed_rows
from corploom.staging import stage

# Fixed values of the store format.
MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
UINT16_CODE = 8
ITEM_BYTES = 2
MAX_ID = 65_535
INDEX_HEADER = 34

_INDEX_ROWS = 1 << 16

STORE_INDEX = "doc_ord bigint, shard bigint, shard_doc bigint, size int, shard_pointer bigint"
ITEM_INDEX = "doc_ord bigint, item bigint, shard bigint, shard_item bigint, size int, shard_pointer bigint"


def store_index(df: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """`doc_ord, size, pointer`: each document's token count and first byte in the joined data."""
    sizes = df.select("pos", "n_tokens" if "n_tokens" in df.columns else id_count("tokens").alias("n_tokens"))
    indexed = running_totals_by_position(sizes, {"before": "n_tokens"})
    return indexed.select(
        F.col("pos").alias("doc_ord"),
        F.col("n_tokens").cast("int").alias("size"),
        (F.col("before") * item_bytes).alias("pointer"),
    )


def document_index(items: DataFrame, doc: str = "doc", position: str = "pos") -> DataFrame:
    """`doc, doc_end`: number of items up to the end of each document of one or more items.

    With the leading 0 of the file this is the document index; for one item a document it
    counts 1, 2, ..., n.
    """
    return items.groupBy(doc).agg((F.max(position) + 1).alias("doc_end"))


class _StorePair:
    """One `.bin` with its `.idx`. Sizes of a shard's items are kept until the end."""

    def __init__(self, root: str, shard: int):
        self.shard = shard
        self.base = f"{root}/shard-{shard:05d}"
        self.data = AtomicFile(f"{self.base}.bin")
        self.sizes: list[np.ndarray] = []

    def add(self, run: pa.RecordBatch):
        self._write(run.column("tokens"))

    def _write(self, tokens: pa.Array):
        ids, ends = packed_ids(tokens)
        if len(ids) and (ids.min() < 0 or ids.max() > MAX_ID):
            bad = ids[(ids < 0) | (ids > MAX_ID)][0]
            raise ValueError(f"token id {bad} does not fit the 16-bit store")
        self.data.stream.write(ids.astype("<u2").tobytes())
        self.sizes.append(np.diff(ends).astype("<i4"))

    def _close(self, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Writes the index file; sizes and pointers of the items."""
        sizes = np.concatenate([np.empty(0, "<i4"), *self.sizes])
        ends = np.cumsum(sizes, dtype="<i8") * ITEM_BYTES
        pointers = ends - sizes.astype("<i8") * ITEM_BYTES
        index = AtomicFile(f"{self.base}.idx")
        index.stream.write(MAGIC + struct.pack("<QBQQ", VERSION, UINT16_CODE, len(sizes), len(doc_ends) + 1))
        for part in (sizes, pointers, np.zeros(1, "<i8"), doc_ends.astype("<i8")):
            index.stream.write(part.tobytes())
        self.data.close()
        index.close()
        return sizes, pointers


class _DocumentPair(_StorePair):
    """Documents of one item. Those of a shard are numbered without a gap."""

    first = None

    def add(self, run: pa.RecordBatch):
        super().add(run)
        if self.first is None:
            self.first = run.column("doc_ord")[0].as_py()

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Index rows in bounded batches."""
        count = sum(map(len, self.sizes))
        sizes, pointers = self._close(np.arange(1, count + 1))
        for at in range(0, count, _INDEX_ROWS):
            places = np.arange(at, min(at + _INDEX_ROWS, count))
            yield pa.record_batch(
                {
                    "doc_ord": self.first + places,
                    "shard": np.full(len(places), self.shard, np.int64),
                    "shard_doc": places,
                    "size": sizes[places].astype(np.int32),
                    "shard_pointer": pointers[places].astype(np.int64),
                }
            )


class _ItemPair(_StorePair):
    """Documents of any number of items, one row an item; a row without an item stands for a
    document that has none."""

    def __init__(self, root: str, shard: int):
        super().__init__(root, shard)
        self.docs: list[np.ndarray] = []
        self.items: list[np.ndarray] = []

    def add(self, run: pa.RecordBatch):
        items = run.column("item")
        super()._write(run.column("tokens").filter(items.is_valid()))
        self.docs.append(run.column("doc_ord").to_numpy())
        self.items.append(items.fill_null(-1).to_numpy())

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Index rows in bounded batches: one an item, and one without an item a document that has
        none."""
        docs, items = np.concatenate(self.docs), np.concatenate(self.items)
        number = np.cumsum(items >= 0)  # items up to each row, the row's own included
        last = np.flatnonzero(np.append(docs[1:] != docs[:-1], True))
        sizes, pointers = self._close(number[last])
        for at in range(0, len(docs), _INDEX_ROWS):
            rows = slice(at, at + _INDEX_ROWS)
            absent = items[rows] < 0
            own = number[rows] - 1
            held = np.where(absent, 0, own)

            def known(values: np.ndarray, kind: pa.DataType, absent: np.ndarray = absent) -> pa.Array:
                return pa.array(values, kind, mask=absent)

            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs[rows]),
                    known(items[rows], pa.int64()),
                    pa.array(np.full(len(held), self.shard)),
                    known(own, pa.int64()),
                    known(sizes[held] if len(sizes) else held, pa.int32()),
                    known(pointers[held] if len(sizes) else held, pa.int64()),
                ],
                [name.split()[0] for name in ITEM_INDEX.split(", ")],
            )


def write_token_store(
    df: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, filled: bool = False
) -> DataFrame:
    """Write `shard-00000.bin` and `.idx`, ... in order of `pos`; returns the index table.

    A shard takes whole documents up to `shard_bytes` of ids (with `filled`, until it exceeds
    them); a document without ids counts as one byte, so a shard has at most `shard_bytes`
    documents. Each pair is complete by itself; with one shard it is the whole store. An id outside
    0..65535 fails the job. `path` must be new or empty and visible to all executors; the
    index is also kept there as Parquet. All files appear together once they are checked.

    Rows whose `input_ids` are lists of lists are documents of several items, see
    `corploom.sources.token_store.ItemStore`.
    """
    if has_items(df):
        return _write_items(df, path, shard_bytes, filled)
    spark = df.sparkSession
    worker_uri(spark, path)
    sizes = F.greatest(id_count("tokens").cast("bigint") * ITEM_BYTES, F.lit(1))
    with new_folder(spark, path) as folder:
        staged = stage(packed_rows(df).withColumn("row_bytes", sizes), "export")
        columns = in_shards(with_shards(staged, shard_bytes, filled=filled)).select(
            "shard", F.col("pos").alias("doc_ord"), "tokens"
        )
        index = _write_pairs(columns, _DocumentPair, STORE_INDEX, folder)
        if index.count() != staged.count():
            raise RuntimeError(f"{index.count()} documents in the store for {staged.count()} of input")
        docs = F.count(F.lit(1))
        _check_pairs(index, folder, docs, docs)
    return spark.read.schema(STORE_INDEX).parquet(f"{path}/index")


def has_items(df: DataFrame) -> bool:
    """Whether rows hold a list of id lists each."""
    kind = df.schema["input_ids"].dataType if "input_ids" in df.columns else None
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)


def _write_items(df: DataFrame, path: str, shard_bytes: int, filled: bool) -> DataFrame:
    """Items are laid out one a row, by document and place in it, so no task holds more than the item
    at hand and the sizes of a shard. The shard of a document is that of all its items."""
    spark = df.sparkSession
    worker_uri(spark, path)
    parts = df.select("pos", F.posexplode_outer("input_ids").alias("item", "ids"))
    nothing = F.array().cast("array<int>")
    tokens = pack_ids(F.coalesce("ids", nothing))
    with new_folder(spark, path) as folder:
        staged = stage(parts.select("pos", F.col("item").cast("bigint").alias("item"), tokens.alias("tokens")), "export")
        held = F.sum(F.greatest(id_count("tokens").cast("bigint") * ITEM_BYTES, F.lit(1)))
        sizes = stage(staged.groupBy("pos").agg(held.alias("row_bytes"), F.count("item").alias("n_items")), "sizes")
        sharded = with_shards(staged, shard_bytes, filled=filled, sizes=sizes)
        columns = in_shards(sharded, "pos", "item").select("shard", F.col("pos").alias("doc_ord"), "item", "tokens")
        index = _write_pairs(columns, _ItemPair, ITEM_INDEX, folder)
        if index.count() != staged.count():
            raise RuntimeError(f"{index.count()} items in the store for {staged.count()} of input")
        _check_pairs(index, folder, F.count("item"), F.count_distinct("doc_ord"))
    return spark.read.schema(ITEM_INDEX).parquet(f"{path}/index")


def _write_pairs(columns: DataFrame, pair: type, schema: str, folder: str) -> DataFrame:
    spark = columns.sparkSession
    target = worker_uri(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return each_shard(batches, lambda shard: pair(target, shard))

    columns.mapInArrow(write, schema).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.schema(schema).parquet(f"{folder}/index")


def _check_pairs(index: DataFrame, folder: str, items: Column, docs: Column):
    ids = F.sum(F.coalesce(F.col("size").cast("bigint"), F.lit(0))) * ITEM_BYTES
    files = {}
    for shard, held, n_items, n_docs in index.groupBy("shard").agg(ids, items, docs).collect():
        files[f"shard-{shard:05d}.bin"] = held
        files[f"shard-{shard:05d}.idx"] = INDEX_HEADER + 12 * n_items + 8 * (n_docs + 1)
    check_files(index.sparkSession, folder, files)


def store_manifest(index: DataFrame) -> DataFrame:
    return index.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum(F.col("size").cast("bigint")) * ITEM_BYTES).alias("n_bytes"),
    )
