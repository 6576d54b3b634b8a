"""Token stores as a Spark data source: `spark.read.format("token_store").load(path)`.

Documents come as `doc_ord, input_ids`, read from the `.bin` and `.idx` pairs alone. Partitions are
planned from the headers of the index files and the sizes of the data files: every
`READ_BYTES` of a shard are a task, which finds its documents by bisection of the index, so nothing
that grows with the documents passes through the driver. Conditions on `doc_ord` are pushed
down (with `spark.sql.python.filterPushdown.enabled`): shards outside are left out, and of the others
only the bytes of the wanted documents are read. The ids of a document of several items are joined.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from corploom.sinks.files import open_folder, worker_uri
from corploom.sinks.token_store import INDEX_HEADER, ITEM_BYTES, MAGIC

FORMAT = "token_store"
SCHEMA = "doc_ord bigint, input_ids array<int>"
READ_BYTES = 64 << 20
_LAST = 1 << 62
_HEADERS_AT_ONCE = 32


@dataclass
class StorePart(ds.InputPartition):
    """Documents `low` to before `high` of a shard that begin in bytes `begin` to before `end`."""

    shard: str
    first_doc: int
    low: int
    high: int
    begin: int
    end: int


class _Index:
    """The index file of a shard, read in pieces."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        header = file.read_at(INDEX_HEADER, 0)
        if header[: len(MAGIC)] != MAGIC:
            raise ValueError("not an index of a token store")
        self.items, docs = struct.unpack_from("<QQ", header, 18)
        self.docs = docs - 1

    def _read(self, kind: str, at: int, begin: int, count: int) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(width * count, at + width * begin), kind)

    def starts(self, low: int, high: int) -> np.ndarray:
        """First byte of the documents `low` to before `high`, and the end of the last one."""
        at = INDEX_HEADER + 4 * self.items
        edges = self._read("<i8", at + 8 * self.items, low, high - low + 1)
        first, last = int(edges[0]), int(edges[-1])
        pointers = self._read("<i8", at, first, min(last + 1, self.items) - first)
        if last == self.items:
            sizes = self._read("<i4", INDEX_HEADER, self.items - 1, 1) if self.items else np.zeros(1, "<i4")
            end = int(pointers[-1]) + ITEM_BYTES * int(sizes[0]) if len(pointers) else self._end()
            pointers = np.append(pointers, end)
        return pointers[edges - first]

    def _end(self) -> int:
        """Bytes of the shard, for documents behind its last item."""
        if not self.items:
            return 0
        (pointer,) = self._read("<i8", INDEX_HEADER + 4 * self.items, self.items - 1, 1)
        (size,) = self._read("<i4", INDEX_HEADER, self.items - 1, 1)
        return int(pointer) + ITEM_BYTES * int(size)

    def first_from(self, byte: int, low: int, high: int) -> int:
        """The first document from `low` on, and before `high`, that begins at `byte` or later."""
        while low < high:
            middle = (low + high) // 2
            if int(self.starts(middle, middle + 1)[0]) < byte:
                low = middle + 1
            else:
                high = middle
        return low


class TokenStoreSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TokenStoreReader:
        return TokenStoreReader(self.options["path"], int(self.options.get("read_bytes", READ_BYTES)))


class TokenStoreReader(ds.DataSourceReader):
    def __init__(self, path: str, read_bytes: int = READ_BYTES):
        self.path, self.read_bytes = path, read_bytes
        self.low, self.high = 0, _LAST

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Narrows the documents to read; gives back what Spark must still check."""
        for condition in filters:
            if getattr(condition, "attribute", None) != ("doc_ord",):
                yield condition
                continue
            match condition:
                case ds.EqualTo(value=value) | ds.EqualNullSafe(value=value) if value is not None:
                    self._narrow(value, value + 1)
                case ds.GreaterThan(value=value):
                    self._narrow(value + 1, _LAST)
                case ds.GreaterThanOrEqual(value=value):
                    self._narrow(value, _LAST)
                case ds.LessThan(value=value):
                    self._narrow(0, value)
                case ds.LessThanOrEqual(value=value):
                    self._narrow(0, value + 1)
                case ds.In(value=values) if values and None not in values:
                    self._narrow(min(values), max(values) + 1)
                    yield condition
                case ds.IsNotNull():
                    pass
                case _:
                    yield condition

    def _narrow(self, low: int, high: int):
        self.low, self.high = max(self.low, low), min(self.high, high)

    def partitions(self) -> Sequence[StorePart]:
        files, folder = open_folder(self.path)
        found = files.get_file_info(fs.FileSelector(folder))
        sizes = {f.base_name: f.size for f in found if f.base_name.startswith("shard-")}
        shards = sorted((n.removesuffix(".idx") for n in sizes if n.endswith(".idx")), key=lambda n: (len(n), n))

        def count(shard: str) -> int:
            with files.open_input_file(f"{folder}/{shard}.idx") as file:
                return _Index(file).docs

        parts, first = [], 0
        with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
            for shard, docs in zip(shards, pool.map(count, shards)):
                low, high = max(self.low - first, 0), min(self.high - first, docs)
                if low < high:
                    # Documents without ids begin where the data ends: the last range is open.
                    cuts = range(0, max(sizes[f"{shard}.bin"], 1), self.read_bytes)
                    ends = [*cuts[1:], _LAST]
                    parts += [StorePart(shard, first, low, high, a, b) for a, b in zip(cuts, ends)]
                first += docs
        return parts or [StorePart("", 0, 0, 0, 0, 0)]

    def read(self, partition: StorePart) -> Iterator[pa.RecordBatch]:
        if partition.low >= partition.high:
            return
        files, folder = open_folder(self.path)
        base = f"{folder}/{partition.shard}"
        with files.open_input_file(f"{base}.idx") as index, files.open_input_file(f"{base}.bin") as data:
            index = _Index(index)
            low = index.first_from(partition.begin, partition.low, partition.high)
            high = index.first_from(partition.end, low, partition.high)
            while low < high:
                # At most `read_bytes` at a time, and one document at least.
                limit = int(index.starts(low, low + 1)[0]) + self.read_bytes
                until = max(low + 1, index.first_from(limit, low, high))
                yield _documents(index, data, low, until, partition)
                low = until


def _documents(index: _Index, data: pa.NativeFile, low: int, high: int, partition: StorePart) -> pa.RecordBatch:
    starts = index.starts(low, high)
    raw = data.read_at(int(starts[-1] - starts[0]), int(starts[0]))
    ids = np.frombuffer(raw, "<u2").astype(np.int32)
    offsets = (starts - starts[0]) // ITEM_BYTES
    if len(ids) != offsets[-1]:
        raise ValueError(f"document {partition.first_doc + high - 1} reaches past the end of {partition.shard}")
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
    numbers = pa.array(partition.first_doc + np.arange(low, high))
    return pa.RecordBatch.from_arrays([numbers, lists], ["doc_ord", "input_ids"])


def read_store(spark: SparkSession, path: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """The store as a data frame that takes conditions on `doc_ord` down to its files."""
    spark.dataSource.register(TokenStoreSource)
    return spark.read.format(FORMAT).option("read_bytes", str(read_bytes)).load(worker_uri(spark, path))
