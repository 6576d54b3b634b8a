"""Arrow shard sets with train and test folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.packed_ids import as_lists, line_bytes, moved_small
from corploom.sinks.files import AtomicFile, check_files, new_folder, open_folder, worker_uri
from corploom.sinks.shards import SHARD_BYTES, each_shard, in_shards, with_shards
from corploom.sinks.token_rows import packed_rows, train_test
from corploom.staging import stage

# Columns and types of a shard file.
SHARD_SCHEMA = pa.schema(
    [
        ("input_ids", pa.list_(pa.int32())),
        ("token_type_ids", pa.list_(pa.int8())),
        ("attention_mask", pa.list_(pa.int8())),
    ]
)
_TASK_BYTES = 64 << 20  # of shard files, read by a task
MANIFEST = "split string, shard bigint, file string, n_rows bigint, n_bytes bigint"


def _flags(sizes: np.ndarray, ones: np.ndarray) -> pa.Array:
    """list<int8> rows of `sizes` with that many leading ones, zeros after."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    values = (place < np.repeat(ones, sizes)).astype(np.int8)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


class _ShardFile:
    def __init__(self, root: str, split: str, shard: int, pad_token_types: bool):
        self.split, self.shard, self.rows = split, shard, 0
        self.pad_token_types = pad_token_types
        self.name = f"data-{shard:05d}.arrow"
        self.file = AtomicFile(f"{root}/{split}/{self.name}")
        self.writer = pa.ipc.new_stream(self.file.stream, SHARD_SCHEMA)

    def add(self, run: pa.RecordBatch):
        ids = as_lists(run.column("tokens"))
        real = run.column("n_real").to_numpy()
        sizes = np.diff(ids.offsets.to_numpy())
        types = _flags(sizes if self.pad_token_types else real, np.zeros_like(real))
        batch = pa.RecordBatch.from_arrays([ids, types, _flags(sizes, real)], schema=SHARD_SCHEMA)
        self.writer.write_batch(batch)
        self.rows += run.num_rows

    def finish(self) -> Iterator[pa.RecordBatch]:
        self.writer.close()
        report = {
            "split": [self.split],
            "shard": [self.shard],
            "file": [self.name],
            "n_rows": [self.rows],
            "n_bytes": [self.file.close()],
        }
        yield pa.record_batch(report)


def write_arrow_shards(
    df: DataFrame,
    path: str,
    shard_bytes: int = SHARD_BYTES,
    pad_token_types: bool = False,
    filled: bool = False,
) -> DataFrame:
    """Write `train/data-00000.arrow`, ... and `test/data-00000.arrow`; returns the manifest table.

    A shard takes whole rows, in order of `pos`, up to `shard_bytes` of JSON line size (with `filled`,
    until it exceeds them). `path` must be new or empty and visible to all executors. The manifest is
    also kept as Parquet under `path/manifest`. All files appear together once they are
    written and checked; a shard that cannot be written fails the job and leaves nothing.
    """
    spark = df.sparkSession
    worker_uri(spark, path)
    rows = packed_rows(df)
    with new_folder(spark, path) as folder:
        staged = stage(rows.withColumn("row_bytes", line_bytes("tokens", "n_real")), "export")
        _write_shards(staged, folder, shard_bytes, pad_token_types, filled)
    return read_manifest(spark, path)


def _write_shards(staged: DataFrame, path: str, shard_bytes: int, pad_token_types: bool, filled: bool):
    spark = staged.sparkSession
    target = worker_uri(spark, path)
    reports = []
    for split, part in train_test(staged).items():
        if split == "train":
            part = with_shards(part, shard_bytes, filled=filled)
        else:
            part = part.withColumn("shard", F.lit(0).cast("bigint"))

        def write(batches: Iterator[pa.RecordBatch], split: str = split) -> Iterator[pa.RecordBatch]:
            return each_shard(batches, lambda shard: _ShardFile(target, split, shard, pad_token_types))

        columns = moved_small(part, in_shards).select("shard", "tokens", "n_real")
        reports.append(columns.mapInArrow(write, MANIFEST))
    reports[0].unionByName(reports[1]).write.mode("overwrite").parquet(f"{path}/manifest")
    manifest = read_manifest(spark, path)
    for split in ("train", "test"):
        files = manifest.where(F.col("split") == split).select("file", "n_bytes").collect()
        check_files(spark, f"{path}/{split}", dict(map(tuple, files)))
    written = manifest.where(F.col("split") == "train").agg(F.sum("n_rows").alias("n")).first()["n"] or 0
    if written != staged.count():
        raise RuntimeError(f"{written} rows in the shards for {staged.count()} rows of input")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def manifest_features(manifest: DataFrame) -> DataFrame:
    """Manifest with the column names and types of the files."""
    features = ", ".join(f"{f.name}: {f.type}" for f in SHARD_SCHEMA)
    return manifest.withColumn("features", F.lit(features))


def read_arrow_shards(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """Rows of the shard files named by the manifest, with `shard` and `row` for their order."""

    target = worker_uri(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = open_folder(f"{target}/{split}")
        for batch in batches:
            for shard, name in zip(batch["shard"].to_pylist(), batch["file"].to_pylist()):
                row = 0
                with files.open_input_stream(f"{folder}/{name}") as stream:
                    for rows in pa.ipc.open_stream(stream):
                        place = [
                            pa.array(np.full(rows.num_rows, shard)),
                            pa.array(np.arange(row, row + rows.num_rows)),
                        ]
                        row += rows.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [*place, *rows.columns], ["shard", "row", *SHARD_SCHEMA.names]
                        )

    listed = read_manifest(spark, path).where(F.col("split") == split)
    files, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    # Left to adaptive execution, a list of names is so small that one task would read all files.
    tasks = max(1, min(files, max(spark.sparkContext.defaultParallelism, size // _TASK_BYTES)))
    dealt = listed.select("shard", "file").repartitionById(tasks, (F.col("shard") % tasks).cast("int"))
    lists = "input_ids array<int>, token_type_ids array<tinyint>, attention_mask array<tinyint>"
    return dealt.mapInArrow(read, f"shard bigint, row bigint, {lists}")
