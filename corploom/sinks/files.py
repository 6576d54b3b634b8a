"""One file system for Spark and for the files that tasks write themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

# Schemes that tasks can open, and what they call them.
_SCHEMES = {name: name for name in ("file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss")}
_SCHEMES |= {"s3a": "s3", "s3n": "s3"}


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's file system of the path, and the path as it resolves there."""
    context = spark.sparkContext
    plain = context._jvm.org.apache.hadoop.fs.Path(path)
    files = plain.getFileSystem(context._jsc.hadoopConfiguration())
    return files, files.makeQualified(plain)


def worker_uri(spark: SparkSession, path: str) -> str:
    """The place that `path` names for Spark, as tasks open it: paths without a scheme belong to
    Spark's default file system, relative ones to its working folder."""
    scheme = path.partition("://")[0] if "://" in path else None
    if scheme is not None and scheme not in _SCHEMES:
        raise ValueError(f"tasks cannot write to {scheme}:// ({path}); known: {sorted(_SCHEMES)}")
    if scheme in ("s3a", "s3n"):  # needs no Hadoop to tell the bucket
        return f"s3://{path.partition('://')[2]}".rstrip("/")
    uri = _hadoop(spark, path)[1].toUri()
    if uri.getScheme() not in _SCHEMES:
        raise ValueError(f"tasks cannot write to {uri.toString()}; known: {sorted(_SCHEMES)}")
    host = uri.getAuthority() or ""
    return f"{_SCHEMES[uri.getScheme()]}://{host}{uri.getPath()}".rstrip("/")


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and sizes of the files in a folder, as Spark's file system has them."""
    files, folder = _hadoop(spark, path)
    if not files.exists(folder):
        return {}
    return {s.getPath().getName(): s.getLen() for s in files.listStatus(folder) if s.isFile()}


def refuse_filled(spark: SparkSession, path: str):
    """Files of an older export must not mix with new ones."""
    files, folder = _hadoop(spark, path)
    if files.exists(folder) and len(files.listStatus(folder)):
        raise ValueError(f"{path} is not empty")


@contextmanager
def new_folder(spark: SparkSession, path: str) -> Iterator[str]:
    """A hidden folder beside `path` to make an export in. It gets its name when all is written and
    checked; if anything fails, it is deleted, and `path` is as it was before. `path` must be
    new or empty. A task that outlives a failed job writes to the hidden folder at most."""
    refuse_filled(spark, path)
    head, _, name = path.rstrip("/").rpartition("/")
    hidden = f"{head}/.{name}.{uuid.uuid4().hex}" if head else f".{name}.{uuid.uuid4().hex}"
    try:
        yield hidden
    except BaseException:
        files, folder = _hadoop(spark, hidden)
        files.delete(folder, True)
        raise
    files, folder = _hadoop(spark, hidden)
    target = _hadoop(spark, path)[1]
    refuse_filled(spark, path)
    files.delete(target, False)  # empty, if there at all
    files.mkdirs(target.getParent())
    if not files.rename(folder, target):
        raise RuntimeError(f"{hidden} could not be renamed to {path}")


def check_files(spark: SparkSession, path: str, expected: dict[str, int]):
    """Fails if Spark's file system does not hold what the tasks report to have written."""
    found = file_sizes(spark, path)
    wrong = [name for name, size in expected.items() if found.get(name) != size]
    if wrong:
        raise RuntimeError(f"{len(wrong)} files are not in {path} as written, such as {wrong[0]}")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that gets its name when it is complete: a retried task just writes it again."""

    def __init__(self, uri: str):
        self.files, self.path = open_folder(uri)
        folder, _, name = self.path.rpartition("/")
        self.temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.files.create_dir(folder, recursive=True)
        self.stream = self.files.open_output_stream(self.temporary)

    def close(self) -> int:
        size = self.stream.tell()
        self.stream.close()
        self.files.move(self.temporary, self.path)
        return size
