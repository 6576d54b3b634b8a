"""Stage tables: intermediate results written once to shared storage and read back.

A stage cuts the lineage with files that every executor can read, so losing an executor costs
a re-read and not a second tokenization.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stages: the one the cluster names, else (local master only) a new one."""
    root = spark.conf.get(_DIR_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_DIR_KEY} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="corploom-")
    spark.conf.set(_DIR_KEY, root)
    return root


def write_stage(df: DataFrame, path: str, mode: str = "error"):
    """Packed ids are mostly zero bytes: zstd leaves a fraction of what Spark's usual codec does."""
    writer = df.write.mode(mode)
    (writer.option("compression", "zstd") if "tokens" in df.columns else writer).parquet(path)


_written: dict[str, list[str]] = {}


def new_stage_path(spark: SparkSession, name: str) -> str:
    path = f"{stage_root(spark)}/corploom/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet stage and return the table read back from it."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    write_stage(df, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_stages(spark: SparkSession):
    """Delete the stages this application wrote. Frames built on them cannot be read any more."""
    context = spark.sparkContext
    for name in _written.pop(context.applicationId, []):
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
