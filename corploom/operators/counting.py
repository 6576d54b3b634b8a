"""Row counts, and the check whether a tokenized stage can be used again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def nonblank_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose text holds anything but white space."""
    return df.where(F.col(column).rlike(r"\S"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def bounded_count(df: DataFrame, target: int) -> int:
    """Number of rows, or -1 if there are more than `target`.

    Every task stops after `target` rows and one more; these are empty rows when they meet.
    """
    n = df.select().limit(target + 1).count()
    return -1 if n > target else n


def fingerprint(df: DataFrame, columns: Sequence[str], spec: str = "") -> DataFrame:
    """One row with count, order-free content hash and the settings that made the rows."""
    digest = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(digest), F.lit(0).cast("decimal(38,0)")).alias("content"),
    ).withColumn("spec", F.lit(spec))


def save_fingerprint(stage_path: str, source: DataFrame, columns: Sequence[str], spec: str = ""):
    """Note beside a stage what it was made from."""
    fingerprint(source, columns, spec).write.mode("overwrite").parquet(f"{stage_path}.source")


def drop_fingerprint(spark: SparkSession, stage_path: str):
    """Before a stage is written again: a write that breaks off must leave nothing to trust."""
    context = spark.sparkContext
    note = context._jvm.org.apache.hadoop.fs.Path(f"{stage_path}.source")
    note.getFileSystem(context._jsc.hadoopConfiguration()).delete(note, True)


def stage_reusable(stage_path: str, source: DataFrame, columns: Sequence[str], spec: str = "") -> bool:
    """True if the stage has as many rows as `source` and was made from the same content."""
    spark = source.sparkSession
    try:
        noted = spark.read.parquet(f"{stage_path}.source").first()
        staged = spark.read.parquet(stage_path).count()
    except AnalysisException:
        return False
    return noted == fingerprint(source, columns, spec).first() and noted["n_rows"] == staged
