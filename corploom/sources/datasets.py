"""Dataset scans, split choice and the text filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAMED_SPLITS = 1000

def scan(
    spark: SparkSession,
    source: str | None,
    format: str = "json",
    schema: T.StructType | str | None = None,
    data_dir: str | None = None,
    split: str | None = None,
    split_column: str | None = None,
    **options,
) -> DataFrame:
    """Read a dataset. `source` is a path or table files below it (`data_dir`).

    `split` picks the sub-folder `<path>/<split>` or, with `split_column`, the rows (or the
    partition folder) with that value. JSON needs a schema, so that no pass is spent on guessing,
    and a line that is no such JSON fails the job unless `mode` says otherwise.
    """
    if not source:
        raise ValueError("a dataset needs a source")
    if format == "json" and schema is None:
        raise ValueError("give a schema for JSON sources")
    path = "/".join(p for p in (source.rstrip("/"), data_dir) if p)
    if split is not None and split_column is None:
        path = _split_path(spark, path, split)
    if format == "json":
        options.setdefault("mode", "FAILFAST")
    reader = spark.read.format(format).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return df if split is None or split_column is None else select_split(df, split, split_column)


def _split_path(spark: SparkSession, path: str, split: str) -> str:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    chosen = jvm.org.apache.hadoop.fs.Path(folder, split)
    if not files.exists(chosen):
        found = files.listStatus(folder) if files.exists(folder) else []
        names = sorted(s.getPath().getName() for s in found if s.isDirectory())
        raise ValueError(f"no split {split!r}; valid splits: {names}")
    return chosen.toString()


def select_split(df: DataFrame, split: str, column: str = "split") -> DataFrame:
    """Rows of one split; a split that does not occur is an error that lists those that do, the
    first `_NAMED_SPLITS` of them."""
    chosen = df.where(F.col(column) == split)
    if chosen.isEmpty():
        names = df.select(column).distinct()
        count = names.count()
        listed = [r[0] for r in names.orderBy(column).limit(_NAMED_SPLITS).collect()]
        more = f" and {count - len(listed)} more" if count > len(listed) else ""
        raise ValueError(f"no split {split!r}; valid splits: {listed}{more}")
    return chosen


def has_content(df: DataFrame, column: str) -> Column:
    """True for text or lists that are neither null nor empty. White space counts as content."""
    value = F.col(column)
    filled = F.size(value) > 0 if isinstance(df.schema[column].dataType, T.ArrayType) else value != ""
    return value.isNotNull() & filled


def drop_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(has_content(df, column))


def keyed_rows(
    df: DataFrame, key: str = "text", text: str = "text", metrics: Observation | None = None
) -> DataFrame:
    """Rows with non-empty `text` whose field `key` is set; `key` is the field to tokenize.

    An empty text drops the row even if `key` names another field. `metrics` gets the counts
    `n_rows`, `n_empty` (no text) and `n_no_key` (text, but nothing to tokenize).
    """
    if key not in df.columns:
        raise ValueError(f"no column {key!r} to tokenize; columns: {df.columns}")
    filled = has_content(df, text) if text in df.columns else F.lit(True)
    if metrics is not None:
        df = df.observe(
            metrics,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~filled).alias("n_empty"),
            F.count_if(filled & F.col(key).isNull()).alias("n_no_key"),
        )
    return df.where(filled & F.col(key).isNotNull())
