"""JSON lines, raw or parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN_ROWS = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("token_type_ids", T.ArrayType(T.ByteType())),
        T.StructField("attention_mask", T.ArrayType(T.ByteType())),
    ]
)


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, as text in `value`. A missing file is an error."""
    return spark.read.text(path)


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Fields of JSON objects. A line that is no such object has null fields and `_corrupt` text."""
    bad = "_corrupt"
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return lines.select(parsed.alias("row")).select("row.*")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = TOKEN_ROWS) -> DataFrame:
    """Parsed rows; a bad line stops the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
