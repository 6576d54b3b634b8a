import os
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_texts import TEXTS  # noqa: E402

# Names of result and helper columns, so that every operator meets its own.
CLASHES = (
    "quality secrets licenses pii leaks ids decoded shard slot n_words n_removed kept_text class_key "
    "text_key host path rule layer verdict label key pos tokens n band anchor leader score kinds found"
).split()

@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) with the other columns of documents and clashing ones."""

    def build(rows, partitions=3):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        full = [
            (i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None)
            for k, (i, t) in enumerate(rows)
        ]
        df = spark.createDataFrame(full, schema).repartition(partitions)
        return df.withColumns({name: F.lit("x") for name in CLASHES})

    return build


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(TEXTS)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], T.StructType(edge_docs.schema.fields))
