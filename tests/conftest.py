import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package from here.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("corploom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ordered_ids(spark):
    """Rows of ids with positions in the given order."""

    def build(rows, partitions=3):
        schema = "pos bigint, input_ids array<int>"
        return spark.createDataFrame(list(enumerate(rows)), schema).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def byte_vocab(spark):
    from workload.queries import byte_vocabulary

    return byte_vocabulary(spark)


@pytest.fixture(scope="session")
def documents(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    return spark.read.parquet(path).select(F.col("doc_id").cast("string").alias("row_key"), "text")
