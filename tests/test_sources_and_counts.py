import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.operators import counting
from corploom.sources.datasets import drop_empty, keyed_rows, scan, select_split
from corploom.sources.json_lines import parse_lines, raw_lines


@pytest.fixture
def split_folder(spark, tmp_path):
    for name, n in (("train", 3), ("test", 1)):
        spark.range(n).select(F.col("id").cast("string").alias("text")).write.json(str(tmp_path / name))
    return str(tmp_path)


def test_scan_of_a_split_folder(spark, split_folder):
    assert scan(spark, split_folder, schema="text string", split="train").count() == 3
    with pytest.raises(ValueError, match=r"\['test', 'train'\]"):
        scan(spark, split_folder, schema="text string", split="dev")


def test_scan_needs_source_and_schema(spark):
    for source in (None, ""):
        with pytest.raises(ValueError, match="source"):
            scan(spark, source, schema="text string")
    with pytest.raises(ValueError, match="schema"):
        scan(spark, "/somewhere")


def test_split_column(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string")
    assert [r.text for r in select_split(df, "test").collect()] == ["b"]
    with pytest.raises(ValueError, match=r"\['test', 'train'\]"):
        select_split(df, "dev")


def test_split_filter_and_columns_reach_the_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = keyed_rows(docs.where(F.col("lang") == "en")).select("text")._jdf.queryExecution().toString()
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<text:string,lang:string>" in plan


def test_only_null_and_empty_texts_are_dropped(spark):
    rows = [(0, None), (1, ""), (2, " "), (3, "a\n\"b\""), (4, "é")]
    df = spark.createDataFrame(rows, "k int, text string")
    assert sorted(r.k for r in drop_empty(df).collect()) == [2, 3, 4]
    lists = spark.createDataFrame([(0, None), (1, []), (2, [""])], "k int, text array<string>")
    assert [r.k for r in drop_empty(lists).collect()] == [2]


def test_key_field(spark):
    df = spark.createDataFrame([("x", "h"), ("", "h"), ("y", None)], "text string, html string")
    assert [r.text for r in keyed_rows(df, "html").collect()] == ["x"]
    metrics = Observation()
    assert keyed_rows(df, "html", metrics=metrics).count() == 1
    assert metrics.get == {"n_rows": 3, "n_empty": 1, "n_no_key": 1}
    with pytest.raises(ValueError, match="no column"):
        keyed_rows(df, "body")


def test_json_lines(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text('{"a": 1}\nnot json\n  \n{"a": 2, "b": 3}\n')
    lines = raw_lines(spark, str(path))
    assert counting.row_count(counting.nonblank_lines(lines)).first().n_rows == 3
    parsed = parse_lines(counting.nonblank_lines(lines), T.StructType([T.StructField("a", T.IntegerType())]))
    assert sorted((r.a, r["_corrupt"]) for r in parsed.collect() if r.a) == [(1, None), (2, None)]
    assert [r["_corrupt"] for r in parsed.where("a is null").collect()] == ["not json"]
    with pytest.raises(AnalysisException):
        raw_lines(spark, str(tmp_path / "missing.jsonl"))


def test_bounded_count(spark):
    assert counting.bounded_count(spark.range(5), 5) == 5
    assert counting.bounded_count(spark.range(5), 4) == -1
    assert counting.bounded_count(spark.range(0), 0) == 0


def test_stage_reuse(spark, tmp_path):
    path = str(tmp_path / "stage")
    texts = spark.createDataFrame([("a",), ("b",)], "text string")
    assert not counting.stage_reusable(path, texts, ["text"])
    texts.write.parquet(path)
    counting.save_fingerprint(path, texts, ["text"], "v1")
    assert counting.stage_reusable(path, texts.repartition(2), ["text"], "v1")
    assert not counting.stage_reusable(path, texts, ["text"], "v2")
    assert not counting.stage_reusable(path, texts.replace("b", "c"), ["text"], "v1")
    assert not counting.stage_reusable(path, texts.union(texts), ["text"], "v1")


def test_broken_json_stops_the_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text": "x"}\n{"text": \n{"text": "y"}\nno json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan(spark, str(tmp_path), "json", "text string").collect()
    kept = scan(spark, str(tmp_path), "json", "text string", mode="DROPMALFORMED")
    assert sorted(r.text for r in kept.collect() if r.text) == ["x", "y"]


def test_all_splits_are_named(spark):
    df = spark.range(150).selectExpr("concat('s', id) as split")
    with pytest.raises(ValueError) as error:
        select_split(df, "none")
    assert all(f"'s{i}'" in str(error.value) for i in range(150))


def test_vocabulary_size_is_checked(spark):
    from corploom.sources.vocabulary import encoding_table

    vocab = spark.range(100_000).selectExpr("cast(id as int) as token_id", "encode(cast(id as string), 'UTF-8') as token")
    assert len(encoding_table(vocab)) == 100_000
    with pytest.raises(ValueError, match="max_bytes"):
        encoding_table(vocab, max_bytes=1000)


def test_an_unknown_split_names_some_of_many(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as split")
    with pytest.raises(ValueError, match="and 4000 more"):
        select_split(df, "none")
