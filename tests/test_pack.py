import pytest
from pyspark.sql import functions as F

from corploom.operators.tokenizing import tokenize_corpus
from corploom.plans.pack import Source, export, pack
from corploom.sources.token_store import TokenStore
from corploom.streaming.tokenizing import append_to_stage, tokenize_stream


@pytest.fixture
def sources(spark):
    a = spark.createDataFrame([(i, f"text {i} é") for i in range(40)] + [(90, ""), (91, None)], "id int, text string")
    b = spark.createDataFrame([("same",), ("same",), (" ",)], "text string")
    c = spark.createDataFrame([("t", ["one", "two"])], "text string, turns array<string>")
    none = spark.createDataFrame([], "id int, text string")
    return [
        Source("a", a, row_key="id"),
        Source("keyless", b),
        Source("parts", c, key="turns"),
        Source("none", none, row_key="id"),
    ]


def stream(rows):
    return sorted(t for r in rows for t in r.input_ids[: r.n_real])


TEXT = [f"text {i} é" for i in range(40)] + ["same", "same", " ", "onetwo"]
TOKENS = sorted(b + 1 for t in TEXT for b in t.encode())


@pytest.mark.parametrize(
    "options",
    [{"mode": "shuffle"}, {"mode": "concat"}, {"inverse_shuffle": True}, {"mode": "shuffle", "partitions": 3}],
)
def test_rechunked_modes_keep_every_token(sources, byte_vocab, options):
    packed = pack(sources, byte_vocab, chunk_size=16, splits=4, **options)
    rows = packed["train"].orderBy("pos").collect()
    assert stream(rows) == TOKENS
    assert [r.pos for r in rows] == list(range(len(rows)))
    assert all(len(r.input_ids) == 16 for r in rows)
    assert packed["test"].collect() == rows[:1]


def test_documents_stay_whole_without_rechunk(sources, byte_vocab):
    rows = pack(sources, byte_vocab, mode="concat", force_rechunk=False)["train"].orderBy("pos").collect()
    assert [r.source for r in rows] == ["a"] * 40 + ["keyless"] * 3 + ["parts"]
    assert bytes(t - 1 for t in rows[-1].input_ids) == b"onetwo"


def test_length_distribution_keeps_rows(sources, byte_vocab):
    train = pack(sources, byte_vocab, mode="dist_by_length", min_rows=5, min_subchunk=2)["train"]
    assert len(set(train.columns)) == len(train.columns)
    rows = train.collect()
    assert sorted(bytes(t - 1 for t in r.input_ids).decode() for r in rows) == sorted(TEXT)
    assert sorted(r.pos for r in rows) == list(range(len(TEXT)))


def test_packed_rows_go_to_the_store(spark, sources, byte_vocab, tmp_path):
    train = pack(sources, byte_vocab, mode="concat", force_rechunk=False, packed=True)["train"]
    export(train, "store", str(tmp_path))
    docs = TokenStore(spark, str(tmp_path)).documents().collect()
    assert sorted(bytes(t - 1 for t in r.input_ids).decode() for r in docs) == sorted(TEXT)


def test_arguments_are_checked(sources, byte_vocab):
    with pytest.raises(ValueError, match="not supported"):
        pack(sources, byte_vocab, mode="batch")
    with pytest.raises(ValueError, match="either"):
        pack(sources)
    with pytest.raises(ValueError, match="unique"):
        pack([sources[0], sources[0]], byte_vocab)


def test_own_tokenizer(sources):
    first = F.pandas_udf(lambda s: s.map(lambda t: [len(t)]), "array<int>")
    rows = pack(sources[:1], fn=first, mode="concat", chunk_size=8, splits=1)["train"].collect()
    assert sum(r.n_real for r in rows) == 40


def test_stream_gives_the_rows_of_the_batch(spark, byte_vocab, tmp_path):
    texts = spark.createDataFrame([(i, "" if i % 5 == 0 else f"line {i}") for i in range(20)], "k int, text string")
    texts.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    tokens = tokenize_stream(source, byte_vocab)
    query = append_to_stage(tokens, str(tmp_path / "out"), str(tmp_path / "offsets"))
    query.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 16
    expected = tokenize_corpus(texts.where("text <> ''"), byte_vocab).select("k", "input_ids")
    assert found.select("k", "input_ids").exceptAll(expected).isEmpty()


MODES = [
    {"mode": "shuffle", "force_rechunk": False},
    {"mode": "concat", "force_rechunk": False},
    {"mode": "dist_by_length", "min_rows": 2, "min_subchunk": 1},
    {"mode": "shuffle"},
    {"mode": "shuffle", "inverse_shuffle": True},
]


@pytest.mark.parametrize("options", MODES)
def test_missing_and_repeated_keys_are_refused(spark, byte_vocab, options):
    rows = [(None, "a"), (None, "b"), ("d", "c"), ("d", "e"), ("x", "f")]
    source = Source("s", spark.createDataFrame(rows, "k string, text string"), row_key="k")
    with pytest.raises(ValueError, match="'s': 2 rows have no key and 1 keys repeat"):
        pack([source], byte_vocab, **options)
    content = pack([Source("s", source.rows)], byte_vocab, **options)["train"].collect()
    assert sorted(bytes(t - 1 for r in content for t in r.input_ids if t)) == list(b"abcef")


def test_second_pack_reads_the_stage(spark, byte_vocab, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(9)], "k int, text string")
    reads = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def counted(text):
        reads.add(1)
        return [len(text)]

    def run(df, spec="one", **options):
        before = reads.value
        source = Source("s", df, row_key="k", **options)
        train = pack([source], fn=counted, mode="concat", chunk_size=4, splits=1,
                     stage_path=str(tmp_path / "kept"), spec=spec)["train"]
        return train.agg(F.sum("n_real")).first()[0], reads.value - before

    assert run(rows) == (9, 9)
    assert run(rows) == (9, 0)
    assert run(rows.withColumn("text", F.concat("text", F.lit("!")))) == (9, 9)
    assert run(rows, spec="two") == (9, 9)
    assert run(rows.where("k > 0"), spec="two") == (8, 8)
    with pytest.raises(ValueError, match="spec"):
        pack([Source("s", rows, row_key="k")], fn=counted, stage_path=str(tmp_path / "x"))


def test_another_vocabulary_makes_another_stage(spark, byte_vocab, tmp_path):
    source = Source("s", spark.createDataFrame([(1, "abab")], "k int, text string"), row_key="k")
    more = byte_vocab.select("token_id", "token").union(
        spark.createDataFrame([(300, bytearray(b"ab"))], "token_id int, token binary")
    )
    sizes = [
        pack([source], v, mode="concat", force_rechunk=False, stage_path=str(tmp_path / "kept"))["train"]
        .first().n_tokens
        for v in (byte_vocab, more, byte_vocab)
    ]
    assert sizes == [4, 2, 4]


@pytest.mark.parametrize("kept", [False, True])
def test_dropped_rows_are_counted(spark, byte_vocab, tmp_path, kept):
    rows = [(1, "a", "x"), (2, "", "x"), (3, None, "x"), (4, "b", None)]
    df = spark.createDataFrame(rows, "k int, text string, field string")
    metrics = {}
    path = str(tmp_path / "kept") if kept else None
    pack([Source("s", df, "field", "k")], byte_vocab, metrics=metrics, stage_path=path)
    assert metrics["s"].get == {"n_rows": 4, "n_empty": 2, "n_no_key": 1}
