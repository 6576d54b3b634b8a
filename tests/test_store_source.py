"""Token stores through Spark's data source interface."""

import pickle

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from corploom.plans.pack import export
from corploom.sources import store_source
from corploom.sources.store_source import TokenStoreReader, read_store

DOCS = [[k] * (k % 7) for k in range(100)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "store")
    df = spark.createDataFrame(list(enumerate(DOCS)), "pos bigint, input_ids array<int>").repartition(3)
    export(df, "store", path, shard_bytes=90)
    return path


def rows(reader):
    found = {}
    for part in pickle.loads(pickle.dumps(reader.partitions())):
        for batch in reader.read(part):
            for doc, ids in zip(batch["doc_ord"].to_pylist(), batch["input_ids"].to_pylist()):
                assert doc not in found
                found[doc] = ids
    return found


@pytest.mark.parametrize("read_bytes", [1, 8, 30, 1 << 20])
def test_all_documents(store, read_bytes):
    assert rows(TokenStoreReader(store, read_bytes)) == dict(enumerate(DOCS))


def test_conditions_narrow_what_is_read(store, monkeypatch):
    read = []

    class Counting:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, count, at):
            read.append((count, at))
            return self.file.read_at(count, at)

    class Files:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def open_input_file(self, path):
            file = self.files.open_input_file(path)
            return Counting(file) if path.endswith(".bin") else file

    original = store_source.open_folder
    monkeypatch.setattr(store_source, "open_folder", lambda uri: (Files(original(uri)[0]), original(uri)[1]))
    column = ("doc_ord",)
    reader = TokenStoreReader(store)
    left = list(reader.pushFilters([ds.GreaterThanOrEqual(column, 40), ds.LessThan(column, 43), ds.IsNull(column)]))
    assert left == [ds.IsNull(column)]
    assert rows(reader) == {k: DOCS[k] for k in (40, 41, 42)}
    assert sum(count for count, _ in read) == 2 * sum(len(DOCS[k]) for k in (40, 41, 42))
    shards = len({p.shard for p in TokenStoreReader(store).partitions()})
    assert len({p.shard for p in reader.partitions()}) <= 2 < shards


@pytest.mark.parametrize(
    "condition, wanted",
    [
        (ds.EqualTo(("doc_ord",), 7), [7]),
        (ds.EqualTo(("doc_ord",), -1), []),
        (ds.GreaterThan(("doc_ord",), 97), [98, 99]),
        (ds.LessThanOrEqual(("doc_ord",), 1), [0, 1]),
        (ds.EqualTo(("doc_ord",), 1000), []),
    ],
)
def test_single_conditions(store, condition, wanted):
    reader = TokenStoreReader(store)
    assert list(reader.pushFilters([condition])) == []
    assert rows(reader) == {k: DOCS[k] for k in wanted}


def test_in_spark(spark, store):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    docs = read_store(spark, store, read_bytes=50)
    assert {r.doc_ord: r.input_ids for r in docs.collect()} == dict(enumerate(DOCS))
    some = docs.where("doc_ord between 10 and 12 or doc_ord in (50, 99)")
    assert sorted(r.doc_ord for r in some.collect()) == [10, 11, 12, 50, 99]
    picked = docs.where("doc_ord in (3, 90) and size(input_ids) > 4")
    assert [r.doc_ord for r in picked.collect()] == [90]
    assert docs.where("doc_ord >= 96").count() == 4


def test_items_are_joined_and_other_files_refused(spark, tmp_path):
    items = [[[1], [2, 3]], [], [[], [4]], [[]], []]
    df = spark.createDataFrame(list(enumerate(items)), "pos bigint, input_ids array<array<int>>")
    export(df, "store", str(tmp_path / "items"), shard_bytes=5)
    flat = {k: sum(doc, []) for k, doc in enumerate(items)}
    assert rows(TokenStoreReader(str(tmp_path / "items"), 2)) == flat
    docs = read_store(spark, str(tmp_path / "items")).withColumn("n", F.size("input_ids"))
    assert {r.doc_ord: r.n for r in docs.collect()} == {k: len(ids) for k, ids in flat.items()}
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "shard-00000.idx").write_bytes(b"x" * 50)
    (bad / "shard-00000.bin").write_bytes(b"")
    with pytest.raises(ValueError, match="not an index"):
        TokenStoreReader(str(bad)).partitions()
