import glob
import json
import os
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from corploom.functions.packed_ids import line_bytes, pack_ids
from corploom.operators.rechunking import rechunk
from corploom.plans.pack import export
from corploom.sinks.arrow_shards import manifest_features, read_arrow_shards
from corploom.sinks.shards import with_shards
from corploom.sinks.token_store import document_index, store_index
from corploom.sources.json_lines import read_json_lines
from corploom.sources.token_store import ItemStore, TokenStore
from corploom.staging import stage

DOCS = [[10, 11, 12], [20, 21], [30, 31, 32, 33]]


def test_store_pair_is_byte_exact(spark, ordered_ids, tmp_path):
    path = str(tmp_path / "store")
    index = export(ordered_ids(DOCS), "store", path)
    assert [(r.size, r.shard_pointer) for r in index.orderBy("doc_ord").collect()] == [(3, 0), (2, 6), (4, 10)]
    data = open(f"{path}/shard-00000.bin", "rb").read()
    assert data == np.array(sum(DOCS, []), np.uint16).tobytes() and len(data) == 18
    header = b"MMIDIDX\x00\x00" + struct.pack("<Q", 1) + struct.pack("<B", 8) + struct.pack("<QQ", 3, 4)
    arrays = [np.array([3, 2, 4], np.int32), np.array([0, 6, 10], np.int64), np.array([0, 1, 2, 3], np.int64)]
    expected = header + b"".join(a.tobytes() for a in arrays)
    assert open(f"{path}/shard-00000.idx", "rb").read() == expected and len(expected) == 102
    assert not glob.glob(f"{path}/.*bin*")


def test_store_reads(spark, ordered_ids, tmp_path):
    path = str(tmp_path / "store")
    export(ordered_ids(DOCS), "store", path, shard_bytes=8)
    assert len(glob.glob(f"{path}/*.bin")) == 2
    store = TokenStore(spark, path)

    def ids(df):
        return [r.input_ids for r in df.orderBy("doc_ord").collect()]

    assert len(store) == 3
    assert ids(store.documents()) == DOCS
    assert ids(store.item(1)) == [[20, 21]] and ids(store.item(-1)) == [DOCS[2]]
    assert ids(store.slice(1, 3)) == DOCS[1:] and ids(store.slice(-2)) == DOCS[1:]
    assert ids(store.get(2, offset=1, length=2)) == [[31, 32]]
    assert ids(store.get(2, offset=3)) == [[33]] and ids(store.get(0, 2, 50)) == [[12]]
    with pytest.raises(ValueError, match="contiguous"):
        store.slice(0, 3, 2)
    for i in (3, -4):
        with pytest.raises(IndexError, match="no document"):
            store.item(i)
    with pytest.raises(ValueError, match="negative"):
        store.get(2, offset=-2)


def test_store_refuses_large_ids_and_chunks(ordered_ids, tmp_path):
    with pytest.raises(PythonException, match="65536 does not fit"):
        export(ordered_ids([[1], [65_536]]), "store", str(tmp_path / "a"))
    with pytest.raises(ValueError, match="whole documents"):
        export(rechunk(ordered_ids(DOCS), 4), "store", str(tmp_path / "b"))


def test_old_shards_are_not_mixed_with_new_ones(ordered_ids, tmp_path):
    for fmt in ("store", "arrow", "json", "parquet"):
        export(ordered_ids(DOCS), fmt, str(tmp_path / fmt))
        with pytest.raises(ValueError, match="not empty"):
            export(ordered_ids(DOCS[:1]), fmt, str(tmp_path / fmt))


def test_pointers_and_document_index(spark, ordered_ids):
    packed = ordered_ids(DOCS).select("pos", pack_ids("input_ids").alias("tokens"))
    assert [(r.size, r.pointer) for r in store_index(packed).orderBy("doc_ord").collect()] == [(3, 0), (2, 6), (4, 10)]
    items = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("c", 3), ("c", 4)], "doc string, pos bigint")
    ends = {r.doc: r.doc_end for r in document_index(items).collect()}
    assert ends == {"a": 2, "b": 3, "c": 5}


@pytest.mark.parametrize("block_bits, broadcast", [(16, 1_000_000), (2, 1_000_000), (2, 0)])
def test_shards_hold_whole_rows(spark, monkeypatch, block_bits, broadcast):
    from corploom.sinks import shards

    monkeypatch.setattr(shards, "_BLOCK_BITS", block_bits)
    monkeypatch.setattr(shards, "_BROADCAST_CUTS", broadcast)
    sizes = [30, 50, 40, 500, 10, 10, 90, 1, 99, 20, 70, 5]
    df = stage(spark.createDataFrame(list(enumerate(sizes)), "pos bigint, row_bytes bigint"), "rows")
    found = with_shards(df, 100).orderBy("pos").collect()
    assert [r.shard for r in found] == [sum(sizes[:i]) // 100 for i in range(len(sizes))]


def test_arrow_shards(spark, ordered_ids, tmp_path):
    path = str(tmp_path / "arrow")
    chunks = rechunk(ordered_ids([[i] * 7 for i in range(1, 40)]), 8, 3)
    manifest = export(chunks, "arrow", path, shard_bytes=300)
    rows = manifest_features(manifest).orderBy("split", "shard").collect()
    assert rows[0].split == "test" and rows[0].n_rows == 1
    assert rows[0].features == "input_ids: list<item: int32>, token_type_ids: list<item: int8>, attention_mask: list<item: int8>"
    for row in rows:
        file = f"{path}/{row.split}/{row.file}"
        table = pa.ipc.open_stream(file).read_all()
        assert os.path.getsize(file) == row.n_bytes and table.num_rows == row.n_rows
        assert table.schema.field("attention_mask").type == pa.list_(pa.int8())
    expected = [
        (c.input_ids, [0] * c.n_real, [1] * c.n_real + [0] * (8 - c.n_real)) for c in chunks.orderBy("pos").collect()
    ]
    back = read_arrow_shards(spark, path).orderBy("shard", "row").collect()
    assert [(r.input_ids, r.token_type_ids, r.attention_mask) for r in back] == expected
    first = read_arrow_shards(spark, path, "test").collect()
    assert [r.input_ids for r in first] == [expected[0][0]]


def test_shards_are_read_by_many_tasks(spark, ordered_ids, tmp_path):
    """A list of file names is small, the files are not: each task reads its share of them."""
    path = str(tmp_path / "out")
    chunks = rechunk(ordered_ids([[i] * 7 for i in range(1, 40)]), 8, 3)
    files = export(chunks, "arrow", path, shard_bytes=300).where("split = 'train'").count()
    back = read_arrow_shards(spark, path).select("shard", F.spark_partition_id().alias("task")).distinct()
    tasks = {row.shard: row.task for row in back.collect()}
    wanted = min(files, spark.sparkContext.defaultParallelism)
    assert wanted > 1 and len(set(tasks.values())) == wanted and len(tasks) == files


def test_json_lines_in_order(spark, ordered_ids, tmp_path):
    path = str(tmp_path / "json")
    export(ordered_ids([[i, i] for i in range(50)]), "json", path)
    lines = [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f)]
    assert [json.loads(line)["input_ids"][0] for line in lines] == list(range(50))
    assert json.loads(lines[0]) == {"input_ids": [0, 0], "token_type_ids": [0, 0], "attention_mask": [1, 1]}
    assert read_json_lines(spark, path).count() == 50
    measured = ordered_ids([[i, i] for i in range(50)]).select(line_bytes(pack_ids("input_ids")).alias("n"))
    assert measured.agg(F.sum("n")).first()[0] == sum(map(len, lines))


def test_parquet_and_unknown_format(spark, ordered_ids, tmp_path):
    path = str(tmp_path / "parquet")
    export(ordered_ids(DOCS), "parquet", path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError, match="unknown export"):
        export(ordered_ids(DOCS), "csv", path)


def test_documents_without_ids_fill_shards_too(spark, ordered_ids, tmp_path, monkeypatch):
    from corploom.sinks import token_store

    monkeypatch.setattr(token_store, "_INDEX_ROWS", 3)
    rows = [[]] * 40 + [[1] * 30] + [[]] * 5
    index = export(ordered_ids(rows), "store", str(tmp_path / "store"), shard_bytes=8)
    per_shard = index.groupBy("shard").count().collect()
    assert max(r["count"] for r in per_shard) <= 8
    store = TokenStore(spark, str(tmp_path / "store"))
    assert [r.input_ids for r in store.documents().orderBy("doc_ord").collect()] == rows


def test_paths_mean_what_they_mean_to_spark(spark, tmp_path, monkeypatch):
    from corploom.sinks.files import worker_uri

    assert worker_uri(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert worker_uri(spark, "some/folder") == f"file://{os.getcwd()}/some/folder"
    assert worker_uri(spark, "s3a://bucket/a/b/") == "s3://bucket/a/b"
    with pytest.raises(ValueError, match="tasks cannot write to dbfs"):
        worker_uri(spark, "dbfs://x/y")


def test_unknown_file_systems_are_refused_before_any_job(spark, ordered_ids):
    with pytest.raises(ValueError, match="tasks cannot write"):
        export(ordered_ids(DOCS), "arrow", "viewfs2://x/y")


def test_relative_paths(spark, ordered_ids, tmp_path):
    path = os.path.relpath(tmp_path / "store")
    export(ordered_ids(DOCS), "store", path)
    docs = TokenStore(spark, path).documents().orderBy("doc_ord").collect()
    assert [r.input_ids for r in docs] == DOCS


def test_missing_or_cut_files_are_found(spark, ordered_ids, tmp_path):
    from corploom.sinks.files import check_files

    (tmp_path / "a").write_bytes(b"123")
    check_files(spark, str(tmp_path), {"a": 3})
    for wrong in ({"a": 4}, {"b": 3}):
        with pytest.raises(RuntimeError, match="as written"):
            check_files(spark, str(tmp_path), wrong)


def test_only_packed_tokens_are_moved_for_export(spark, ordered_ids, capsys):
    from corploom.sinks.token_rows import ordered_rows

    plan = ordered_rows(ordered_ids(DOCS))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Repartition")] if "Repartition" in plan else plan
    assert "input_ids" in above and "tokens" in plan
    assert "RangePartitioning" not in plan and plan.count("ArrowEvalPython") == 1


def filled_plainly(sizes, limit):
    shards, held = [], 0
    for size in sizes:
        if held > limit:
            held = 0
        shards.append(shards[-1] + (held == 0) if shards else 0)
        held += size
    return shards


@pytest.mark.parametrize("case", range(5))
def test_shards_filled_to_the_limit(spark, monkeypatch, case):
    from corploom.sinks import shards

    random.seed(case)
    monkeypatch.setattr(shards, "_STRETCH_ROWS", [1, 3, 10, 1 << 16, 2][case])
    monkeypatch.setattr(shards, "_BLOCK_BITS", [16, 1, 3, 16, 2][case])
    monkeypatch.setattr(shards, "_BROADCAST_CUTS", [1_000_000, 0, 1_000_000, 0, 1_000_000][case])
    sizes = [
        [50] + [200] * 40,
        [random.choice([1, 5, 30, 50, 99, 100, 101, 102, 200, 201, 1000]) for _ in range(120)],
        [random.randint(1, 30) for _ in range(200)],
        [100, 1, 100, 1, 101, 100],
        [7],
    ][case]
    df = stage(spark.createDataFrame(list(enumerate(sizes)), "pos bigint, row_bytes bigint").repartition(3), "rows")
    found = with_shards(df, 100, filled=True).orderBy("pos").collect()
    assert [r.shard for r in found] == filled_plainly(sizes, 100)


@pytest.mark.parametrize("filled", [True, False])
def test_rows_look_up_few_cuts_if_each_row_fills_a_shard(spark, monkeypatch, filled):
    from corploom.sinks import shards

    tables = []
    monkeypatch.setattr(shards.F, "broadcast", lambda df: tables.append(df) or df)
    df = stage(spark.range(3000).selectExpr("id as pos", "200 as row_bytes"), "rows")
    found = with_shards(df, 100, filled=filled).agg(F.count_distinct("shard")).first()[0]
    assert found == 3000
    cuts = next(t for t in tables if "_cuts" in t.columns)
    assert cuts.agg(F.max(F.size("_cuts"))).first()[0] <= 300


def test_filled_exports(spark, ordered_ids, tmp_path):
    export(ordered_ids(DOCS * 3), "store", str(tmp_path / "store"), shard_bytes=8, filled=True)
    held = [os.path.getsize(f) for f in sorted(glob.glob(f"{tmp_path}/store/*.bin"))]
    assert held == [10, 14, 12, 10, 8]
    empty = with_shards(stage(spark.createDataFrame([], "pos bigint, row_bytes bigint"), "none"), 8, filled=True)
    assert empty.count() == 0


ITEM_DOCS = [[[10, 11], [12]], [], [[20]], [[], [30, 31, 32]], []]


def test_documents_of_several_items(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame(list(enumerate(ITEM_DOCS)), "pos bigint, input_ids array<array<int>>").repartition(3)
    export(df, "store", path)
    header = b"MMIDIDX\x00\x00" + struct.pack("<QBQQ", 1, 8, 5, 6)
    sizes, pointers = np.array([2, 1, 1, 0, 3], np.int32), np.array([0, 4, 6, 8, 8], np.int64)
    ends = np.array([0, 2, 2, 3, 5, 5], np.int64)
    expected = header + b"".join(a.tobytes() for a in (sizes, pointers, ends))
    assert open(f"{path}/shard-00000.idx", "rb").read() == expected
    assert np.fromfile(f"{path}/shard-00000.bin", np.uint16).tolist() == [10, 11, 12, 20, 30, 31, 32]


@pytest.mark.parametrize("rows", [1, 2, 1 << 16])
def test_items_and_documents_read_back(spark, tmp_path, monkeypatch, rows):
    from corploom.sinks import token_store

    monkeypatch.setattr(token_store, "_INDEX_ROWS", rows)
    df = spark.createDataFrame(list(enumerate(ITEM_DOCS)), "pos bigint, input_ids array<array<int>>").repartition(3)
    export(df, "store", str(tmp_path / "store"), shard_bytes=4)
    assert len(glob.glob(f"{tmp_path}/store/*.bin")) > 2
    store = ItemStore(spark, str(tmp_path / "store"))
    assert [r.input_ids for r in store.documents().orderBy("doc_ord").collect()] == ITEM_DOCS
    items = [(r.doc_ord, r.item, r.input_ids) for r in store.items().orderBy("item_ord").collect()]
    assert items == [(d, i, ids) for d, doc in enumerate(ITEM_DOCS) for i, ids in enumerate(doc)]
    assert [r.input_ids for r in store.item(4).collect()] == [[30, 31, 32]]
    assert [r.input_ids for r in store.document(1).collect()] == [[]]


def test_a_failed_export_leaves_nothing(spark, tmp_path):
    """One document that the store cannot hold, in a shard of its own."""
    rows = [[i] * 50 for i in range(200)] + [[70_000]]
    df = spark.createDataFrame(list(enumerate(rows)), "pos bigint, input_ids array<int>").repartition(4)
    for fmt in ("store", "arrow"):
        path = tmp_path / fmt
        bad = df if fmt == "store" else df.withColumn("input_ids", F.when(F.col("pos") < 200, F.col("input_ids")))
        bad = bad if fmt == "store" else bad.withColumn("n_real", F.when(F.col("pos") < 200, 50))
        with pytest.raises(Exception):
            export(bad, fmt, str(path), shard_bytes=500)
        assert not list(tmp_path.iterdir())
        path.mkdir()
        export(df.where("pos < 200"), fmt, str(path), shard_bytes=500)
        assert len(glob.glob(f"{path}/**/*.bin", recursive=True) + glob.glob(f"{path}/train/*.arrow")) > 20
        assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".")] == []
        for made in tmp_path.iterdir():
            made.rename(tmp_path.parent / f"{tmp_path.name}-{fmt}")
