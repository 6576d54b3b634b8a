import hashlib
import os

import pytest
from pyspark.sql import functions as F

from corploom.functions.keys import with_content_keys
from corploom.operators.mixing import concat_sources, mix_concat, mix_shuffle
from corploom.operators.ordering import shuffle_rows
from corploom.operators.running_totals import running_totals_by_position, with_running_totals
from corploom.staging import remove_stages, stage, stage_root


def keys_in_order(df, key="k"):
    return [r[key] for r in df.orderBy("pos").collect()]


@pytest.mark.parametrize("seed, order", [(101, [1, 3, 5, 2, 0, 4]), (102, [1, 0, 4, 5, 3, 2])])
def test_seeded_order(spark, seed, order):
    df = spark.range(6).withColumnRenamed("id", "k")
    assert keys_in_order(shuffle_rows(df, ["k"], seed)) == order


@pytest.mark.parametrize("partitions, bits", [(1, 1), (4, 6), (8, 12)])
def test_order_does_not_depend_on_partitions_or_buckets(spark, partitions, bits):
    df = spark.range(500).withColumnRenamed("id", "k").repartition(partitions)
    weighted = df.withColumn("n", F.col("k") % 7)
    placed = shuffle_rows(weighted, ["k"], sums={"start": "n"}, bits=bits).orderBy("pos").collect()
    expected = sorted(range(500), key=lambda k: hashlib.md5(f"101:{k}".encode()).hexdigest())
    assert [r.k for r in placed] == expected
    assert [r.pos for r in placed] == list(range(500))
    starts = [sum(k % 7 for k in expected[:i]) for i in range(500)]
    assert [r.start for r in placed] == starts


def test_sources_stay_in_order_and_hot_source_is_split(spark):
    big = spark.range(1000).select(F.col("id").cast("string").alias("row_key"))
    small = spark.range(3).select(F.col("id").cast("string").alias("row_key"))
    rows = concat_sources({"big": big, "none": big.limit(0), "small": small})
    placed = shuffle_rows(rows, ["source_ord", "row_key"], within=["source_ord"])
    found = placed.orderBy("pos").collect()
    assert [r.source for r in found] == ["big"] * 1000 + ["small"] * 3
    assert [r.pos for r in found] == list(range(1003))
    assert [r.row_key for r in found[:1000]] != [str(i) for i in range(1000)]


def test_sources_need_distinct_names(spark):
    with pytest.raises(ValueError):
        concat_sources({"": spark.range(1)})
    with pytest.raises(ValueError):
        concat_sources({})


def test_running_totals_by_levels_and_by_position(spark):
    rows = [(a, b, c, a + b + c) for a in range(3) for b in range(4) for c in range(5)]
    df = spark.createDataFrame(rows, "a int, b int, c int, n int").repartition(5)
    totals = with_running_totals(df, [["a"], ["b"]], ["c"], {"before": "n"}).orderBy("pos").collect()
    assert [(r.a, r.b, r.c) for r in totals] == [r[:3] for r in rows]
    assert [r.before for r in totals] == [sum(r[3] for r in rows[:i]) for i in range(60)]
    again = running_totals_by_position(
        spark.range(70).select(F.col("id").alias("pos"), (F.col("id") % 3).alias("n")), {"before": "n"}, block_bits=2
    )
    assert [r.before for r in again.orderBy("pos").collect()] == [sum(j % 3 for j in range(i)) for i in range(70)]


def test_rows_without_keys(spark):
    texts = ["hot"] * 25_000 + ["a", "b", "b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    keyed = with_content_keys(df, ["text"])
    assert keyed.groupBy("text").count().collect() and keyed.count() == len(texts)
    assert keyed.select("row_key").distinct().count() == len(texts)
    hot = hashlib.md5(b"hot").hexdigest()
    assert keyed.where(F.col("row_key") == f"{hot}:24999").count() == 1
    again = with_content_keys(df.repartition(7), ["text"])
    assert keyed.exceptAll(again).isEmpty()


def test_stages_lie_in_the_shared_folder(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3), "numbers")
    (path,) = {f.removeprefix("file://").rpartition("/")[0] for f in staged.inputFiles()}
    assert path.startswith(stage_root(spark)) and staged.count() == 3
    remove_stages(spark)
    assert not os.path.exists(path) and os.path.exists(stage_root(spark))


def test_packed_ids_move_compressed(spark):
    from corploom.functions.packed_ids import moved_small

    rows = [(i, None if i == 3 else bytearray((i % 50 + 1).to_bytes(4, "little") * 1000 * (i % 4))) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, tokens binary")
    seen = []
    moved = moved_small(df, lambda inner: seen.append(inner) or inner.repartition(3, "k"))
    assert dict(map(tuple, moved.collect())) == dict(rows)
    size = F.sum(F.octet_length("tokens"))
    assert seen[0].agg(size).first()[0] * 20 < df.agg(size).first()[0]
    plan = moved_small(df, lambda inner: inner.repartition(3, "k")).select("k")
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_mixed_tokens_shuffle_compressed(spark):
    df = spark.range(50).selectExpr(
        "cast(0 as int) source_ord", "'s' source", "cast(id as string) row_key", "cast(1000 as int) n_tokens",
        "cast(repeat('a\\\\0\\\\0\\\\0', 1000) as binary) tokens",
    )
    for mix in (mix_concat, mix_shuffle):
        mixed = mix(df)
        assert mixed.select("tokens").distinct().count() == 1
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert "_unsqueeze" in plan and "_squeeze" in plan[plan.index("Exchange") :]
