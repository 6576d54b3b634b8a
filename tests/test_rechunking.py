import pytest
from pyspark.sql import functions as F

from corploom.operators.ordering import shuffle_rows
from corploom.operators.rechunking import rechunk, with_chunk_masks, with_splits
from corploom.staging import stage


def packed(df, **options):
    rows = with_chunk_masks(rechunk(df, **options)).orderBy("pos").collect()
    return [(r.input_ids, r.token_type_ids, r.attention_mask) for r in rows]


def test_rows_are_joined_and_the_tail_padded(ordered_ids):
    rows = packed(ordered_ids([[1, 2, 3], [4, 5], [6, 7, 8, 9]]), size=4, splits=1)
    assert rows == [
        ([1, 2, 3, 4], [0] * 4, [1] * 4),
        ([5, 6, 7, 8], [0] * 4, [1] * 4),
        ([9, 0, 0, 0], [0], [1, 0, 0, 0]),
    ]


def test_exact_multiple_has_no_row_of_padding(ordered_ids):
    rows = packed(ordered_ids([[1, 2, 3], [4, 5, 6, 7, 8]]), size=4, splits=1)
    assert [r[0] for r in rows] == [[1, 2, 3, 4], [5, 6, 7, 8]]


def test_split_without_tokens_gives_one_row_of_padding(ordered_ids):
    assert packed(ordered_ids([[], [], []]), size=4, splits=1) == [([0] * 4, [], [0] * 4)]
    rows = rechunk(ordered_ids([[1], [], [2], [3]]), size=2, splits=4).orderBy("pos").collect()
    assert [(r.split_id, r.chunk_id, r.n_real, r.input_ids) for r in rows] == [
        (0, 0, 1, [1, 0]),
        (1, 0, 0, [0, 0]),
        (2, 0, 1, [2, 0]),
        (3, 0, 1, [3, 0]),
    ]


def test_padding_of_token_types_is_an_option(ordered_ids):
    chunks = rechunk(ordered_ids([[7]]), size=3, splits=1)
    assert with_chunk_masks(chunks, pad_token_types=True).first().token_type_ids == [0, 0, 0]


def test_no_rows_give_no_chunks(ordered_ids):
    assert packed(ordered_ids([]), size=4) == []


def test_id_zero_in_the_text_is_real(ordered_ids):
    (row,) = rechunk(ordered_ids([[5, 0]]), size=4, splits=1).collect()
    assert (row.input_ids, row.n_real) == ([5, 0, 0, 0], 2)


@pytest.mark.parametrize(
    "n_rows, per_run, runs", [(30, 1, 30), (59, 1, 59), (100, 3, 34), (1000, 33, 31), (29, 29, 1)]
)
def test_split_rule(spark, n_rows, per_run, runs):
    split = with_splits(spark.range(n_rows).withColumnRenamed("id", "pos"), 30)
    sizes = [r["count"] for r in split.groupBy("split_id").count().orderBy("split_id").collect()]
    assert len(sizes) == runs
    assert set(sizes[:-1]) <= {per_run} and sizes[-1] <= per_run


def brute_force(rows, size, splits):
    per_run = len(rows) if len(rows) < splits else len(rows) // splits
    out = []
    for a in range(0, len(rows), per_run):
        stream = [t for row in rows[a : a + per_run] for t in row]
        cuts = [stream[i : i + size] for i in range(0, len(stream), size)] or [[]]
        out += [c + [0] * (size - len(c)) for c in cuts]
    return out


@pytest.mark.parametrize("partitions, splits", [(1, 1), (4, 3), (8, 7)])
def test_against_brute_force_for_any_partitioning(ordered_ids, partitions, splits):
    sizes = [0, 1, 57, 3, 0, 8, 8, 120, 2, 16, 0, 0, 5, 31]
    rows, at = [], 1
    for n in sizes * 3:
        rows.append(list(range(at, at + n)))
        at += n
    chunks = packed(ordered_ids(rows, partitions), size=8, splits=splits)
    assert [c[0] for c in chunks] == brute_force(rows, 8, splits)


def test_one_row_may_hold_most_tokens(ordered_ids):
    long = list(range(1, 50_001))
    rows = packed(ordered_ids([[1], long, [2]]), size=2048, splits=1)
    assert [r[0] for r in rows] == brute_force([[1], long, [2]], 2048, 1)


def test_tokens_reach_chunks_by_hash_exchange_only(spark, ordered_ids):
    """No task sees all token rows: single-task exchanges hold totals only."""
    df = ordered_ids([[1, 2], [3]]).withColumn("row_key", F.col("pos").cast("string")).drop("pos")
    ordered = shuffle_rows(df.withColumn("n_tokens", F.size("input_ids")), ["row_key"], sums={"start": "n_tokens"})
    plan = rechunk(ordered, 4, 30, df)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    lines = physical.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i : i + 2])
            assert "tokens" not in below.replace("n_tokens", "").replace("split_tokens", ""), below
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64])
def test_characters_cut_by_chunks_come_back(spark, byte_vocab, size):
    """Characters of one to four bytes in rows of few tokens: each is in the row of its first byte."""
    from corploom.operators.tokenizing import VocabularyTokenizer, detokenize_chunks

    texts = ["aé日🎉b", "", "🎉🎉🎉", "é", "日本語 text", "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    packed = df.select("pos", VocabularyTokenizer(byte_vocab).packed(F.col("text")).alias("tokens"))
    found = detokenize_chunks(stage(rechunk(packed, size, 3), "chunks"), byte_vocab).orderBy("pos").collect()
    per_split = {}
    for row in found:
        per_split.setdefault(row.split_id, []).append(row.text)
    joined = ["".join(texts[2 * k : 2 * k + 2]) for k in range(3)]
    assert ["".join(parts) for _, parts in sorted(per_split.items())] == joined
    for split, parts in per_split.items():
        raw, place = joined[split].encode(), 0
        for k, part in enumerate(parts):
            place += len(part.encode())
            end = min(len(raw), size * (k + 1))
            assert place >= end and raw[end:place] == bytes(b for b in raw[end:place] if b & 0xC0 == 0x80)
