import gzip
import lzma
import pickle
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

from corploom.functions import longest_match
from corploom.functions.longest_match import LongestMatch, TokenBytes
from corploom.functions.packed_ids import line_bytes, pack_ids, unpack_ids
from corploom.operators.tokenizing import (
    VocabularyTokenizer,
    detokenize_corpus,
    token_totals,
    tokenize_corpus,
    with_masks,
)
from corploom.sources.vocabulary import encoding_table, read_vocabulary, vocabulary_view


@pytest.fixture(scope="module")
def letters(spark):
    rows = [(1, b"a"), (2, b"b"), (3, b"c"), (4, b"ab"), (5, b"abc")]
    return vocabulary_view(spark.createDataFrame(rows, "token_id int, token binary"))


def ids_of(df):
    return [r.input_ids for r in df.orderBy("k").collect()]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "k int, text string")


def test_longest_match_wins(spark, letters):
    df = tokenize_corpus(texts(spark, "abcab", "abb", "<|endoftext|>", "", None), letters)
    assert ids_of(df) == [[5, 4], [4, 2], [0], [], None]


def test_text_without_a_match_fails(spark, letters):
    with pytest.raises(PythonException, match="no vocabulary entry matches"):
        tokenize_corpus(texts(spark, "abx"), letters).collect()


def test_bytes_of_a_character_may_be_cut(spark, byte_vocab):
    (ids,) = ids_of(tokenize_corpus(texts(spark, "é"), byte_vocab))
    assert ids == [0xC3 + 1, 0xA9 + 1]


def test_list_field_gives_one_list_per_part(spark, letters):
    df = spark.createDataFrame([(0, ["ab", "", "cab"]), (1, []), (2, None)], "k int, text array<string>")
    assert ids_of(tokenize_corpus(df, letters)) == [[[4], [], [3, 4]], [], None]
    packed = df.select("k", VocabularyTokenizer(letters).packed(F.col("text"), True).alias("t"))
    assert ids_of(packed.select("k", unpack_ids("t").alias("input_ids"))) == [[4, 3, 4], [], None]


def test_own_tokenizer(spark):
    lengths = F.pandas_udf(lambda s: s.map(lambda t: [len(t)]), "array<int>")
    assert ids_of(tokenize_corpus(texts(spark, "abc", "d"), fn=lengths)) == [[3], [1]]


def test_masks_and_totals(spark, letters):
    df = tokenize_corpus(texts(spark, "abcab", "ab"), letters)
    row = with_masks(df).orderBy("k").first()
    assert (row.token_type_ids, row.attention_mask) == ([0, 0], [1, 1])
    assert token_totals(df).first().asDict() == {"n_rows": 2, "n_tokens": 3}


def test_detokenize(spark, byte_vocab, letters):
    samples = ["héllo\n\"x\"", " ", "<|endoftext|>", "日本語"]
    tokens = tokenize_corpus(texts(spark, *samples), byte_vocab).drop("text")
    back = detokenize_corpus(tokens, byte_vocab).orderBy("k").collect()
    assert [r.text for r in back] == samples
    half = spark.createDataFrame([(0, [0xC3 + 1])], "k int, input_ids array<int>")
    assert bytes(detokenize_corpus(half, byte_vocab, as_text=False).first().text) == b"\xc3"
    with pytest.raises(PythonException):
        detokenize_corpus(half, byte_vocab).collect()
    with pytest.raises(PythonException, match="not in the vocabulary"):
        detokenize_corpus(half, letters).collect()


words = st.text("abc<|é ", min_size=1, max_size=5)


@settings(max_examples=500, deadline=None)
@given(
    st.lists(words, max_size=8),
    st.lists(st.text("abc<|é ", max_size=30), min_size=1, max_size=5),
)
def test_the_longest_entry_wins_everywhere(tokens, samples):
    ids = {bytes([b]): b + 1 for b in range(256)}
    for token in tokens:
        ids.setdefault(token.encode(), len(ids) + 1)

    def plain(raw):
        out = []
        while raw:
            size = max(n for n in range(1, len(raw) + 1) if raw[:n] in ids)
            out.append(ids[raw[:size]])
            raw = raw[size:]
        return out

    found = LongestMatch(ids)(pa.array([None, *samples])).slice(1)
    assert found.to_pylist() == [plain(s.encode()) for s in samples]
    back = TokenBytes({i: t for t, i in ids.items()})(found)
    assert back.to_pylist() == [s.encode() for s in samples]


LINES = "1 '\\n' 1\n2 b'\\xff' 1\n3 'é' 2\n4 ' a b ' 5\n5 'dup' 3\n6 'dup' 3\n"


@pytest.mark.parametrize("suffix, opener", [("", open), (".gz", gzip.open), (".xz", lzma.open)])
def test_vocabulary_file(spark, tmp_path, suffix, opener):
    path = str(tmp_path / f"vocab.txt{suffix}")
    with opener(path, "wb") as file:
        file.write(LINES.encode())
    vocab = read_vocabulary(spark, path)
    table = {r.token_id: bytes(r.token) for r in vocab.collect()}
    expected = {0: b"<|endoftext|>", 1: b"\n", 2: b"\xff", 3: "é".encode(), 4: b" a b ", 5: b"dup", 6: b"dup"}
    assert table == expected
    assert encoding_table(vocab)[b"dup"] == 6


def test_vocabulary_order_decides_between_equal_tokens(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("9 'x' 1\n0 'y' 1\n3 'x' 1\n")
    vocab = read_vocabulary(spark, str(path))
    assert encoding_table(vocab) == {b"x": 3, b"<|endoftext|>": 0}


def test_vocabulary_with_a_wrong_size_fails(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("1 'ab' 3\n")
    with pytest.raises((SparkRuntimeException, Exception), match="token size differs"):
        read_vocabulary(spark, str(path)).collect()


def test_packed_ids_and_line_bytes(spark):
    import json

    rows = [[1, 22, 333, 65_535], [], [0], [1_234_567_890]]
    df = spark.createDataFrame(list(enumerate(rows)), "k int, input_ids array<int>")
    packed = df.select("k", pack_ids("input_ids").alias("tokens")).withColumn("len", line_bytes())
    for row in packed.withColumn("ids", unpack_ids("tokens")).collect():
        ids = rows[row.k]
        line = {"input_ids": ids, "token_type_ids": [0] * len(ids), "attention_mask": [1] * len(ids)}
        assert row.ids == ids
        assert row.len == len(json.dumps(line, separators=(",", ":"))) + 1


def test_arrow_and_regex_tokenizers_agree(spark, documents, byte_vocab):
    """Cross-check with a tokenizer made of Spark's own regex functions."""
    from workload.queries import word_vocabulary

    vocab = word_vocabulary(spark, "/root/testdata/sf0.001")
    sample = documents.orderBy(F.length("text")).limit(60)
    found = tokenize_corpus(sample, vocab).select("row_key", "input_ids")
    table = {t.hex().upper(): i for t, i in encoding_table(vocab).items()}
    pattern = "|".join(sorted((h for h in table if len(h) > 2), key=len, reverse=True))
    pieces = F.regexp_extract_all(F.hex(F.encode("text", "UTF-8")), F.lit(f"({pattern}|[0-9A-F]{{2}})"), 1)
    expected = {r.row_key: [table[p] for p in r.pieces] for r in sample.select("row_key", pieces.alias("pieces")).collect()}
    assert {r.row_key: r.input_ids for r in found.collect()} == expected


def test_gaps_in_the_vocabulary_are_named():
    match = LongestMatch({b"ab": 1, b"abc": 2, b"d": 3}).match
    assert match(b"abcdabd").tolist() == [2, 3, 1, 3]
    for text, place in ((b"abx", "x"), (b"xab", "xab"), (b"abca", "a"), (b"c", "c")):
        with pytest.raises(ValueError, match=f"at b'{place}'"):
            match(text)


def plain_match(ids, text):
    found = []
    while text:
        size = next((n for n in range(min(len(text), 12), 0, -1) if text[:n] in ids), 0)
        if not size:
            return None
        found.append(ids[text[:size]])
        text = text[size:]
    return found


@pytest.mark.parametrize("seed", range(60))
def test_lanes_and_places_equal_brute_force(monkeypatch, seed):
    """Vocabularies with and without gaps, texts over few letters, blocks of few bytes."""
    random.seed(seed)
    monkeypatch.setattr(longest_match, "_BLOCK", random.choice([3, 16, 512]))
    monkeypatch.setattr(longest_match, "_WINDOW", random.choice([16, 100, 4 << 20]))
    monkeypatch.setattr(longest_match, "_SPARSE", random.choice([0, 16, 10**9]))
    monkeypatch.setattr(longest_match, "_ROUNDS", random.choice([0, 1, 3]))
    for _ in range(20):
        letters = random.choice([b"a", b"ab", b"abc", bytes(range(256)), b"ab\xc3\xa9"])
        ids = {}
        for _ in range(random.choice([1, 3, 10, 60])):
            ids[bytes(random.choices(letters, k=random.choice([1, 2, 3, 4, 6, 9])))] = random.randrange(70_000)
        if random.random() < 0.7:
            for byte in letters:
                ids.setdefault(bytes([byte]), byte)
        texts = [bytes(random.choices(letters, k=random.choice([0, 1, 2, 5, 40, 400]))) for _ in range(8)]
        expected = [plain_match(ids, text) for text in texts]
        match = pickle.loads(pickle.dumps(LongestMatch(ids)))
        if None in expected:
            with pytest.raises(ValueError, match="no vocabulary entry"):
                match(pa.array(texts, pa.binary()))
        else:
            assert match(pa.array(texts, pa.binary())).to_pylist() == expected


def test_runs_of_one_letter_do_not_meet():
    """Tokens of three letters in blocks that three does not divide."""
    match = LongestMatch({b"a": 1, b"aaa": 2, b"aaaaaaa": 3, b"b": 4})
    for size in (10_000, 1_000_001):
        text = b"a" * size + b"b"
        expected = [3] * (size // 7) + [2] * (size % 7 // 3) + [1] * (size % 7 % 3) + [4]
        assert match.match(text).tolist() == expected
        assert match.match(text * 2).tolist() == expected * 2


def test_arrays_beside_the_ids_stay_small():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from corploom.functions.longest_match import TokenBytes

    size, rows = 3_000_000, 1000
    ids = pa.array(np.arange(size, dtype=np.int32) % 256 + 1)
    ends = pa.array(np.r_[0, 0, np.linspace(0, size, rows).astype(np.int32)[1:], size].astype(np.int32))
    lists = pa.ListArray.from_arrays(ends, ids)
    tokens = TokenBytes({i + 1: bytes([i]) for i in range(256)})
    tracemalloc.start()
    joined = tokens(lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = bytes(i % 256 for i in range(256)) * (size // 256 + 1)
    edges = ends.to_pylist()
    assert joined.to_pylist() == [whole[a:b] for a, b in zip(edges, edges[1:])]
    assert peak < 30 * (1 << 20) + 6 * size


def test_line_sizes_across_blocks_of_ids(monkeypatch):
    import numpy as np

    from corploom.functions import packed_ids

    monkeypatch.setattr(packed_ids, "BLOCK_IDS", 3)
    ids, ends = np.array([1, 22, 333, 4, 55, 6, 7, 8888]), np.array([0, 0, 2, 3, 3, 6, 8, 8])
    sums = packed_ids.sums_at(ends, packed_ids.id_blocks(ids))
    assert sums.tolist() == [ids[:e].sum() for e in ends]
    assert packed_ids.sums_at(np.array([0, 0]), packed_ids.id_blocks(ids[:0])).tolist() == [0, 0]


def test_texts_come_in_small_batches(spark, byte_vocab):
    from corploom.operators.tokenizing import VocabularyTokenizer

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        VocabularyTokenizer(byte_vocab)
        assert spark.conf.get(name) == "1000"
        spark.conf.set(name, "77")  # a setting of one's own stays
        VocabularyTokenizer(byte_vocab)
        assert spark.conf.get(name) == "77"
    finally:
        spark.conf.set(name, before)


def test_gram_counts(monkeypatch):
    """Runs of characters side by side, as the regular expression finds them; also where their
    numbers do not fit 64 bits, and over several blocks."""
    import re
    from collections import Counter

    from corploom.functions import grams

    many = "".join(chr(0x4E00 + k % 3000) for k in range(6500))
    texts = ["", None, "a", "ab", "abcabcabcabcab\nab", "é😀é😀é😀x", many, "ab" * 40]
    expected = Counter(g for t in texts if t for n in range(2, 7) for g in re.findall(f"(?s).{{{n}}}", t))
    for block in (grams._CHARS, 20):
        monkeypatch.setattr(grams, "_CHARS", block)
        found = Counter()
        for batch in grams.gram_counts([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]):
            for row in batch.to_pylist():
                found[row["t"]] += row["n"]
        assert found == expected
