"""Packing against the tokenizers library and a plain first-fit decreasing."""

import json
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corploom.llm import packing
from corploom.llm.packing import (
    CAPACITY, TextEncoder, by_words, first_fit_decreasing, pack_documents, pack_group, sequences,
)
from corploom.llm.bpe import token_bytes
from corploom.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
LATIN = [*map(chr, range(0xC0, 0x280)), *"abcdefgh'.,0123 "]


def plain_first_fit(sizes, capacity):
    fill, bins, places = [], {}, {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, f in enumerate(fill) if f + sizes[i] <= capacity), None)
        if b is None:
            b = len(fill)
            fill.append(0)
        bins[i], places[i] = b, fill[b]
        fill[b] += sizes[i]
    return [bins[i] for i in range(len(sizes))], [places[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(40))
def test_tree_is_first_fit_decreasing(seed):
    random.seed(seed)
    sizes = [random.randint(1, random.choice([3, 20, 100])) for _ in range(random.randint(0, 60))]
    assert first_fit_decreasing(sizes, 100) == plain_first_fit(sizes, 100)


def test_pieces_of_a_group():
    lengths = np.array([0, 1, 9, 10, 11, 25, 40, 5])
    found = pack_group(lengths, 10)
    covered = defaultdict(list)
    filled = defaultdict(list)
    for d, s, n, b, o in zip(*(found[k].tolist() for k in ("doc", "start", "length", "bin", "offset"))):
        assert 0 < n <= 10
        covered[d] += range(s, s + n)
        filled[b] += range(o, o + n)
    assert {d: sorted(x) for d, x in covered.items()} == {d: list(range(n)) for d, n in enumerate(lengths) if n}
    assert all(sorted(x) == list(range(len(x))) and len(x) <= 10 for x in filled.values())
    assert sorted(filled) == list(range(len(filled)))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check_packed(df, docs, library, capacity):
    rows = df.collect()
    expected = sorted(
        (str(r.doc_id), tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2]))
        for r in docs.collect()
    )
    by_place, filled = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_place[str(r.doc_id), r.doc_tokens].append((r.start, ids))
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    # Documents of one id and length are told apart by nothing but their ids: count those.
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    for key in {(i, len(ids)) for i, ids in expected}:
        same = [ids for i, ids in expected if (i, len(ids)) == key]
        want = sorted((s, list(ids[s : s + capacity])) for ids in same for s in range(0, len(ids), capacity))
        assert sorted(by_place[key]) == want
    return rows


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = check_packed(pack_documents(docs, PATH, 2), docs, library, CAPACITY)
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert sum(CAPACITY - n for n in fill.values() if n & (n - 1)) < 0.03 * sum(fill.values())


def test_edges_and_small_groups(spark, library, edge_docs, no_docs):
    packed = pack_documents(edge_docs, PATH, 2, capacity=64, group_docs=3, group_tokens=200)
    check_packed(packed, edge_docs.select("doc_id", "text"), library, 64)
    assert pack_documents(no_docs, PATH, 2).count() == 0
    kept = pack_documents(edge_docs, PATH, 2, keep=["doc_id", "start", "text", "score", "ids"])
    assert kept.columns == ["doc_id", "text", "score", *packing.RESULTS]
    assert {r.score for r in kept.select("score").collect()} == {"x"}
    assert {r.text for r in kept.select("text").collect()} == {r.text for r in edge_docs.select("text").collect()}


def test_repeated_rows_spread(spark):
    docs = spark.range(4000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same words here").alias("text"))
    rows = pack_documents(docs.repartition(4), PATH, 2, group_docs=100).select("length", "sequence_id").collect()
    assert len(rows) == 4000
    assert len({r.sequence_id for r in rows}) <= 50


def test_sequences(spark, edge_docs):
    packed = pack_documents(edge_docs, PATH, 2, capacity=64).persist()
    whole = sequences(packed)
    assert whole.where(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0
    first = packed.where("offset = 0").select("sequence_id", F.col("ids").alias("head"))
    joined = whole.join(first, "sequence_id")
    assert joined.where(~F.startswith(F.hex("ids"), F.hex("head"))).count() == 0
    assert joined.count() == whole.count()


def test_words_are_exact(library):
    random.seed(7)
    marks = ["́", "Σ", "ς", "İ", "é", "ﬁ", " ", " ", "<|endoftext|>", "'s", "'LL", "\x00", "🎉", "日本", "٣"]
    texts = ["".join(random.choices([*"ab' .1\t\n\v\r", *marks], k=random.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(random.choices(sure, k=random.randint(0, 20))) for sure in [LATIN] * 20_000]
    texts += ["<|STARTOFTEXT|> <|endoftext|>a A<|b", "x" * 5000, "don't DON'T it'LL we're 12ab3"]
    texts += [c * n for c in "ax-'.é1" for n in range(1, 60)]
    texts += ["".join(random.choices("abehnox", k=random.randint(1, 4))) * random.randint(3, 9) for _ in range(3000)]
    encoder = TextEncoder(PATH)
    assert encoder.words and encoder.fast
    for text in texts:
        assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_entry_and_real_words_are_exact(library, spark):
    """All entries of the vocabulary that are text, and all words of a table."""
    encoder = TextEncoder(PATH)
    flat, begins = token_bytes(PATH)
    raw = flat.tobytes()
    entries = [raw[a:b].replace(b"</w>", b"") for a, b in zip(begins, begins[1:])]
    words = {e.decode().strip() for e in entries if e.decode(errors="ignore").encode() == e}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    words |= {w for r in docs for w in r.text.split()}
    words = sorted(words)
    expected = library.encode_batch(words, add_special_tokens=False)
    assert all(np.frombuffer(encoder(w), "<u4").tolist() == e.ids for w, e in zip(words, expected))


def test_other_files_take_whole_texts(tmp_path):
    path = tokenizer_path()
    with open(path, encoding="utf-8") as file:
        assert not by_words(json.load(file))
    text = "Some words,  spaces\n\n and more"
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(TextEncoder(path)(text), "<u4").tolist() == expected
