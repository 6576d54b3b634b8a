"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from corploom.llm import spelling
from corploom.llm.spelling import level_places, spelling_variants, with_forms, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows, least=7, slips=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return dict(counts)


def are_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms_of(counts, ratio=10):
    near = {w: [u for u in counts if are_near(w, u)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return sorted(
        (w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()
    )


def sorted_rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_counts(spark, make_docs, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    long = "É×" * 300 + "x"
    rows += [(i, f"Straße-{long}{'q' * i} Ābcdefgh {long}") for i in range(70)]
    docs = make_docs(rows)
    assert dict(map(tuple, word_counts(docs).collect())) == counts_of(rows)
    assert dict(map(tuple, word_counts(docs, slips=None, least=2).collect())) == counts_of(rows, 2, None)


@pytest.mark.parametrize("single, alphabet", [(32, "ab"), (2, "abcé")])
def test_forms_equal_brute_force(spark, monkeypatch, single, alphabet):
    """Few letters and many repeats; labels of one character and longer ones."""
    monkeypatch.setattr(spelling, "_SINGLE", single)
    random.seed(single)
    words = {"".join(random.choices(alphabet, k=random.randint(3, 9))) for _ in range(150)}
    words |= {"a" * k for k in range(1, 11)} | {"b", "ab", "ba"}
    counts = {w: random.choice([2, 3, 25, 40, 400, 4000]) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    assert sorted_rows(with_forms(table)) == forms_of(counts)


def test_very_long_words(spark):
    base = "abcdefghéij" * 2000
    at = len(base) // 2
    words = [base, base + "k", "k" + base, base[:at] + base[at + 1 :], base[:at] + "z" + base[at + 1 :]]
    counts = {w: 10**k for k, w in enumerate(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = {r.word: (r.n_near, r.form) for r in with_forms(table).collect()}
    hubs = {base: 4, words[3]: 2, words[4]: 2}
    assert {w: n for w, (n, _) in found.items()} == {w: hubs.get(w, 1) for w in words}
    assert found[base][1] == words[4]
    assert len(level_places(200_000)) < 80


def test_chain_of_forms(spark):
    counts = {"letterss": 1, "letters": 10, "letter": 100, "better": 1000, "butter": 9999}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted_rows(with_forms(table)) == forms_of(counts)
    assert {r.word: r.root for r in with_forms(table).collect()}["letterss"] == "better"


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    kept = {w: n for w, n in counts_of(rows).items() if n >= 2}
    assert sorted_rows(spelling_variants(edge_docs)) == forms_of(kept)
    assert spelling_variants(no_docs).count() == 0
