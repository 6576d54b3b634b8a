"""BPE, decontamination, substring dedup, near duplicates, personal data, and their parts."""

import collections
import json
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edge_texts import TEXTS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corploom.llm import batches, bpe, decontamination, near_duplicates, pii, repeats
from corploom.llm.boosting import Boosted, boost, fit, level_sums

PATH = public_tokenizers.path("byte_bpe_50k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Words of batches


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_words_of_batches(monkeypatch, block):
    monkeypatch.setattr(batches, "_BLOCK", block)
    batches._table.cache_clear()
    texts = [t for _, t in TEXTS if len(t or "") < 5000] + ["ab", "cd", "", None, "ab"]
    found = batches.Words(
        *batches.text_bytes(pa.array(texts)), batches.NOT_WHITE, batches.AS_IS
    )
    own = [[w.encode() for w in words(t)] for t in texts]
    flat = [w for ws in own for w in ws]
    assert [found.word(i) for i in range(len(found.starts))] == flat
    assert found.first.tolist() == np.cumsum([0, *map(len, own)]).tolist()
    hash_of = dict(zip(flat, found.hashes.tolist()))
    assert [hash_of[w] for w in flat] == found.hashes.tolist()
    assert len(set(hash_of.values())) == len(hash_of)
    batches._table.cache_clear()


# Encoding


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(bpe, "_MASK", np.uint64(15))
    monkeypatch.setattr(bpe, "_LEAST", 3)


def test_encoding_equals_the_library(small_chunks):
    library, encoder, rnd = Tokenizer.from_file(PATH), bpe.Encoder(PATH), random.Random(1)
    pool = [
        " ", "  ", "\n", " \n ", "'re", "'", "'l", "don't", "a", "é", "日本", "🎉", "12", "<|endoftext|>",
        "<|endo", "...", "\t", "x" * 40, " " * 30, " ", "　", "of the ", " and ", "x y", "͸",
        "\U0001fae0", "ß", "\x1c", "\x85", "0", "ing", "tion", "http://a.b/c?d",
    ]
    for _ in range(1500):
        encoder.store.clear()
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 80)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == expected, text
        ids = np.array(expected, np.uint32)
        decoded = library.decode(expected, skip_special_tokens=False)
        assert bpe.decode_ids(ids, PATH).decode() == decoded == text


def test_other_kinds_of_vocabulary_go_through_the_library(tmp_path):
    import json

    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    encoder = bpe.Encoder(str(path))
    assert encoder.fast is None
    expected = Tokenizer.from_file(str(path)).encode("ab cd", add_special_tokens=False).ids
    assert encoder.encode("ab cd").tolist() == expected


def test_shared_chunks_are_encoded_once():
    encoder, calls = bpe.Encoder(PATH), collections.Counter()
    encode = encoder.fast.encode_to_numpy

    class Counting:
        def encode_to_numpy(self, text, **options):
            calls[text] += 1
            return encode(text, **options)

    encoder.fast = Counting()
    rnd = random.Random(3)
    passage = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(2000))
    for k in range(5):
        encoder.encode(f"head {k} {passage} tail {k}")
    assert max(calls.values()) == 1
    assert sum(map(len, calls)) < 2 * len(passage)


@pytest.mark.parametrize("text", ["a" * 60_000, "12" * 30_000, " " * 60_000, "日本" * 20_000])
def test_very_long_words(text):
    expected = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert bpe.Encoder(PATH).encode(text).tolist() == expected
    assert pii.strict_spans(text) == []


def test_encode_and_decode_frames(edge_docs, no_docs):
    coded = bpe.decode(bpe.encode(edge_docs, PATH), PATH)
    assert sorted(coded.columns) == sorted(edge_docs.columns)
    library = Tokenizer.from_file(PATH)
    rows = coded.select("text", "ids", "decoded", "n_words").collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert (row.decoded, row.n_words) == (row.text or "", "x")
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


# Decontamination


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)


def brute_tiles(doc, item, least):
    """Greedy string tiling by trying every pair of places, longest first."""
    taken_d, taken_i, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                    and i + n not in taken_i and d + n not in taken_d
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return covered
        taken_i |= set(range(i, i + n))
        taken_d |= set(range(d, d + n))
        covered += n


def leak_rows(spark, docs, items, **options):
    rows = decontamination.with_leaks(docs, items, **options).collect()
    return {(r.doc_id, x.item): x for r in rows for x in r.leaks}


def test_leaks(spark, make_docs, no_docs):
    rnd = random.Random(5)
    make = lambda n: [rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 3)) for _ in range(n)]
    items = [(k, " ".join(make(rnd.randint(3, 30)))) for k in range(12)]
    items += [(100, items[11][1]), (101, None), (102, ""), (103, "two words"), (None, items[10][1])]
    rows = []
    for k in range(40):
        parts = [" ".join(make(rnd.randint(0, 40)))]
        for _, text in rnd.sample(items[:12], 2):
            own = text.split()
            cut = rnd.randint(0, len(own))
            parts.append(", ".join([*own[cut:], *own[:cut]]).upper())  # reordered
            parts.append(" ".join(own[: rnd.randint(0, len(own))]))
        rows.append((1000 + k, " ".join(parts)))
    docs = make_docs(rows + TEXTS)
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = leak_rows(spark, docs, frame, least=3, coverage=0.6)
    expected = {}
    for i, text in rows + TEXTS[:6]:
        for j, item in items:
            own = tokens(item)
            n = brute_tiles(tokens(text), own, 3)
            if len(own) >= 3 and n >= 0.6 * len(own):
                expected[i, j] = n
    assert {k: x.n_matched for k, x in found.items()} == expected
    assert expected
    kept = decontamination.without_leaks(docs, frame, least=3, coverage=0.6)
    leaky = {i for i, _ in expected}
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(
        i for i, _ in rows + TEXTS if i is not None and i not in leaky
    )
    assert decontamination.with_leaks(no_docs, frame).count() == 0
    assert decontamination.with_leaks(docs, frame.limit(0)).where(F.size("leaks") > 0).isEmpty()


def test_leaks_in_blocks(spark, make_docs, monkeypatch):
    items = [(k, f"this is the item number {k} of all the items there are") for k in range(20)]
    docs = make_docs([(k, f"so {text}!") for k, text in items])
    frame = spark.createDataFrame(items, "item_id int, text string")
    whole = leak_rows(spark, docs, frame)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    assert leak_rows(spark, docs, frame) == whole
    assert {(k, k) for k in range(20)} <= set(whole)


# Substring dedup


def brute_repeats(rows):
    owner = {}
    for i, text in rows:
        own = words(text)
        for k in range(len(own) - 12):
            if i is not None:
                key = tuple(own[k : k + 13])
                owner[key] = min(i, owner.get(key, i))
    out = []
    for i, text in rows:
        own, gone = words(text), set()
        for k in range(len(own) - 12):
            if i is not None and owner[tuple(own[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("frequent,shard", [(4096, 500_000), (2, 50)])
def test_repeats(make_docs, monkeypatch, frequent, shard):
    """Also with every shared anchor frequent and with many small shards."""
    monkeypatch.setattr(repeats, "_FREQUENT", frequent)
    monkeypatch.setattr(repeats, "_SHARD_WORDS", shard)
    rnd = random.Random(9)
    make = lambda n: [rnd.choice("abcdef") for _ in range(n)]
    passages = [make(rnd.randint(10, 40)) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = make(rnd.randint(0, 30))
        for p in rnd.sample(passages, 2):
            parts += p[rnd.randint(0, 5) :] + make(rnd.randint(0, 6))
        rows.append((rnd.randint(0, 50), rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += TEXTS + [(100, TEXTS[7][1]), (101, "a b " * 60), (102, "a b " * 50)]
    found = repeats.without_repeats(make_docs(rows))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
    assert sorted(got, key=repr) == brute_repeats(rows)


def test_no_repeats(no_docs, make_docs):
    assert repeats.without_repeats(no_docs).count() == 0
    found = repeats.without_repeats(make_docs([(1, "a b c"), (2, "a b c")])).collect()
    assert [r.n_removed for r in found] == [0, 0]


def test_fm_index_counts():
    rnd = np.random.default_rng(2)
    sequence = np.append(rnd.integers(1, 4, 400), 0)
    index = repeats.FMIndex(sequence, 4)
    for size in (1, 3, 9):
        ends = np.arange(size, 400)
        low, high = index.intervals(sequence, ends, size)
        text = bytes(sequence.tolist())
        for end, n in zip(ends.tolist(), (high - low).tolist()):
            part = text[end - size : end]
            assert n == sum(text.startswith(part, k) for k in range(len(text)))


def test_anchors_move_once(make_docs, capsys):
    """Counting the anchors and joining the counts read one exchange."""
    repeats.without_repeats(make_docs([(1, "a b c"), (2, "a b c")])).explain()
    plan = capsys.readouterr().out
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(anchor" in line]
    assert moves and all("REPARTITION_BY_COL" in line for line in moves)
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    # What is below the exchange: with equal filters the plans are the same, and one is reused.
    filters = [b for a, b in zip(lines, lines[1:]) if a.startswith("Exchange hashpartitioning(anchor")]
    assert len({re.sub(r"#\d+L?", "", f) for f in filters}) == 1


def test_windows_searched_once(monkeypatch):
    """A window that many stretches share is searched in the index once, from a sorted seed."""
    asked = []
    plain = repeats.FMIndex.intervals
    monkeypatch.setattr(
        repeats.FMIndex, "intervals", lambda self, s, ends, size: asked.append(len(ends)) or plain(self, s, ends, size)
    )
    shared = " ".join(f"w{k}" for k in range(14))
    pieces = [f"{shared} x{k}".encode() for k in range(50)]
    hashes, smallest = repeats.owners(pieces, np.arange(50) + 7)
    assert asked == [2 + 50]
    assert sorted(smallest.tolist()) == sorted([7, 7, *range(7, 57)]) and len(set(hashes.tolist())) == 52


# Near duplicates


def shingle_counts(text):
    own = words(text)
    if len(own) < 5:
        return collections.Counter([tuple(own)] if own else [])
    return collections.Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def alike(a, b):
    a, b = shingle_counts(a), shingle_counts(b)
    return sum((a | b).values()) > 0 and sum((a & b).values()) >= 0.8 * sum((a | b).values())


def near_rows():
    rnd = random.Random(4)
    make = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    rows, n = list(TEXTS), 1000
    for _ in range(8):
        base = make(rnd.randint(60, 200))
        for k in range(rnd.randint(1, 6)):
            own = list(base)
            for _ in range(k % 3):
                own[rnd.randrange(len(own))] = "changed"
            rows.append((n, " ".join(own)))
            n += 1
    rows += [(n + k, rows[-1][1]) for k in range(5)]
    return rows


@pytest.mark.parametrize("mates", [2048, 3])
def test_near_duplicate_classes(make_docs, no_docs, monkeypatch, mates):
    """Also with buckets compared in small blocks."""
    monkeypatch.setattr(near_duplicates, "MOST_MATES", mates)
    rows = near_rows()
    found = near_duplicates.near_duplicate_classes(make_docs(rows)).collect()
    assert len(found) == len(rows)
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}
    for a in texts:
        for b in texts:
            if a < b and alike(a, b):
                old, new = root[b], root[a]
                root = {t: new if r == old else r for t, r in root.items()}
    got = collections.defaultdict(set)
    for r in found:
        got[bytes(r.class_key)].add(r.text or "")
    want = collections.defaultdict(set)
    for t, r in root.items():
        want[r].add(t)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))

    kept = near_duplicates.one_per_class(make_docs(rows))
    assert sorted(kept.columns) == sorted(make_docs(rows).columns)
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(want)
    for group in want.values():
        ids = [i for i, t in rows if (t or "") in group]
        own = [i for i, t in left if (t or "") in group]
        assert len(own) == 1
        assert own[0] == min((i for i in ids if i is not None), default=None)
    assert near_duplicates.near_duplicate_classes(no_docs).count() == 0
    assert near_duplicates.one_per_class(no_docs).count() == 0


def crowd_rows(texts=300, pairs=15):
    """A page template: texts at 0.78 to each other, and pairs of them at 0.81. Also a text of
    shingles that repeat, so that copies count."""
    rnd = random.Random(6)
    make = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    page = make(424)
    tails = [make(60) for _ in range(texts)]
    for k in range(pairs):
        tails[2 * k + 1] = tails[2 * k][:10] + tails[2 * k + 1][10:]
    rows = [(k, " ".join(page + tail)) for k, tail in enumerate(tails)]
    return [*rows, (texts, " ".join(make(5) * 40))]


def check_crowd(make_docs):
    rows = crowd_rows()
    sets = [shingle_counts(t) for _, t in rows]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sum((sets[a] & sets[b]).values()) >= 0.8 * sum((sets[a] | sets[b]).values())
    ]
    assert len(links) == 15
    found = near_duplicates.near_duplicate_classes(make_docs(rows)).collect()
    classes = collections.defaultdict(list)
    for r in found:
        classes[bytes(r.class_key)].append(r.doc_id)
    assert sorted(sorted(c) for c in classes.values() if len(c) > 1) == sorted(sorted(p) for p in links)
    assert len(found) == len(rows)


def test_similar_pairs_in_a_crowd_just_below(make_docs):
    """The closest by estimate is often a text that is not similar; the similar one counts."""
    check_crowd(make_docs)


def test_similar_pairs_of_different_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_duplicates, "MOST_MATES", 64)
    check_crowd(make_docs)


def test_similarity_below_the_bands_is_refused(make_docs):
    docs = make_docs([(1, "a b c d e f")])
    for of in (near_duplicates.near_duplicate_classes, near_duplicates.one_per_class):
        with pytest.raises(ValueError, match="least"):
            of(docs, least=0.6)
    assert near_duplicates.near_duplicate_classes(docs, least=0.9).count() == 1


def test_signatures_estimate_weighted_similarity():
    rnd = np.random.default_rng(0)
    a = np.sort(rnd.integers(0, 300, 600).astype(np.uint64))
    b = np.sort(np.concatenate([a[100:], rnd.integers(1000, 1300, 100).astype(np.uint64)]))
    both = near_duplicates.signatures([a, b, a[:1]], 2000)
    true = near_duplicates.similarity(a, b)
    assert abs((both[0] == both[1]).mean() - true) < 4 * (true * (1 - true) / 2000) ** 0.5
    assert (near_duplicates.signatures([b], 2000) == both[1]).all()


def test_chains_are_one_component(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 99)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    roots = dict(near_duplicates.components(frame, "a", "b").collect())
    roots = {n: roots[n] for n in roots if n != roots[n]}
    assert roots == {**{k: 0 for k in range(1, 41)}, 100: 99, 101: 99}


# Personal data


def test_strict_spans():
    text = "x@y.z 1.2.3.4.5.6 256.1.1.1, 4111-1111 1111 1111 +1 (743) 555-3824 +12345 a@b"
    spans = {(text[s:e], k) for s, e, k in pii.strict_spans(text)}
    assert spans == {
        ("x@y.z", "email"), ("1.2.3.4", "ip"), ("4111-1111 1111 1111", "card"),
        ("+1 (743) 555-3824", "phone"),
    }
    rnd = random.Random(2)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rnd.choices("a1.@_-% ", k=rnd.randint(0, 30)))
        spans = pii.strict_spans(text)
        assert [s[:2] for s in spans if s[2] == "email"] == [m.span() for m in email.finditer(text)]
        assert [s[:2] for s in spans if s[2] == "ip"] == [m.span() for m in ip.finditer(text)]
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_boosted_spans_add_and_never_take_away(model):
    text = "call (743) 555-3824 or write; born 12.05.1987, 1914-1918, pi 3.14159265, no 12345678"
    found = pii.find_spans(text, model)
    assert [text[s:e] for s, e, _, strict in found if not strict] == ["(743) 555-3824"]
    for _, t in TEXTS:
        strict = [s[:3] for s in pii.find_spans(t or "", model) if s[3]]
        assert sorted(strict) == sorted(pii.strict_spans(t or ""))


def test_model_reads_every_candidate(spark, make_docs, monkeypatch):
    """5,000 and more distinct candidates all count, in the trees and in the thresholds."""
    texts = [f"write to user{k}@example{k % 97}.org or call +1 (743) 555-{k:04d}, 12345678{k:05d}" for k in range(2000)]
    rows = {e["digest"]: e for t in texts for e in pii._examples(t)}
    fitted = [e for e in rows.values() if int(e["digest"][:2], 16) >= 77]
    forms = [(1 + len(pii.spellings(e["kind"], e["found"])), len(pii.decoys(e["digest"])), e["label"]) for e in fitted]
    asked = []
    monkeypatch.setattr(pii, "boost", lambda n, positives, ask: asked.append((n, positives)) or Boosted(0.0, ()))
    seen = []
    plain = pii._bound
    monkeypatch.setattr(pii, "_bound", lambda scores, n, hits: seen.append(int(n.sum())) or plain(scores, n, hits))
    pii.fit_model(make_docs([(k, t) for k, t in enumerate(texts * 2)]))
    assert len(rows) > 5000
    assert asked == [(sum(f + d for f, d, _ in forms), sum(f for f, _, label in forms if label))]
    held = [e for e in rows.values() if int(e["digest"][:2], 16) < 77]
    assert sum(seen) == sum(1 + len(pii.spellings(e["kind"], e["found"])) + len(pii.decoys(e["digest"])) for e in held)


def test_boosting_adds_up_parts():
    """Sums of parts of the rows, with counts in place of copies, give the tree of all rows."""
    rnd = np.random.default_rng(4)
    x = rnd.integers(0, 9, (600, 5)).astype(np.uint16)
    y = ((x[:, 0] > 4) & (x[:, 2] < 6)).astype(int)
    whole = fit(np.repeat(x, 2, axis=0), np.repeat(y, 2))

    def ask(*tree):
        parts = [level_sums(x[a::3], y[a::3], np.full(200, 2), *tree) for a in range(3)]
        sums = {}
        for part in parts:
            for node, feature, value, g, h in zip(*part):
                old = sums.get((node, feature, value), (0, 0))
                sums[node, feature, value] = old[0] + g, old[1] + h
        keys = sorted(sums)
        return tuple(np.array(c) for c in [*zip(*keys), *zip(*[sums[k] for k in keys])])

    added = boost(1200, int(2 * y.sum()), ask)
    assert added.scores(x).tolist() == whole.scores(x).tolist()
    assert ((whole.scores(x) > 0) == y).mean() > 0.98


def test_pii_frames(spark, edge_docs, no_docs, model, make_docs):
    found = pii.with_pii(edge_docs, model)
    clean = pii.redact(found)
    assert sorted(clean.columns) == sorted(edge_docs.columns)
    for row in clean.select("doc_id", "text").collect():
        if row.doc_id == 10:
            assert row.text == "mail [EMAIL] or [PHONE], card [CARD], ip [IP]"
        if row.doc_id in (1, 4, 12):
            assert row.text in [t for i, t in TEXTS if i == row.doc_id]
    assert pii.with_pii(no_docs, model).count() == 0
    empty = pii.fit_model(no_docs)
    assert pii.find_spans("a@b.cd +1 (743) 555-3824", empty)[0][2] == "email"
    overlap = make_docs([(1, "abcdefgh")]).withColumn(
        "pii", F.expr("array(struct(1 as start, 4 as end, 'a' as kind), struct(2 as start, 6 as end, 'b' as kind))")
    )
    assert pii.redact(overlap).first().text == "a[A]gh"


def test_the_model_is_the_same_wherever_rows_stand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert pii.fit_model(docs).bounds == pii.fit_model(docs.repartition(7)).bounds


def test_boosting_separates():
    rnd = np.random.default_rng(1)
    x = rnd.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    scores = fit(x[:400], y[:400]).scores(x[400:])
    assert ((scores > 0) == y[400:]).mean() > 0.95
    assert fit(x[:0], y[:0]).scores(x[:2]).tolist() == [0.0, 0.0]


def test_short_texts_take_bounded_memory():
    """10,000 texts of ten words throw some nine million darts."""
    texts = [" ".join(f"w{i}x{k}" for k in range(10)) for i in range(10_000)]
    keys = [i.to_bytes(4, "big") for i in range(len(texts))]
    batch = pa.record_batch({"_key": pa.array(keys, pa.binary()), "_text": pa.array(texts)})
    tracemalloc.start()
    rows = sum(b.num_rows for b in near_duplicates._band_rows(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 26 * len(texts) and peak < 80 << 20


HELPERS = "_key _text _id _class _kept _n _root _shared row digest key order root text_key class_key".split()


def test_columns_come_through_near_duplicates(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "a"), (1, text, "a"), (2, text + " end", "b"), (None, text, "c"), (7, None, "d"), (7, "", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    df = df.withColumns({name: F.concat(F.lit(name), "lang") for name in HELPERS})
    kept = near_duplicates.one_per_class(df).collect()
    assert sorted((r.doc_id, r.lang) for r in kept) == [(1, "a"), (7, "d")]
    assert all(r[name] == name + r.lang for r in kept for name in HELPERS)
    classed = near_duplicates.near_duplicate_classes(df).collect()
    assert all(r[name] == name + r.lang for r in classed for name in HELPERS[:-2])
    assert len({r.class_key for r in classed}) == 2


def test_the_row_that_stays_does_not_depend_on_order(spark):
    """Rows equal in id and text: the digest of the other columns decides."""
    rows = [(None, "same text of some words here", f"s{i}") for i in range(50)]
    found = set()
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(rows, 50), "doc_id bigint, text string, source string")
        (row,) = near_duplicates.one_per_class(df.repartition(4)).collect()
        found.add(row.source)
    assert len(found) == 1


def test_recall_of_near_duplicates():
    """Pairs at 0.80 and 0.85, by bands and agreement of their signatures."""
    chance = np.random.default_rng(11)
    for common, own in ((80, 10), (85, 7.5)):
        missed = 0
        for _ in range(1000):
            shared = chance.integers(0, 2**64, 2 * common, dtype=np.uint64)
            sides = [np.sort(np.concatenate([shared, chance.integers(0, 2**64, int(2 * own), dtype=np.uint64)])) for _ in "ab"]
            assert near_duplicates.similarity(*sides) >= 0.8
            signs = near_duplicates.signatures(sides)
            bands = near_duplicates.bands_of(signs)
            missed += not (bands[0] == bands[1]).any() or (signs[0] == signs[1]).sum() < near_duplicates._AGREE
        assert missed <= 5


@pytest.mark.parametrize(
    "changes",
    [
        {"normalizer": {"type": "NFKC"}},
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
        {"pre_tokenizer": {"type": "Metaspace", "replacement": "\u2581", "prepend_scheme": "always", "split": True}},
        {"padding": {"strategy": {"Fixed": 9000}, "direction": "Right", "pad_to_multiple_of": None, "pad_id": 0,
                     "pad_type_id": 0, "pad_token": "!"}},
    ],
)
def test_other_files_are_encoded_and_decoded_as_the_library_does(spark, tmp_path, changes):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    path = tmp_path / "other.json"
    path.write_text(json.dumps({**spec, **changes}))
    text = " ".join(f"W\u00f6rd{i % 321} \ufb01ne \u2460" for i in range(3000))
    library = Tokenizer.from_file(str(path))
    library.no_padding()
    ids = library.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(text,), (None,)], "text string")
    rows = bpe.decode(bpe.encode(df, str(path)), str(path)).collect()
    found = {r.text: (np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows}
    assert found[text] == (ids, library.decode(ids, skip_special_tokens=False))
    assert found[None] == ([], "")
