"""Packing documents into sequences of tokens by first-fit decreasing in randomised groups.

Documents are dealt evenly over the partitions and sorted there by a seeded hash; every run of
`GROUP_DOCS` of them (fewer if their tokens fill `GROUP_TOKENS`) is a group that a task packs by
itself. A document longer than a sequence gives full sequences and a rest. The rests of a group go,
longest first, each into the first sequence with room for it. A tournament tree over the room in
all sequences finds that one: every inner place holds the larger room of its two, so the way down
to the leftmost leaf with enough room takes a step per level.

Tokens are those of the whole text. The tokenizer file is checked to be of the kind that encodes
what stands between white space on its own (white space normalised to one space and dropped, words
split by a pattern that never joins them); then every distinct word is encoded once while a bounded
store holds it, and a text's ids are its words' ids back to back. Other files encode whole texts.

Texts move once, dealt by turns and not by key, so repeated rows and hot sources spread evenly.
Ids never move. Partitions are dealt and sorted alike in a retry, so a lost executor costs its
tasks. A task holds one group.

A null text counts as empty: its ids are the end id alone. Documents of equal length are taken in
the order of the group. Equal rows are packed each by itself; kept columns named as the results are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm.batches import slices
from corploom.llm.bpe import token_bytes

CAPACITY = 4096
GROUP_DOCS = 4096
GROUP_TOKENS = 4 << 20
SEED = 101
_BATCH_BYTES = 2 << 20
_STORE_WORDS = 150_000
_LONG_WORD = 64  # bytes; longer words are encoded each time
_SEQUENCES = 1 << 32  # a task's sequences at most

# How files whose words are encoded on their own state it.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def by_words(spec: dict) -> bool:
    """Whether a tokenizer file encodes what stands between ASCII white space on its own."""
    normalizer, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    parts = split.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and parts[0] == _SPLIT
        and all(p.get("type") == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"] for p in parts[1:])
        and not any(set(" \t\n\r\v\f") & set(t["content"]) for t in spec["added_tokens"])
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    )


class WordEncoder:
    """Ids of words in lower case without white space, as the library gives them at a multiple of the
    time. Merges run by rank in tiktoken, on the same vocabulary; a byte that no text holds stands
    for the end of a word, and to join it to the last character comes before all merges.

    Only words that both classify alike for certain: visible ASCII and U+00C0 to U+027F, without the
    one capital whose lower case is two characters. `ids` gives None for all others.
    """

    _SURE = re.compile(rb"(?:[!-~]|[\xc3-\xc9][\x80-\xbf])+")
    _END = b"\xff"

    def __init__(self, spec: dict, path: str):
        import regex
        import tiktoken

        flat, begins = token_bytes(path)
        raw = flat.tobytes()
        model = spec["model"]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        marked = len(suffix.encode())

        def stored(token: str) -> bytes:
            own = raw[begins[vocab[token]] : begins[vocab[token] + 1]]
            return own[:-marked] + self._END if token.endswith(suffix) else own

        ranks, table = {}, []
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        merged = {"".join(p) for p in pairs}
        singles = {stored(t): i for t, i in vocab.items() if t not in merged}
        # Bytes come first, then bytes that end a word, then merges in their order.
        both = [bytes([b]) for b in range(256)] + [bytes([b]) + self._END for b in range(256)]
        for token in both:
            ranks[token] = len(table)
            table.append(singles.get(token, -1))
        for pair in pairs:
            ranks[stored("".join(pair))] = len(table)
            table.append(vocab["".join(pair)])
        self.exact = len(ranks) == len(table) and set(singles) <= set(both)
        self.table = [i.to_bytes(4, "little", signed=True) for i in table]
        self.piece = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.split = regex.compile(_SPLIT["pattern"]["Regex"]).findall
        self.marks = {mark: self._part(mark) for mark in (b".", b",")}

    def ids(self, word: bytes, known: dict[bytes, bytes]) -> bytes | None:
        """Ids of a word; `known` has those of some words, which may be parts of it."""
        if word.isalpha():  # ASCII letters
            return self._part(word.lower())
        mark = self.marks.get(word[-1:])
        if mark is not None and word[:-1].isalpha():
            stem = word[:-1].lower()
            return (known.get(stem) or self._part(stem)) + mark
        if not self._SURE.fullmatch(word) or b"\xc4\xb0" in word:
            return None
        text, found = word.decode(), []
        if text.isalpha():
            return self._part(text.lower().encode())
        for part in self.split(text.lower()):
            part = part.encode()
            found.append(known.get(part) or self._part(part))
        return b"".join(found)

    def _part(self, part: bytes) -> bytes:
        table = self.table
        return b"".join([table[rank] for rank in self.piece.encode_single_piece(part + self._END)])


class _Words(dict):
    """Ids of words; those that are not there are taken from older ones or made."""

    def __init__(self, make: Callable[[bytes], bytes], older: dict[bytes, bytes] | None = None):
        super().__init__()
        self.make, self.older = make, dict(older or {})

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= _LONG_WORD:
            self[word] = ids
        return ids


class TextEncoder:
    """Ids of texts, packed as little-endian unsigned 32-bit integers, as the tokenizers library
    gives them for the file without padding, truncation or further special tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.words = by_words(spec)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.fast = WordEncoder(spec, path) if self.words and spec["model"].get("end_of_word_suffix") else None
        if self.fast and not self.fast.exact:
            self.fast = None
        self.store = _Words(self._word)

    def _encoded(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        ids = self.fast.ids(word, self.store) if self.fast else None
        return self._encoded(word.decode()) if ids is None else ids

    def __call__(self, text: str) -> bytes:
        if not self.words:
            return self._encoded(text)
        data = text.encode()
        if any(s in data for s in self.special):
            # They are found before the text is put in lower case.
            return b"".join(
                self._encoded(w.decode()) if any(s in w for s in self.special) else self._word(w) for w in data.split()
            )
        words = self._lower(data).split()
        if len(self.store) > _STORE_WORDS:  # words that are still in use come back from the older ones
            self.store = _Words(self._word, self.store)
        return b"".join(map(self.store.__getitem__, words))

    def _lower(self, data: bytes) -> bytes:
        """In lower case as far as ASCII goes, unless that makes a special token of other text."""
        lower = data.lower()
        return data if any(s in lower for s in self.special) else lower


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin of each item and its place there. Longest items first, ties in their order; each
    goes to the first bin with room. No size may exceed the capacity."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * leaves)  # the larger room of its two under each place; leaves last
    bins, places = [0] * len(sizes), [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, at = sizes[item], 1
        if size > capacity:
            raise ValueError(f"an item of {size} does not fit a bin of {capacity}")
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins[item], places[item] = at - leaves, capacity - room[at]
        room[at] -= size
        while at > 1:
            at //= 2
            larger = max(room[2 * at], room[2 * at + 1])
            if room[at] == larger:
                break
            room[at] = larger
    return bins, places


def pack_group(lengths: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Pieces of a group's documents by document: `doc, start, length, bin, offset`; bins from 0."""
    full, rest = lengths // capacity, lengths % capacity
    pieces = full + (rest > 0)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    is_full = nth < full[doc]
    packed, places = first_fit_decreasing(rest[rest > 0].tolist(), capacity)
    used = max(packed, default=-1) + 1
    bins, offsets = np.empty(len(doc), np.int64), np.zeros(len(doc), np.int64)
    bins[is_full] = used + np.arange(int(full.sum()))
    bins[~is_full], offsets[~is_full] = packed, places
    length = np.where(is_full, capacity, rest[doc])
    return {"doc": doc, "start": nth * capacity, "length": length, "bin": bins, "offset": offsets}


def _group_rows(kept: list[pa.RecordBatch], ids: list[bytes], capacity: int, first: int):
    """Rows of a group in bounded batches, and how many sequences it fills."""
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    pieces = pack_group(lengths, capacity)
    table = pa.Table.from_batches(kept).combine_chunks()
    step = max(1, (_BATCH_BYTES * 4) // (4 * capacity))
    for at in range(0, len(pieces["doc"]), step):
        part = {name: values[at : at + step] for name, values in pieces.items()}
        cut = [
            ids[d][4 * s : 4 * (s + n)]
            for d, s, n in zip(part["doc"].tolist(), part["start"].tolist(), part["length"].tolist())
        ]
        rows = table.take(pa.array(part["doc"]))
        columns = {
            "start": part["start"],
            "length": part["length"],
            "ids": pa.array(cut, pa.binary()),
            "doc_tokens": lengths[part["doc"]],
            "sequence_id": first + part["bin"],
            "offset": part["offset"],
        }
        for name, values in columns.items():
            rows = rows.append_column(name, pa.array(values))
        yield rows.combine_chunks().to_batches()[0]
    return int(pieces["bin"].max()) + 1


RESULTS = {
    "start": T.LongType(),
    "length": T.LongType(),
    "ids": T.BinaryType(),
    "doc_tokens": T.LongType(),
    "sequence_id": T.LongType(),
    "offset": T.LongType(),
}


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: the columns of `keep`, then `start` (the document's ids before it),
    `length`, `ids` (binary: little-endian unsigned 32-bit integers), `doc_tokens` (with the end
    id), `sequence_id` and `offset` (where it begins there).

    Sequence numbers hold the partition; write the result once and read it from there.
    """
    keep = [c for c in keep if c not in RESULTS]
    end = np.array([end_id], "<u4").tobytes()
    field = "text"
    while field in keep:
        field += "_"
    columns = [F.col(text).alias(field), *[F.col(c) for c in keep]]
    order = F.xxhash64(F.lit(SEED), *columns)
    dealt = docs.select(*columns).hint("rebalance").sortWithinPartitions(order)

    def run(batches):
        encoder = _encoder(path)
        first = TaskContext.get().partitionId() * _SEQUENCES
        kept, ids, held = [], [], 0
        for batch in batches:
            for part in slices(batch, field, _BATCH_BYTES):
                texts = [t or "" for t in part.column(field).to_pylist()]
                coded = [encoder(t) + end for t in texts]
                rows = part.drop_columns([field])
                while rows.num_rows:
                    # A group takes rows while it has room for documents and tokens, one at least.
                    ends = np.cumsum([len(x) // 4 for x in coded])
                    room = int(np.searchsorted(ends, max(group_tokens - held, 0), side="right"))
                    n = min(rows.num_rows, group_docs - len(ids), room or (not ids))
                    if n:
                        kept.append(rows.slice(0, n))
                        ids += coded[:n]
                        held += int(ends[n - 1])
                        rows, coded = rows.slice(n), coded[n:]
                    if rows.num_rows:
                        first += yield from _group_rows(kept, ids, capacity, first)
                        kept, ids, held = [], [], 0
        if ids:
            yield from _group_rows(kept, ids, capacity, first)

    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(n, t) for n, t in RESULTS.items()]])
    return dealt.mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """`sequence_id, ids, n_tokens`: the pieces of each sequence in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"])))
    joined = pieces.groupBy("sequence_id").agg(F.unhex(ids).alias("ids"), F.sum("length").alias("n_tokens"))
    return joined.select("sequence_id", "ids", "n_tokens")
