"""Byte-level BPE with content-defined chunk reuse, and its inverse.

A rolling hash over the UTF-8 bytes cuts texts into chunks at places that depend on the bytes
around them only, so texts that share a passage share its chunks. A task encodes every chunk once
while it is in its bounded store. Tokens at a join of two chunks may differ from those of the
whole text; the stretch over the join is encoded anew, from the last place in the left chunk to
the first in the right one at which chunk and whole text agree for certain that a word starts.

Why this is exact: words (pre-tokens) are encoded on their own, and the pattern that splits them
reads from left to right. A space between two visible ASCII characters starts a word in every
text that holds the three, so between two such places chunk and whole text have the same words. That
goes for files of the usual byte-level kind; with any other, texts are encoded and decoded whole.

Rows stay where they are: no shuffle, nothing kept between tasks, and a lost executor costs its
tasks. Nulls count as empty texts (no ids); equal rows are encoded alike; columns named as the
results are replaced, all others pass through.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corploom.llm.batches import slices

_WINDOW = 16  # bytes the rolling hash sees
_MASK = np.uint64((1 << 9) - 1)  # a cut every 512 bytes on average
_LEAST = 128  # bytes between cuts
_STORE_BYTES = 6 << 20  # text held in a task's store of chunks
_BATCH_BYTES = 2 << 20  # text encoded at a time
# Fixed value: how files of the usual kind state the split into words.
_USUAL_SPLIT = {
    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
}


def cut_places(data: np.ndarray) -> np.ndarray:
    """Ascending byte places to cut at; never inside a character, at least `_LEAST` apart.

    The hash of the `_WINDOW` bytes before each place is a sum of bytes times powers of an odd
    number, built for all places at once by doubling.
    """
    if len(data) < 2 * _LEAST:
        return np.empty(0, np.int64)
    hashes = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factor, span = np.uint64(0xD1342543DE82EF95), 1
    with np.errstate(over="ignore"):
        while span < _WINDOW:
            hashes = hashes[:-span] * factor + hashes[span:]
            factor, span = factor * factor, span * 2
    starts = (data[_WINDOW:] & 0xC0) != 0x80
    found = np.flatnonzero(((hashes[:-1] >> np.uint64(40)) & _MASK == 0) & starts) + _WINDOW
    kept, last = [], 0
    for place in found.tolist():
        if place - last >= _LEAST:
            kept.append(place)
            last = place
    return np.array(kept, np.int64)


def sure_word_starts(data: np.ndarray) -> np.ndarray:
    """Places where every text with these bytes starts a word, whatever stands further off: a
    space between two printable ASCII characters other than space."""
    seen = (data > 0x20) & (data < 0x7F)
    return np.flatnonzero((data[1:-1] == 0x20) & seen[:-2] & seen[2:]) + 1


@lru_cache(maxsize=1)
def _unsure() -> re.Pattern:
    """Characters that libraries with other Unicode versions may class otherwise: those without
    an assignment in version 3.2."""
    old, ranges, begin = unicodedata.ucd_3_2_0, [], None
    for code in range(sys.maxunicode + 2):
        new = code <= sys.maxunicode and old.category(chr(code)) == "Cn"
        if new and begin is None:
            begin = code
        elif not new and begin is not None:
            ranges.append(f"\\U{begin:08x}-\\U{code - 1:08x}")
            begin = None
    return re.compile("[" + "".join(ranges) + "]")


# The fast way takes a time that grows with the square of a word's length.
_LONG_WORD = re.compile(r"[^\x20]{1000}|\s{1000}")

# Fixed value: the pattern by which byte-level vocabularies of this kind split words.
_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def is_usual(spec: dict) -> bool:
    """Whether a file is byte-level BPE of the kind whose texts may be cut where words surely start,
    and whose tokens are bytes of the text."""
    model = spec["model"]
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "end_of_word_suffix", "continuing_subword_prefix")):
        return False
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    made = [model["vocab"]["".join(pair)] for pair in pairs]
    placed = ("single_word", "lstrip", "rstrip")
    return (
        spec["pre_tokenizer"] == _USUAL_SPLIT
        and spec["normalizer"] is None
        and not any(t[k] for t in spec.get("added_tokens", []) for k in placed)
        and all(a < b for a, b in zip(made, made[1:]))
    )


class Encoder:
    """Encodes texts as the tokenizers library does, special tokens in texts included.

    Chunks go through tiktoken on the same vocabulary, which gives the same ids at a fraction of
    the time. Chunks with characters that the two libraries may class differently go through the
    tokenizers library itself; so does everything if the vocabulary is not of the usual kind.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.fast = None
        if is_usual(spec):
            vocab = spec["model"]["vocab"]
            flat, ends = token_bytes(path)
            self.sizes = np.diff(ends)
            raw = flat.tobytes()
            ranks = {raw[ends[i] : ends[i + 1]]: i for i in vocab.values()}
            self.fast = tiktoken.Encoding(
                "corpus", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}
            )
        self.store: dict[bytes, np.ndarray] = {}
        self.held = 0

    def piece(self, data: bytes) -> np.ndarray:
        """Ids of a chunk or window on its own; encoded once while the store holds it."""
        ids = self.store.get(data)
        if ids is None:
            text = data.decode()
            # All characters below U+0280 are sure; their first bytes are below 0xCA.
            sure = text.isascii() or max(data) < 0xCA or not _unsure().search(text)
            if self.fast and sure and not _LONG_WORD.search(text):
                ids = self.fast.encode_to_numpy(text, disallowed_special=())
            else:
                ids = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            if self.held > _STORE_BYTES:
                self.clear()
            self.store[data] = ids
            self.held += len(data)
        return ids

    def clear(self):
        self.store.clear()
        self.held = 0

    def part(self, data: bytes, begin: int, end: int) -> np.ndarray:
        """Ids of `data[begin:end]` out of the ids of all of it; both ends start words in it."""
        ids = self.piece(data)
        ends = np.cumsum(self.sizes[ids])
        first = np.searchsorted(ends, begin, side="right") if begin else 0
        return ids[first : np.searchsorted(ends, end, side="right")]

    def encode(self, text: str) -> np.ndarray:
        if not self.fast:  # words may depend on what stands around them: no cuts
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        parts = [np.empty(0, np.uint32)]
        for part in self._split_special(text):
            if isinstance(part, int):
                parts.append(np.array([part], np.uint32))
            else:
                parts += self._segment(part.encode())
        return np.concatenate(parts)

    def _split_special(self, text: str) -> list[str | int]:
        parts: list[str | int] = [text] if text else []
        for content, number in self.special.items():
            split: list[str | int] = []
            for part in parts:
                if isinstance(part, int) or content not in part:
                    split.append(part)
                    continue
                for k, rest in enumerate(part.split(content)):
                    split += [number] * (k > 0) + [rest] * bool(rest)
            parts = split
        return parts

    def _segment(self, data: bytes) -> list[np.ndarray]:
        """A stretch of text between special tokens: each chunk gives the ids between its first
        and its last sure word start, windows over the joins give those in between. A chunk
        without sure word starts falls into a window as a whole."""
        raw = np.frombuffer(data, np.uint8)
        edges = [0, *cut_places(raw).tolist(), len(data)]
        if len(edges) == 2:
            return [self.piece(data)]
        sure = sure_word_starts(raw)
        # Those with both neighbours inside the chunk.
        first = np.searchsorted(sure, np.array(edges[:-1]) + 1).tolist()
        last = np.searchsorted(sure, np.array(edges[1:]) - 2, side="right").tolist()
        parts, done = [], 0
        for k, (begin, end) in enumerate(zip(edges, edges[1:])):
            inside = first[k] < last[k]
            if not inside:
                continue
            start = int(sure[first[k]]) if k else 0
            stop = int(sure[last[k] - 1]) if end < len(data) else end
            if done < start:
                parts.append(self.piece(data[done:start]))
            parts.append(self.part(data[begin:end], start - begin, stop - begin))
            done = stop
        if done < len(data):
            parts.append(self.piece(data[done:]))
        return parts


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens back to back, and where each id's begin (and the last one's end)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others
    # for the characters from 256 on, in order.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    by_id = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    by_id |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    ends = np.cumsum([0, *map(len, tokens)])
    return np.frombuffer(b"".join(tokens), np.uint8), ends


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """Bytes of the ids' tokens, without a loop over tokens."""
    flat, begins = token_bytes(path)
    if len(ids) and int(ids.max()) >= len(begins) - 1:
        raise ValueError(f"no token has the id {int(ids.max())}")
    first, sizes = begins[ids], begins[ids + 1] - begins[ids]
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ids) else 0) + np.repeat(first - ends + sizes, sizes)].tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def _decoder(path: str) -> Callable[[np.ndarray], str]:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if is_usual(spec) and (spec.get("decoder") or {}).get("type") == "ByteLevel":
        return lambda ids: decode_ids(ids, path).decode(errors="replace")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda ids: library.decode(ids.tolist(), skip_special_tokens=False)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids` (binary: little-endian unsigned 32-bit integers) for the tokenizer file."""

    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            for part in slices(batch, text, _BATCH_BYTES):
                texts = part.column(text).to_pylist()
                packed = [encoder.encode(t or "").astype("<u4").tobytes() for t in texts]
                yield part.append_column(ids, pa.array(packed, pa.binary()))
        encoder.clear()

    source = df.drop(ids)
    schema = T.StructType([*source.schema.fields, T.StructField(ids, T.BinaryType())])
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds `decoded`: the text of the ids, special tokens included. Null ids give null; bytes
    that are no UTF-8 become U+FFFD."""

    def run(batches):
        text_of = _decoder(path)
        for batch in batches:
            for part in slices(batch, ids, 4 * _BATCH_BYTES):
                packed = part.column(ids).to_pylist()
                texts = [None if x is None else text_of(np.frombuffer(x, "<u4")) for x in packed]
                yield part.append_column(decoded, pa.array(texts, pa.string()))

    source = df.drop(decoded)
    schema = T.StructType([*source.schema.fields, T.StructField(decoded, T.StringType())])
    return source.mapInArrow(run, schema)
