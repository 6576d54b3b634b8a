"""Arrow helpers for operators that work on batches of texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corploom.functions.batches import small_batches  # noqa: F401

_BLOCK = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose values of `column` fill about `limit` bytes."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    filled = np.cumsum(sizes, dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        base = int(filled[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(filled, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of the column back to back as bytes, and where each begins (and the last ends);
    nulls are empty."""
    joined = b"".join(pc.fill_null(column, "").cast(pa.binary()).to_pylist())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Words:
    """Words of texts that lie back to back: runs of bytes that `letters` marks, never across
    texts, each with a 64-bit hash of its bytes after mapping them by `folded`."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, letters: np.ndarray, folded: np.ndarray):
        self.data = data if folded is AS_IS else folded[data]
        inside = letters[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[edges] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.text = np.searchsorted(edges, self.starts, side="right") - 1
        self.first = np.searchsorted(self.starts, edges)  # first word of each text
        self.hashes = self._hash(inside)

    def _hash(self, inside: np.ndarray) -> np.ndarray:
        """Polynomials of the words' bytes as differences of running sums, block by block."""
        hashes = np.empty(len(self.starts), np.uint64)
        begin, first = 0, 0
        while begin < len(self.data):
            end = min(begin + _BLOCK, len(self.data))
            if end < len(self.data):  # a block ends with a word
                end = int(self.ends[min(np.searchsorted(self.ends, end), len(self.ends) - 1)])
                end = max(end, min(begin + _BLOCK, len(self.data)))
            powers, inverse = _powers(end - begin)
            with np.errstate(over="ignore"):
                sums = self.data[begin:end].astype(np.uint64)
                sums += np.uint64(1)
                sums *= powers[: end - begin]
                np.cumsum(sums, out=sums)
                stop = int(np.searchsorted(self.starts, end))
                a, b = self.starts[first:stop] - begin, self.ends[first:stop] - begin
                before = np.where(a > 0, sums[a - 1], np.uint64(0))
                hashes[first:stop] = (sums[b - 1] - before) * inverse[a]
            begin, first = end, stop
        return mix(hashes)

    def grams(self, k: int) -> np.ndarray:
        """Rolling hashes of k words, one per word that has k - 1 after it; across texts too."""
        n = max(0, len(self.hashes) - k + 1)
        total = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                total = total * np.uint64(0xD1342543DE82EF95) + self.hashes[i : i + n]
        return mix(total)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


@lru_cache(maxsize=1)
def _table(size: int) -> tuple[np.ndarray, np.ndarray]:
    odd = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        powers = np.full(size, odd, np.uint64)
        inverse = np.full(size, pow(odd, -1, 2**64), np.uint64)
        powers[0] = inverse[0] = 1
        return np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, `size` of them at least."""
    return _table(max(2 * _BLOCK, 1 << (size - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _ascii_white() -> np.ndarray:
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    return white


AS_IS = np.arange(256, dtype=np.uint8)
NOT_WHITE = ~_ascii_white()
LOWER = np.where((AS_IS >= 65) & (AS_IS <= 90), AS_IS + 32, AS_IS).astype(np.uint8)
ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
