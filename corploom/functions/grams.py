"""Runs of characters counted in Arrow batches of texts, for `mapInArrow`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CHARS = 4 << 20  # of texts that are counted at a time


def gram_counts(batches: Iterator[pa.RecordBatch], sizes: range = range(2, 7)) -> Iterator[pa.RecordBatch]:
    """Runs of so many characters, side by side from the start of each text, and how often a batch
    has them. Characters are numbered within the batch, so that most runs fit a 64-bit number."""
    for batch in batches:
        every = [t for t in batch.column(0).to_pylist() if t]
        block = np.cumsum([len(t) for t in every]) // _CHARS
        for own in np.split(np.arange(len(every)), np.flatnonzero(np.diff(block)) + 1):
            texts = [every[i] for i in own]
            chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            lengths = np.array([len(t) for t in texts], np.int64)
            begins = np.cumsum(lengths) - lengths
            letters = np.flatnonzero(np.bincount(chars, minlength=1)).astype(np.uint32)
            place = np.zeros(int(chars.max(initial=0)) + 1, np.uint64)
            place[letters] = np.arange(len(letters))
            coded, base = place[chars], max(len(letters), 2)
            for n in sizes:
                runs = lengths // n
                ends = np.cumsum(runs)
                first = np.repeat(begins - n * (ends - runs), runs) + n * np.arange(int(runs.sum()))
                if not len(first):
                    continue
                if base**n < 1 << 64:
                    key = np.zeros(len(first), np.uint64)
                    for k in range(n):
                        key = key * np.uint64(base) + coded[first + k]
                    key, counts = np.unique(key, return_counts=True)
                    digits = [key // np.uint64(base**k) % np.uint64(base) for k in reversed(range(n))]
                    grams = letters[np.stack(digits, 1).astype(np.int64)]
                else:
                    grams, counts = np.unique(chars[first[:, None] + np.arange(n)], axis=0, return_counts=True)
                raw = np.ascontiguousarray(grams, "<u4").tobytes().decode("utf-32-le")
                rows = [raw[k : k + n] for k in range(0, len(raw), n)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), pa.array(counts, pa.int64())], ["t", "n"])
