"""Substring dedup with FM-indexes over content-routed shards.

A window is `WINDOW` consecutive words of one document. Words covered by a window whose words also
start in a document with a smaller id are removed; windows are judged on the input.

Texts meet only where they may share a window. Each window has an anchor, the four-word gram of
smallest hash in it, which depends on the window's words alone. Anchors that occur in one document
only are dropped by a count. Stretches of windows with a shared anchor are routed to the shard of
that anchor (those of an anchor that is frequent itself, such as one in a line that a third
of the documents begin with, window by window to the shard of the window's own words), so all
places of a window meet in one shard and no shard grows with a frequent passage.

Each shard is indexed: suffixes are sorted by as many words as patterns have, the Burrows-Wheeler
transform is kept as the places of each word in it, and all distinct windows are streamed through
backward search at once. The interval of a window holds all its places; the smallest document id
in it owns the window. Owners are told the windows they keep, in rows that grow with distinct
windows and not with copies; every other document removes its shared windows.

Equal texts need no care: copies send equal stretches, which are merged where they are made.
Documents without an id are no one's copy and lose nothing; those with equal ids do not count as
smaller than each other. Null and empty texts have no words. Word identities are 64-bit hashes.
Columns named as the results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm.batches import AS_IS, NOT_WHITE, Words, mix, slices, text_bytes
from corploom.llm.text import keeps_columns

WINDOW = 13
_ANCHOR = 4
_SORTED = 16  # words that suffixes are sorted by; one more than a pattern at least
_FREQUENT = 4096  # documents, from which on an anchor's windows are routed one by one
_BATCH_BYTES = 4 << 20
_MERGED = 200_000  # stretches held by a task to merge equal ones
_SHARD_WORDS = 500_000  # words indexed at a time; groups of one route are not split


class FMIndex:
    """Backward search in a sequence of symbols for stretches of it with less than `_SORTED` of them.

    The transform is kept as the sorted places of each symbol, all in one array: how many symbols are
    smaller or stand before a place is one binary search, whatever the number of symbols. Sorting
    leaves the intervals of one, two, four and eight symbols, from which a search starts; where one suffix
    is left, the suffix before it is looked up."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.seeds = []
        rank, span = sequence.astype(np.int64), 1
        while span < _SORTED:
            self.seeds.append((span, rank, np.concatenate([[0], np.cumsum(np.bincount(rank, minlength=symbols))])))
            after = np.zeros_like(rank)
            after[: len(rank) - span] = rank[span:] + 1
            rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after, return_inverse=True)[1]
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        last = sequence[self.suffixes - 1].astype(np.int64)
        self.width = len(sequence) + 1
        self.places = np.sort(last * self.width + np.arange(len(sequence)))
        row = np.empty_like(self.suffixes)
        row[self.suffixes] = np.arange(len(sequence))
        self.onward = row[self.suffixes - 1]

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.places, symbol * self.width + place)

    def intervals(self, sequence: np.ndarray, ends: np.ndarray, size: int):
        """Suffix intervals [low, high) of the stretches of `size` symbols that end before the
        places `ends`, matched from their last symbol backwards."""
        span, rank, before = next(seed for seed in reversed(self.seeds) if seed[0] <= size)
        seed = rank[ends - span]
        low, high = before[seed], before[seed + 1]
        for step in range(span + 1, size + 1):
            symbol = sequence[ends - step]
            several = np.flatnonzero(high - low > 1)
            begin = self._down(symbol[several], low[several])
            end = self._down(symbol[several], high[several])
            low = self.onward[low]
            high = low + 1
            low[several], high[several] = begin, end
        return low, high


def owners(pieces: list[bytes], documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, smallest document) of every distinct window in the pieces of one shard."""
    words = Words(*text_bytes(pa.array(pieces, pa.binary())), NOT_WHITE, AS_IS)
    names, own = np.unique(words.hashes, return_inverse=True)
    # Pieces are parted by the symbol 0.
    text = words.text
    at = np.arange(len(own)) + text
    sequence = np.zeros(len(own) + len(pieces), np.int64)
    sequence[at] = own + 1
    place_document = np.zeros(len(sequence), documents.dtype)
    place_document[at] = documents[text]
    index = FMIndex(sequence, len(names) + 1)
    # Each distinct window is searched once.
    first = _windows(words)
    hashes, which = np.unique(words.grams(WINDOW)[first], return_index=True)
    low, high = index.intervals(sequence, at[first[which]] + WINDOW, WINDOW)
    # Windows are of one length, so intervals are equal or apart.
    low, which = np.unique(low, return_index=True)
    hashes, high = hashes[which], high[which]
    held = place_document[index.suffixes]
    edges = np.stack([low, high], 1).ravel()
    smallest = np.minimum.reduceat(np.append(held, held[-1:]), edges)[::2] if len(low) else held[:0]
    return hashes, smallest


def _windows(words: Words) -> np.ndarray:
    """First words of all windows."""
    n = max(0, len(words.text) - WINDOW + 1)
    return np.flatnonzero(words.text[:n] == words.text[WINDOW - 1 :][:n])


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, anchor word and anchor hash of all windows."""
    first = _windows(words)
    grams = words.grams(_ANCHOR)
    if not len(first):
        return first, first, grams[:0].view(np.int64)
    inside = WINDOW - _ANCHOR + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, inside)
    at = first + np.argmin(views, axis=1)[first]
    return first, at, grams[at].view(np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _parts(batches, text: str) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for part in slices(batch, text, _BATCH_BYTES):
            yield part, Words(*text_bytes(part.column(text)), NOT_WHITE, AS_IS)


def _anchor_rows(row_id: str, text: str):
    def run(batches):
        for part, words in _parts(batches, text):
            first, at, anchor = _anchors(words)
            runs = _runs(words.text[first], at)
            ids = part.column(row_id).cast(pa.int64()).take(pa.array(words.text[first[runs]]))
            yield pa.RecordBatch.from_arrays([pa.array(anchor[runs]), ids], ["anchor", "_id"])

    return run


def _shared_windows(part: pa.RecordBatch, words: Words):
    """Per window: first word, anchor word, its hash, whether the anchor is shared, and whether
    it is frequent."""
    first, at, anchor = _anchors(words)
    shared, frequent = np.zeros(len(first), bool), np.zeros(len(first), bool)
    begins = np.searchsorted(first, words.first)
    # Shared anchors come back by their lower halves. An anchor that is taken for shared by mistake
    # is in this document alone, which then owns its windows; frequent ones decide routes and are whole.
    lower = anchor.astype(np.int32)
    for name, anchor_of, out in (("_shared", lower, shared), ("_frequent", anchor, frequent)):
        column = part.column(name)
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(valid & (np.diff(offsets) > 0) & (np.diff(begins) > 0)):
            own = slice(begins[i], begins[i + 1])
            out[own] = np.isin(anchor_of[own], values[offsets[i] : offsets[i + 1]])
    return first, at, anchor, shared | frequent, frequent


def _piece_batch(smallest: dict[tuple[int, bytes], int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in smallest], pa.int64()),
            pa.array([k[1] for k in smallest], pa.binary()),
            pa.array(smallest.values(), pa.int64()),
        ],
        ["route", "piece", "_id"],
    )


def _piece_rows(row_id: str, text: str):
    """Stretches with the smallest id they occur under; equal ones of a task are merged while no
    more than `_MERGED` are held."""

    def run(batches):
        smallest: dict[tuple[int, bytes], int] = {}
        for part, words in _parts(batches, text):
            first, at, anchor, shared, frequent = _shared_windows(part, words)
            first, at, anchor, frequent = (x[shared] for x in (first, at, anchor, frequent))
            if not len(first):
                continue
            # A stretch has windows side by side with one anchor; of frequent ones, one window.
            own = words.text[first]
            begin = _runs(own, at, first - np.arange(len(first)), np.where(frequent, first, -1))
            end = np.append(begin[1:], len(first)) - 1
            route = np.where(frequent, words.grams(WINDOW)[first].view(np.int64), anchor)[begin]
            ids = part.column(row_id).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)[own[begin]]
            raw, starts, ends = words.data, words.starts, words.ends
            for r, a, b, i in zip(
                route.tolist(), starts[first[begin]], ends[first[end] + WINDOW - 1], ids.tolist()
            ):
                key = (r, raw[a:b].tobytes())
                known = smallest.get(key)
                smallest[key] = i if known is None or i < known else known
            if len(smallest) > _MERGED:
                yield _piece_batch(smallest)
                smallest = {}
        yield _piece_batch(smallest)

    return run


def _owner_rows(batches):
    """Indexes the partition shard by shard; its rows come in order of their routes."""
    routes, pieces, ids, words = [], [], [], 0

    def index(n: int):
        hashes, smallest = owners(pieces[:n], np.array(ids[:n], np.int64))
        del routes[:n], pieces[:n], ids[:n]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(smallest)], ["window", "_id"]
        )

    for batch in batches:
        own = batch.column("piece").to_pylist()
        routes += batch.column("route").to_pylist()
        pieces += own
        ids += batch.column("_id").to_pylist()
        words += sum(len(p) for p in own) // 6
        if words >= _SHARD_WORDS:
            n = next((k for k in range(len(routes) - 1, 0, -1) if routes[k] != routes[k - 1]), 0)
            if n:
                yield index(n)
                words = sum(len(p) for p in pieces) // 6
    if pieces:
        yield index(len(pieces))


def _joined(words: Words, kept: np.ndarray) -> list[str]:
    """The kept words of each text, joined by one space."""
    which = np.flatnonzero(kept)
    starts, sizes = words.starts[which], words.ends[which] - words.starts[which] + 1
    ends = np.cumsum(sizes)
    # Each word and a byte after it, which becomes the space.
    place = np.arange(int(sizes.sum())) + np.repeat(starts - ends + sizes, sizes)
    joined = np.append(words.data, np.uint8(0x20))[place]
    joined[ends - 1] = 0x20
    edges = np.concatenate([[0], ends])[np.searchsorted(which, words.first)]
    raw = joined.tobytes()
    return [raw[a : max(a, b - 1)].decode() for a, b in zip(edges, edges[1:])]


def _result_rows(fields: list[str], names: tuple[str, str, str], text: str):
    def run(batches):
        for part, words in _parts(batches, text):
            first, _, _, gone, _ = _shared_windows(part, words)
            hashes = words.grams(WINDOW)[first].view(np.int64)
            kept = part.column("_kept")
            offsets, values = kept.offsets.to_numpy(), kept.values.to_numpy(zero_copy_only=False)
            begins = np.searchsorted(first, words.first)
            for i in np.flatnonzero((np.diff(begins) > 0) & kept.is_valid().to_numpy(False)):
                own = slice(begins[i], begins[i + 1])
                gone[own] &= ~np.isin(hashes[own], values[offsets[i] : offsets[i + 1]])
            edges = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(edges, first[gone], 1)
            np.add.at(edges, first[gone] + WINDOW, -1)
            removed = np.cumsum(edges[:-1]) > 0
            sizes = np.diff(words.first)
            n_removed = np.diff(np.concatenate([[0], np.cumsum(removed)])[words.first])
            texts = _joined(words, ~removed)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(name) for name in fields],
                    pa.array(sizes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                [*fields, *names],
            )

    return run


@keeps_columns
def without_repeats(
    df: DataFrame, text: str = "text", row_id: str = "doc_id", result: str = "kept_text"
) -> DataFrame:
    """Adds `n_words`, `n_removed` and `result`, the words that stay, joined by one space.
    `row_id` is an integer column."""
    names = ("n_words", "n_removed", result)
    source = df.drop(*names)
    key = source[row_id].cast("bigint")
    anchors = (
        source.where(key.isNotNull())
        .select(row_id, text)
        .mapInArrow(_anchor_rows(row_id, text), "anchor bigint, _id bigint")
        # Moved once, to be counted and to be joined with the counts: both readers keep to one filter.
        .where("anchor is not null and _id is not null")
        .repartition("anchor")
    )
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("_id").alias("a"), F.max("_id").alias("b"), F.count(F.lit(1)).alias("n"))
        .where(F.col("a") != F.col("b"))
        .select("anchor", (F.col("n") > _FREQUENT).alias("often"))
    )
    lower = F.shiftright(F.shiftleft("anchor", 32), 32).cast("int")
    lists = (
        anchors.join(shared, "anchor")
        .groupBy("_id")
        .agg(
            F.collect_set(F.when(~F.col("often"), lower)).alias("_shared"),
            F.collect_set(F.when(F.col("often"), F.col("anchor"))).alias("_frequent"),
        )
    )
    # Both readers of this join take all of its columns, so that texts move once for both.
    listed = source.join(lists, key == lists["_id"], "left").drop("_id")
    pieces = listed.mapInArrow(
        _piece_rows(row_id, text), "route bigint, piece binary, _id bigint"
    )
    kept = (
        pieces.repartition("route")
        .groupBy("route", "piece")
        .agg(F.min("_id").alias("_id"))
        .sortWithinPartitions("route")
        .mapInArrow(_owner_rows, "window bigint, _id bigint")
        .groupBy("_id")
        .agg(F.collect_list("window").alias("_kept"))
    )
    found = listed.join(kept, listed[row_id].cast("bigint") == kept["_id"], "left").drop("_id")
    fields = source.columns
    schema = T.StructType(
        [
            *source.schema.fields,
            T.StructField(names[0], T.LongType()),
            T.StructField(names[1], T.LongType()),
            T.StructField(result, T.StringType()),
        ]
    )
    return found.mapInArrow(_result_rows(fields, names, text), schema)
