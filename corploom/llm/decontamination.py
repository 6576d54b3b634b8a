"""Benchmark decontamination by greedy string tiling.

A test item leaks into a document if tiles, runs of at least `least` words that both hold, cover
enough of the item. Tiles are taken longest first and never overlap, in whatever order they stand
in the document, so reordered passages count. Words are runs of letters and digits; ASCII case
and punctuation do not matter.

Items are the query set: their rolling (Karp-Rabin) hashes of `least` words go to every task, in
blocks of some `BLOCK_BYTES` of text, one pass over the documents each. Where there are several, every pass
is written before the next block is fetched, so driver and tasks hold one block at a time. A task meets its documents' rolling
hashes with them. Pairs whose shared seeds cannot reach the coverage are dropped, which is exact:
tiles consist of seeds. The others are tiled. Nothing is shuffled. Of equally long tiles, the one
that begins first in the item, then in the document, is taken.

Null and empty texts hold no words and leak nothing; items with fewer than `least` words cannot
be tiled and never leak. Equal items are found each on its own, equal rows alike.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm.batches import ALNUM, LOWER, Words, slices, text_bytes
from corploom.llm.text import keeps_columns
from corploom.staging import stage

LEAST = 5
COVERAGE = 0.6
BLOCK_BYTES = 32 << 20  # item text in one pass
_BATCH_BYTES = 4 << 20

_TILE = pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("n", pa.int32())])


class Items:
    """Rolling hashes of the items' words, sorted, with the places they come from."""

    def __init__(self, ids: list, texts: list[str | None], least: int):
        self.ids, self.least = ids, least
        self.words = Words(*text_bytes(pa.array(texts, pa.string())), ALNUM, LOWER)
        self.sizes = np.diff(self.words.first)
        grams = self.words.grams(least)
        own = self.words.text
        valid = np.flatnonzero(own[: len(grams)] == own[least - 1 :][: len(grams)])
        valid = valid[np.argsort(grams[valid], kind="stable")]
        self.grams, self.places = grams[valid], valid
        # One bit per leading 20 bits of a hash settles most look-ups.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.grams >> np.uint64(44)] = True

    def seeds(self, docs: Words) -> tuple[np.ndarray, np.ndarray]:
        """All (document word, item word) at which `least` equal words start."""
        grams = docs.grams(self.least)
        own = docs.text
        valid = own[: len(grams)] == own[self.least - 1 :][: len(grams)]
        found = np.flatnonzero(valid & self.seen[grams >> np.uint64(44)])
        low = np.searchsorted(self.grams, grams[found])
        n = np.searchsorted(self.grams, grams[found], side="right") - low
        at = np.repeat(found, n)
        which = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return at, self.places[which]


def tile(
    seeds: list[tuple[int, int]], least: int, item_size: int, same
) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item word, document word, words) of the tiles, longest first.

    `seeds` are the (document word, item word) pairs at which `least` words agree. Seeds side by
    side on a diagonal form one match. A match that earlier tiles cover in part gives way to
    what is left of it. `same(doc, item, n)` compares the words themselves.
    """
    diagonals = defaultdict(list)
    for doc, item in seeds:
        diagonals[doc - item].append(item)
    heap = []
    for shift, items in diagonals.items():
        items.sort()
        begin = items[0]
        for a, b in zip(items, [*items[1:], None]):
            if b != a + 1:
                heap.append((begin - a - least, begin, begin + shift))
                begin = b
    heapq.heapify(heap)
    item_taken, doc_taken, tiles = np.zeros(item_size, bool), set(), []
    while heap:
        size, item, doc = heapq.heappop(heap)
        free = [not item_taken[item + k] and doc + k not in doc_taken for k in range(-size)]
        if not all(free):
            begin = None
            for k, ok in enumerate([*free, False]):
                if ok and begin is None:
                    begin = k
                elif not ok and begin is not None:
                    if k - begin >= least:
                        heapq.heappush(heap, (begin - k, item + begin, doc + begin))
                    begin = None
        elif same(doc, item, -size):
            item_taken[item : item - size] = True
            doc_taken.update(range(doc, doc - size))
            tiles.append((item, doc, -size))
    return tiles


def leaks_of(docs: Words, items: Items, coverage: float) -> dict[int, list[dict]]:
    """Per document (by number) the items it leaks."""
    at, places = items.seeds(docs)
    text, item = docs.text[at], items.words.text[places]
    order = np.lexsort((item, text))
    at, places, text, item = at[order], places[order], text[order], item[order]
    borders = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
    found = defaultdict(list)
    for begin, end in zip(borders.tolist(), [*borders[1:].tolist(), len(at)]):
        d, i = int(text[begin]), int(item[begin])
        doc_first, item_first = int(docs.first[d]), int(items.words.first[i])
        size = int(items.sizes[i])
        seeded = np.zeros(size, bool)
        own = np.unique(places[begin:end]) - item_first
        for k in range(items.least):
            seeded[own + k] = True
        if seeded.sum() < coverage * size:
            continue

        def same(doc: int, part: int, n: int) -> bool:
            return all(
                docs.word(doc_first + doc + k) == items.words.word(item_first + part + k)
                for k in range(n)
            )

        seeds = zip((at[begin:end] - doc_first).tolist(), (places[begin:end] - item_first).tolist())
        tiles = tile(list(seeds), items.least, size, same)
        matched = sum(n for _, _, n in tiles)
        if matched >= coverage * size:
            found[d].append(
                {
                    "item": items.ids[i],
                    "n_words": size,
                    "n_matched": matched,
                    "coverage": matched / size,
                    "tiles": [
                        {"item_word": a, "doc_word": b, "n": n} for a, b, n in sorted(tiles)
                    ],
                }
            )
    return found


@keeps_columns
def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    result: str = "leaks",
) -> DataFrame:
    """Adds `result`: an array with a struct (item, n_words, n_matched, coverage, tiles) for each
    item that the row leaks. A column of that name is replaced, all others pass through."""
    kind = items.schema[item_id].dataType
    tile_type = "array<struct<item_word:int,doc_word:int,n:int>>"
    leak = f"struct<item:{kind.simpleString()},n_words:int,n_matched:int,coverage:double,tiles:{tile_type}>"
    known = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    source = docs.drop(result)
    for n in range(blocks):
        if n:
            source = stage(source, "leaks")
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == n).toArrow()
        table = Items(part["id"].to_pylist(), part["text"].to_pylist(), least)
        name = f"_leaks{n}"
        schema = T.StructType([*source.schema.fields, T.StructField(name, _parse(f"array<{leak}>"))])
        source = source.mapInArrow(_finder(table, text, coverage, name, pa.list_(_arrow(kind))), schema)
    names = [f"_leaks{n}" for n in range(blocks)]
    return source.withColumn(result, F.concat(*names)).drop(*names)


def _parse(ddl: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {ddl}")["x"].dataType


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.struct(
        [
            ("item", to_arrow_type(kind)),
            ("n_words", pa.int32()),
            ("n_matched", pa.int32()),
            ("coverage", pa.float64()),
            ("tiles", pa.list_(_TILE)),
        ]
    )


def _finder(items: Items, text: str, coverage: float, name: str, kind: pa.DataType):
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, _BATCH_BYTES):
                words = Words(*text_bytes(part.column(text)), ALNUM, LOWER)
                found = leaks_of(words, items, coverage)
                leaks = [found.get(i, []) for i in range(part.num_rows)]
                yield part.append_column(name, pa.array(leaks, kind))

    return run


@keeps_columns
def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that leak no item."""
    return with_leaks(docs, items, result="_leaks", **options).where(F.size("_leaks") == 0).drop("_leaks")
