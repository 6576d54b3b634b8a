"""Spelling variants: words that differ by one character, found on a relational trie.

Words are counted over all texts. Every distinct word, read forwards and read backwards, is a path
in a trie that exists only as a table of edges (node, label, child); a node is a hash of the
characters that lead to it. States (word, position, node, edits) walk this table level by level, a
join per level: a state follows the edge whose label is the word's next character, and a state
without an edit may also take a sibling's edge, by replacing its own character or by taking the
label as inserted. States with one edit that end with their word where another word ends are
neighbours. Deletions are insertions seen from the other word.

What keeps the frontier small: a pair that first differs in its first half differs last in the
second half of the words read backwards, so a state starts at the middle of its word, where the
trie has few siblings, and each pair is met from one side at least. An edge carries the characters
that may follow it, so that a state that cannot go on is never written. Labels hold one character
up to level `_SINGLE` and get longer from there, so that a run of 200,000 letters has some
forty levels more and not 200,000; inside longer labels one edit is found by edit distance.

Node hashes may collide (64 bits); each pair is compared as text in the end, so a collision adds
nothing. A key is a word or a node with its few children, joins are inner joins without an
aggregation on the same exchange, and counts are added before they move, so that frequent words
and prefixes are no hot spots: states of a crowded node are split by adaptive execution.

Null texts hold no words, a null id counts as an empty one in the slips, equal rows count each.
Of near words with the same count, the first in code-point order is the form. An empty table gives
an empty result. Further columns of the texts are not read.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.batches import LOWER, slices, text_bytes
from corploom.staging import new_stage_path, stage

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
SLIPS = 31
_SINGLE = 32  # levels with labels of one character
_GROWTH = 1.3  # further on, labels grow by this factor
_BATCH_BYTES = 4 << 20
_SHORT = 64  # bytes; longer runs are hashed one by one


# Counting


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _runs(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of letters in UTF-8 bytes, and their texts. The letters are
    those of ASCII and U+00C0 to U+00FF, whose first byte is 0xC3."""
    lead = data == 0xC3
    inside = ((data | 32) - np.uint8(97) < 26) & (data < 128) | lead
    inside[1:] |= lead[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edges[:-1][edges[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = edges[1:][edges[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(edges, starts, side="right") - 1


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the runs back to back, and where each begins (and the last one ends)."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)], ends


def _crc32(data: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run, continued from the values of `before`; byte by byte for all runs."""
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    begins, left = ends[:-1][order], sizes[order]
    crc = ~before[order]
    for k in range(min(int(left[0]) if len(left) else 0, _SHORT)):
        n = int(np.searchsorted(-left, -k, side="left"))  # runs of more than k bytes come first
        crc[:n] = _CRC[(crc[:n] ^ data[begins[:n] + k]) & 255] ^ (crc[:n] >> np.uint32(8))
    crc = ~crc
    for i in range(int(np.searchsorted(-left, -_SHORT, side="left"))):
        rest = data[begins[i] + _SHORT : begins[i] + left[i]].tobytes()
        crc[i] = zlib.crc32(rest, int(crc[i]))
    found = np.empty(len(sizes), np.uint32)
    found[order] = crc
    return found


def _counted(part: pa.RecordBatch, slips: int | None, least: int) -> pa.RecordBatch:
    """Distinct words of a slice of rows with their counts."""
    data, edges = text_bytes(part.column("text"))
    data = LOWER[data]
    starts, ends, owner = _runs(data, edges)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    sizes = letters[ends] - letters[starts]
    kept = sizes >= least
    starts, ends, owner, sizes = starts[kept], ends[kept], owner[kept], sizes[kept]
    flat, places = _gather(data, starts, ends - starts)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(flat)]
    )
    if slips and len(starts):
        ids = ["" if i is None else str(i) for i in part.column("id").to_pylist()]
        seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        hashes = _crc32(flat, places, seeds[owner])
        slip = hashes % slips == 0
        changed = []
        for word, at in zip(words.filter(pa.array(slip)).to_pylist(), (hashes % sizes)[slip].tolist()):
            text = word.decode()
            if len(text) > least:
                changed.append((text[:at] + text[at + 1 :]).encode())
        words = pa.concat_arrays([words.filter(pa.array(~slip)), pa.array(changed, pa.large_binary())])
    counts = pc.value_counts(words)
    texts = counts.field(0).cast(pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([texts, counts.field(1)], ["word", "n"])


def word_counts(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least: int = LEAST_LETTERS,
    slips: int | None = SLIPS,
) -> DataFrame:
    """`word, n`: runs of Latin letters of `least` code points and more, with A-Z lower-cased.

    `slips` plants slips of the pen: where it divides the crc32 of `<id>:<run>`, the code point
    at that number modulo the run's length is left out. None leaves the runs as they are.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _BATCH_BYTES):
                yield _counted(part, slips, least)

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


# The trie


def level_places(longest: int) -> list[int]:
    """Characters before each level, up to `longest` and one place beyond."""
    places = list(range(min(longest, _SINGLE) + 1))
    while places[-1] <= longest:
        places.append(max(places[-1] + 1, int(places[-1] * _GROWTH)))
    return places


def _level_of(place: Column, places: list[int]) -> Column:
    """The last level that begins at or before a place."""
    later = F.size(F.filter(F.array(*map(F.lit, places)), lambda p: p <= place)) - 1
    return F.when(place <= _SINGLE, place).otherwise(later)


def _node(size: Column) -> Column:
    return F.xxhash64("back", F.substring("text", F.lit(1), size))


def _both_ways(words: DataFrame) -> DataFrame:
    """Each word as a text to read forwards and one to read backwards."""
    ways = F.array(
        F.struct(F.lit(False).alias("back"), F.col("word").alias("text")),
        F.struct(F.lit(True).alias("back"), F.reverse("word").alias("text")),
    )
    return words.select(F.inline(ways)).withColumn("size", F.length("text"))


def _at(places: list[int], level: Column) -> Column:
    return F.get(F.array(*map(F.lit, places)), level)


def trie_edges(words: DataFrame, places: list[int]) -> DataFrame:
    """`level, node, label, child, follow, ends`: the edges that states can meet, those from the
    middle of a word on. `follow` holds the characters after the child, `ends` the text that ends
    there."""
    first = _level_of(((F.col("size") - 1) / 2).cast("int"), places)
    last = _level_of(F.col("size") - 1, places)
    steps = _both_ways(words).select("*", F.explode(F.sequence(first, last)).alias("level"))
    begin, end = _at(places, F.col("level")), _at(places, F.col("level") + 1)
    edges = steps.select(
        "level",
        _node(begin).alias("node"),
        F.substring("text", begin + 1, end - begin).alias("label"),
        _node(end).alias("child"),
        F.substring("text", end + 1, F.lit(1)).alias("after"),
        F.when(F.col("size") <= end, F.col("text")).alias("ends"),
    )
    return edges.groupBy("level", "node", "label", "child").agg(
        F.array_join(F.collect_set("after"), "").alias("follow"), F.max("ends").alias("ends")
    )


def first_states(words: DataFrame, places: list[int]) -> DataFrame:
    """`level, text, back, pos, node, edits`: each text at the node of its middle."""
    level = _level_of((F.col("size") / 2).cast("int"), places)
    begun = _both_ways(words).withColumn("level", level).withColumn("pos", _at(places, F.col("level")))
    return begun.select("level", "text", "back", "pos", _node(F.col("pos")).alias("node"), F.lit(0).alias("edits"))


def step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states of the next level, and the finds: those have the other text in `other`."""
    text, pos, label = F.col("text"), F.col("pos"), F.col("label")
    long, size = F.length("label"), F.length("text")

    def part(length: Column) -> Column:
        return F.substring(text, pos + 1, length)

    def alive(place: Column) -> Column:
        after = F.substring(text, place + 1, F.lit(1))
        return F.when(place == size, F.col("ends").isNotNull()).otherwise(F.contains("follow", after))

    def one_apart(length: Column) -> Column:
        other = part(length)
        return (long == 1) | ((F.length(other) == length) & (F.levenshtein(other, label, 1) == 1))

    own, new = part(long), F.col("edits") == 0
    same = label == own
    # A state without an edit goes on while its node has further characters: another word's may differ.
    go_on = F.when(same & F.when(new, F.col("follow") != "").otherwise(alive(pos + long)), pos + long)
    # The word that is greater in the replaced character leaves the pair to the other one.
    replace = F.when(new & (label > own) & alive(pos + long) & (F.length(own) == long) & one_apart(long), pos + long)
    insert = F.when(new & ~same & alive(pos + long - 1) & one_apart(long - 1), pos + long - 1)
    found = F.array(
        F.struct(go_on.alias("pos"), F.col("edits").alias("edits")),
        F.struct(replace.alias("pos"), F.lit(1).alias("edits")),
        F.struct(insert.alias("pos"), F.lit(1).alias("edits")),
    )
    moves = states.join(edges, "node").where(go_on.isNotNull() | replace.isNotNull() | insert.isNotNull())
    moves = moves.select(
        "text", "back", "child", "ends", "follow", F.explode(F.filter(found, lambda s: s["pos"].isNotNull())).alias("to")
    )
    done = (F.col("to.edits") == 1) & (F.col("to.pos") == F.length("text"))
    return moves.select(
        "text",
        "back",
        F.col("to.pos").alias("pos"),
        F.when(~done, F.col("child")).alias("node"),
        F.col("to.edits").alias("edits"),
        F.when(done, F.col("ends")).alias("other"),
    )


def near_words(words: DataFrame) -> DataFrame:
    """`word, near`: all pairs of distinct words that differ by one inserted, deleted or replaced
    code point, both ways round. `words` is a table of distinct words, as it is read several
    times."""
    spark = words.sparkSession
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    places = level_places(longest)
    root = new_stage_path(spark, "trie")
    edges = trie_edges(words, places)
    edges.write.partitionBy("level").parquet(f"{root}/edges")
    begun = first_states(words, places)
    begun.write.partitionBy("level").parquet(f"{root}/begun")
    edges = spark.read.schema(edges.schema).parquet(f"{root}/edges")
    begun = spark.read.schema(begun.schema).parquet(f"{root}/begun")
    levels = sorted(r[0] for r in edges.select("level").distinct().collect())
    moved, finds = None, []
    for level in levels:
        at_level = F.col("level") == level
        states = begun.where(at_level).drop("level")
        if moved is not None:
            states = states.unionByName(moved.where(F.col("other").isNull()).drop("other"))
        moved = stage(step(states, edges.where(at_level).drop("level")), "frontier")
        finds.append(moved.where(F.col("other").isNotNull()).select("text", "back", "other"))
    if not finds:
        return words.select("word", F.col("word").alias("near")).limit(0)

    def spelled(name: str) -> Column:
        return F.when(F.col("back"), F.reverse(name)).otherwise(F.col(name))

    pairs = reduce(DataFrame.unionByName, finds).select(spelled("text").alias("a"), spelled("other").alias("b"))
    pairs = pairs.where(F.levenshtein("a", "b", 1) == 1)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")),
    )
    return pairs.select(F.inline(both)).distinct()


def with_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for a table of distinct words with counts `n`.

    A form has `ratio` times the count of its word at least, so a chain of forms has at most as
    many links as the largest count has digits in that base; roots double their reach each round.
    """
    pairs = near_words(words.select("word"))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = pairs.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    chosen = F.col("best.near").isNotNull() & (-F.col("best.less") >= ratio * F.col("n"))
    rows = stage(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(chosen, F.col("best.near")).alias("form"),
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    most = rows.agg(F.max("n")).first()[0] or 0
    links = 0
    while ratio**links <= most:
        links += 1
    roots = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(links.bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = stage(roots, "roots")
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least: int = LEAST_LETTERS,
    slips: int | None = SLIPS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """Words with `least_count` occurrences and more, each with its form and root; see `with_forms`."""
    words = word_counts(docs, text, doc_id, least, slips).where(F.col("n") >= least_count)
    return with_forms(stage(words, "words"), ratio)
