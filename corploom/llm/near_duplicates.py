"""Near-duplicate classes by weighted MinHash with darts.

A text is the multiset of its five-word shingles. Darts fall on every copy of every shingle at
random times that only shingle and copy number decide, as a Poisson process would have it; each
dart hits one of `COORDINATES` coordinates, and the earliest dart of a coordinate is its entry in
the signature. Two texts agree in a coordinate with the probability of their weighted Jaccard
similarity. Only darts before a time limit are thrown, set so that some k ln k + 2k fall; if a
coordinate stays empty, the limit is doubled, which does not change what came first.

Signatures are cut in bands; texts that agree in a band share its bucket. Within a bucket,
signatures are compared inside the task, and only a spanning forest of the closest texts leaves it:
a row per text at most, however many texts are alike. Its links are then judged exactly, by the
shingles of both texts. Where all links of a tree hold, all its texts are connected. Where one does
not and its texts stay apart, the bucket gets the shingles of its texts, and every pair of them
that agrees enough and is not connected yet is judged in the task, in the first band the two share.
Classes are the connected components of the links that hold. No group is expanded to pairs. Buckets of
more than `MOST_MATES` texts are compared in blocks which all hold the bucket's central text, the one
with most mates in all buckets: an original rather than one of its altered copies. What these leave
apart is compared with every other block, two blocks a task.

Copies: texts are told apart by a digest of the whole text, and only distinct ones take part, so
a text that makes up a third of the rows is one row. Texts with fewer than five words are one
shingle; null texts count as empty, and empty texts have no shingles and equal only each other.
Rows may repeat and ids be null: all rows of equal text share a class.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.llm.batches import AS_IS, NOT_WHITE, Words, mix, slices, text_bytes
from corploom.llm.text import whole
from corploom.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5  # a pair at 0.8 shares no band once in 30,000 times
COORDINATES = BANDS * ROWS
_AGREE = 85  # coordinates; a pair at 0.8 agrees in fewer once in 30,000 times
MOST_MATES = 2048  # texts of a bucket that are compared in one block
BLOCK_BYTES = 32 << 20  # shingles of a block that are judged exactly
_BATCH_BYTES = 2 << 20
_THROWN_TEXTS = 256  # a text throws some 900 darts, however short it is


def shingles(words: Words, text: int) -> np.ndarray:
    """Hashes of the shingles of one text, sorted, repeated ones kept."""
    begin, end = words.first[text], words.first[text + 1]
    if end - begin >= SHINGLE:
        return np.sort(words.rolling[begin : end - SHINGLE + 1])
    if end > begin:
        own = words.hashes[begin:end]
        with np.errstate(over="ignore"):
            odd = np.uint64(2) * np.arange(1, len(own) + 1, dtype=np.uint64) + np.uint64(1)
            return mix(np.array([(own * odd).sum()], np.uint64))
    return np.empty(0, np.uint64)


def signatures(texts: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row per text, given its sorted shingles (one at least): the earliest dart of each
    coordinate. `_THROWN_TEXTS` texts are thrown at together."""
    parts = [texts[i : i + _THROWN_TEXTS] for i in range(0, len(texts), _THROWN_TEXTS)]
    return np.concatenate([np.empty((0, coordinates), np.uint64), *(_signatures(p, coordinates) for p in parts)])


def _signatures(texts: list[np.ndarray], coordinates: int) -> np.ndarray:
    entries = np.zeros((len(texts), coordinates), np.uint64)
    left = np.arange(len(texts))
    darts_wanted = coordinates * np.log(coordinates) + 2 * coordinates
    while len(left):
        sizes = np.array([len(texts[i]) for i in left])
        owner = np.repeat(np.arange(len(left)), sizes)
        cells = _cells(np.concatenate([texts[i] for i in left]), owner)
        darts, times, at = _darts(cells, (darts_wanted / sizes)[owner], owner)
        slot = at * coordinates + (darts % np.uint64(coordinates)).astype(np.int64)
        # Latest first: of equal slots the last write stands, so the earliest dart.
        order = np.lexsort((darts, times))[::-1]
        found = np.zeros(len(left) * coordinates, np.uint64)
        filled = np.zeros(len(found), bool)
        found[slot[order]] = darts[order]
        filled[slot] = True
        full = filled.reshape(-1, coordinates).all(1)
        entries[left[full]] = found.reshape(-1, coordinates)[full]
        left, darts_wanted = left[~full], 2 * darts_wanted
    return entries


def _cells(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A hash for each copy of each shingle: the first copy, the second, and so on."""
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    copy = np.arange(len(values)) - np.repeat(begins, np.diff(np.append(begins, len(values))))
    with np.errstate(over="ignore"):
        return mix(values + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _darts(cells: np.ndarray, limit: np.ndarray, owner: np.ndarray):
    """(dart, time, owner) of all darts on the cells before their limits. Gaps between the darts
    of a cell are exponential."""
    darts, times, owners = [], [], []
    now, dart = np.zeros(len(cells)), cells
    while len(dart):
        with np.errstate(over="ignore"):
            dart = mix(dart * np.uint64(0xD1342543DE82EF95) + np.uint64(0x632BE59BD9B4E019))
        share = ((mix(dart) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        now = now - np.log(share)
        early = now < limit
        dart, now, limit, owner = dart[early], now[early], limit[early], owner[early]
        darts.append(dart)
        times.append(now)
        owners.append(owner)
    return np.concatenate(darts), np.concatenate(times), np.concatenate(owners)


def bands_of(entries: np.ndarray) -> np.ndarray:
    """One 64-bit number per text and band, different for different bands."""
    rows = entries.reshape(-1, BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            total = mix(total * np.uint64(0xD1342543DE82EF95) + rows[:, :, k])
    return total


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    of_a = np.searchsorted(a, values, side="right") - np.searchsorted(a, values)
    of_b = counts - of_a
    most = np.maximum(of_a, of_b).sum()
    return float(np.minimum(of_a, of_b).sum() / most) if most else 1.0


def _texts(batch: pa.RecordBatch):
    for part in slices(batch, "_text", _BATCH_BYTES):
        words = Words(*text_bytes(part.column("_text")), NOT_WHITE, AS_IS)
        words.rolling = words.grams(SHINGLE)
        yield part.column("_key"), words


def _signed(batches):
    """Keys, shingles and signatures of the texts that have shingles."""
    for batch in batches:
        for keys, words in _texts(batch):
            own = [shingles(words, i) for i in range(len(keys))]
            has = [i for i, x in enumerate(own) if len(x)]
            if has:
                own = [own[i] for i in has]
                yield keys.take(pa.array(has)), own, signatures(own)


def _band_rows(batches):
    for keys, _, entries in _signed(batches):
        repeated = np.repeat(np.arange(len(keys)), BANDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bands_of(_half(entries)).ravel().view(np.int64)), keys.take(pa.array(repeated))],
            ["band", "_key"],
        )


def _half(hashes: np.ndarray) -> np.ndarray:
    """Upper halves of hashes: enough to tell the darts or shingles of two texts apart."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _held_rows(batches):
    for keys, own, entries in _signed(batches):
        packed = [row.tobytes() for row in _half(entries)]
        sets = [np.sort(_half(x)).tobytes() for x in own]
        yield pa.RecordBatch.from_arrays(
            [keys, pa.array(packed, pa.binary()), pa.array(sets, pa.binary())],
            ["_key", "signature", "own"],
        )


def closest_forest(signs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Links of a spanning forest in which every text hangs on the one it agrees with most, in
    `least` coordinates at least, with the number of their tree. Grown text by text, with one row of
    agreements at a time."""
    n = len(signs)
    best, mate = np.full(n, -1), np.zeros(n, np.int64)
    out, now, tree, found = np.ones(n, bool), 0, 0, []
    for _ in range(n - 1):
        out[now] = False
        agree = (signs == signs[now]).sum(1)
        closer = out & (agree > best)
        best[closer], mate[closer] = agree[closer], now
        now = int(np.argmax(np.where(out, best, -2)))
        if best[now] >= least:
            found.append((now, int(mate[now]), tree))
        else:
            tree += 1
    return found


def _runs(batches, columns: tuple[str, ...], by: int):
    """Lists of rows that are equal in the first `by` columns; they come one after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and held[0][:by] != row[:by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _signs(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint32).reshape(len(packed), -1)


def _forest_rows(batches):
    """Links within each run of rows of one (band, block). `more`: their tree has other pairs."""
    for held in _runs(batches, ("band", "block", "_key", "signature"), 2):
        pairs = closest_forest(_signs([r[3] for r in held]), _AGREE) if len(held) > 1 else []
        links = Counter(tree for _, _, tree in pairs)
        keys = [sorted((held[i][2], held[j][2])) for i, j, _ in pairs]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[1] for k in keys], pa.binary()),
                pa.array([k[0] for k in keys], pa.binary()),
                pa.array([links[tree] > 1 for _, _, tree in pairs], pa.bool_()),
            ],
            ["_key", "leader", "more"],
        )


def links_left(
    signs: np.ndarray,
    own: list[np.ndarray],
    roots: list[bytes],
    blocks: list[int],
    at: int,
    least: float,
) -> list[tuple[int, int]]:
    """Links that connect texts of different roots as far as their similarity does. Pairs are judged
    exactly unless they are connected by then, agree in too few coordinates or share a band before
    number `at`. `own` are the sorted shingles. Of two blocks, only pairs across them are judged."""
    first = np.cumsum([0] + [len(x) for x in own])
    values = np.concatenate(own).astype(np.uint64)
    # Copies of a shingle count one by one: a cell is a shingle and the number of the copy.
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1]] = True
    begins = np.flatnonzero(new)
    copy = np.arange(len(values)) - np.repeat(begins, np.diff(np.append(begins, len(values))))
    cells, ids = np.unique((values << np.uint64(32)) | copy.astype(np.uint64), return_inverse=True)
    texts = np.split(ids.ravel(), first[1:-1])
    root = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1].ravel()
    sizes, mark, found = np.diff(first), np.zeros(len(cells), bool), []
    block = np.array(blocks)
    across = len(np.unique(block)) > 1
    for i in range(len(own) - 1):
        apart = root[i + 1 :] != root[i]
        if across:
            apart &= block[i + 1 :] != block[i]
        later = i + 1 + np.flatnonzero(apart)
        same = signs[later] == signs[i]
        bands = same[:, : at * ROWS].reshape(len(later), at, ROWS)
        later = later[(same.sum(1) >= _AGREE) & ~bands.all(2).any(1)]
        if not len(later):
            continue
        mark[texts[i]] = True
        both = np.array([np.count_nonzero(mark[texts[j]]) for j in later])
        mark[texts[i]] = False
        for j in later[both / (sizes[i] + sizes[later] - both) >= least].tolist():
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                found.append((i, j))
    return found


def _left_rows(least: float):
    def run(batches):
        columns = ("band", "task", "block", "_key", "root", "signature", "own")
        for held in _runs(batches, columns, 2):
            _, _, blocks, keys, roots, packed, own = zip(*held)
            if len(set(blocks)) == 1 and held[0][1]["x"] != held[0][1]["y"]:
                continue  # the other block is empty
            signs = _signs(packed)
            at = np.flatnonzero(bands_of(signs[:1])[0].view(np.int64) == held[0][0])[0]
            own = [np.frombuffer(x, np.uint32) for x in own]
            links = links_left(signs, own, roots, blocks, int(at), least)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[k[side]] for k in links], pa.binary()) for side in (0, 1)],
                ["_key", "leader"],
            )

    return run


def _judge(least: float):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "own", _BATCH_BYTES):
                pairs = zip(part.column("own").to_pylist(), part.column("other").to_pylist())
                alike = [
                    similarity(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)) >= least
                    for a, b in pairs
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("_key", "leader", "more")), pa.array(alike, pa.bool_())],
                    ["_key", "leader", "more", "alike"],
                )

    return run


def _judged(held: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """(_key, leader, more, alike) for the distinct pairs, by the shingles in `held`."""
    own = held.select("_key", "own")
    other = held.select(F.col("_key").alias("leader"), F.col("own").alias("other"))
    sides = pairs.join(own, "_key").join(other, "leader")
    return sides.select("_key", "leader", "more", "own", "other").mapInArrow(
        _judge(least), "_key binary, leader binary, more boolean, alike boolean"
    )


def similar_pairs(texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(_key, leader) of similar distinct texts, enough to connect each class. `texts` has `_key`
    and `_text`."""
    rows = texts.mapInArrow(_band_rows, "band bigint, _key binary")
    bands = stage(rows.distinct(), "bands")
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = stage(bands.join(sizes, "band"), "buckets")
    mates = shared.groupBy("_key").agg(F.sum("n").alias("mates"))
    # Texts move once, and only what is needed of those with mates is kept. All rows of a key hold
    # the same text; any one will do.
    held = (
        texts.join(mates.select("_key"), "_key", "left_semi")
        .mapInArrow(_held_rows, "_key binary, signature binary, own binary")
        .groupBy("_key")
        .agg(F.first("signature").alias("signature"), F.first("own").alias("own"))
    )
    held = stage(held, "held")
    known = shared.join(mates, "_key").join(held.select("_key", "signature"), "_key")
    last = F.floor((F.col("n") - 1) / MOST_MATES).cast("int")
    own = F.pmod(F.xxhash64("_key"), last + 1).cast("int")
    large = known.where(F.col("n") > MOST_MATES)
    central = large.groupBy("band").agg(F.max(F.struct("mates", "_key", "signature", "n")).alias("c"))
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("c.n") - 1) / MOST_MATES).cast("int")))
    members = known.select("band", own.alias("block"), "_key", "signature").unionByName(
        central.select("band", blocks.alias("block"), "c._key", "c.signature")
    )
    links = (
        members.repartition("band", "block")
        .sortWithinPartitions("band", "block", "_key")
        .mapInArrow(_forest_rows, "_key binary, leader binary, more boolean")
        .where(F.col("_key") != F.col("leader"))
        .groupBy("_key", "leader")
        .agg(F.max("more").alias("more"))
    )
    judged = stage(_judged(held, stage(links, "links"), least), "judged")
    roots = components(judged.where("alike"), "_key", "leader")
    left = _left(shared, held, judged, roots, least)
    return roots.select(F.col("node").alias("_key"), F.col("root").alias("leader")).unionByName(left)


def _left(shared: DataFrame, held: DataFrame, judged: DataFrame, roots: DataFrame, least: float):
    """(_key, leader) of the similar pairs of a bucket that `roots` do not connect yet, enough to
    connect them. A tree whose links all hold, or are connected otherwise, has no such pair."""
    root = roots.select(F.col("node").alias("_key"), "root")
    rooted = shared.select("band", "_key", "n").join(root, "_key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "_key"))
    at = rooted.select("band", "_key", "root")
    other = rooted.select("band", F.col("_key").alias("leader"), F.col("root").alias("other"))
    apart = judged.where("more and not alike").select("_key", "leader").join(at, "_key")
    apart = apart.join(other, ["band", "leader"]).where(F.col("root") != F.col("other"))
    # Blocks of large buckets have not met, whatever their links.
    large = shared.where(F.col("n") > MOST_MATES).select("band")
    rooted = rooted.join(apart.select("band").union(large).distinct(), "band").drop("n")
    members = _tasks(rooted.join(held.select("_key", F.length("own").alias("size")), "_key"))
    return (
        members.join(held, "_key")
        .repartition("band", "task")
        .sortWithinPartitions("band", "task", "_key")
        .mapInArrow(_left_rows(least), "_key binary, leader binary")
    )


def _tasks(rooted: DataFrame) -> DataFrame:
    """A row (band, task, block, _key, root) for each task that a text takes part in. `task` is two
    blocks of the bucket, each pair of blocks one task; `rooted` has the bytes of a text as `size`.

    The texts of the bucket's most frequent root need not meet each other: they have blocks of their
    own (the first ones), which meet only the blocks of the others. Buckets of one root drop out."""
    by_root = rooted.groupBy("band", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    )
    blocks = lambda n, size: F.ceil(F.greatest(n / MOST_MATES, size / BLOCK_BYTES)).cast("int")
    per = by_root.groupBy("band").agg(
        F.max(F.struct("n", "root", "bytes")).alias("top"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
    )
    per = per.where(F.col("n") > F.col("top.n")).select(
        "band",
        F.col("top.root").alias("most"),
        (blocks(F.col("n"), F.col("bytes")) == 1).alias("whole"),
        blocks(F.col("top.n"), F.col("top.bytes")).alias("a"),
        blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("b"),
    )
    hashed = F.xxhash64("_key")
    first = F.col("root") == F.col("most")
    block = (
        F.when(F.col("whole"), F.lit(0))
        .when(first, F.pmod(hashed, "a"))
        .otherwise(F.col("a") + F.pmod(hashed, "b"))
        .cast("int")
    )
    last = F.col("a") + F.col("b") - 1
    mates = (
        F.when(F.col("whole"), F.array(F.lit(0)))
        .when(first, F.sequence("a", last))
        .otherwise(F.sequence(F.lit(0), last))
    )
    met = rooted.join(per, "band").withColumn("block", block).withColumn("mate", F.explode(mates))
    task = F.struct(F.least("block", "mate").alias("x"), F.greatest("block", "mate").alias("y"))
    return met.select("band", task.alias("task"), "block", "_key", "root")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of each node's component, for all nodes with an edge.

    Alternates two rounds that hang a node's neighbours on the smallest of them, larger ones
    first, then smaller ones, until every component is a star. Neighbours are reduced to their
    smallest by partial aggregation; no neighbourhood is collected.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select("v", "m")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select("v", "m")
        now = stage(
            small.union(least.select(F.col("u").alias("v"), "m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "edges",
        )
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def text_classes(texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(_key, root) of the texts that have a near-duplicate: the smallest key of their class.
    `texts` has `_key`, a digest, and `_text`, in any number of copies."""
    if not least >= SIMILARITY:
        raise ValueError(f"least must be {SIMILARITY} or more, not {least}")
    roots = components(similar_pairs(texts, least), "_key", "leader")
    return roots.select(F.col("node").alias("_key"), "root")


def near_duplicate_classes(
    df: DataFrame, text: str = "text", least: float = SIMILARITY, result: str = "class_key"
) -> DataFrame:
    """Adds `text_key` (digest of the text) and `result`: the smallest text key of the row's
    class. Columns of these names are replaced, all others pass through. Bands and coordinates are
    laid out for `SIMILARITY`; a `least` below it would lose pairs and is an error."""
    keyed = df.drop("text_key", result).withColumn("text_key", F.unhex(F.md5(whole(F.col(text)))))
    roots = text_classes(keyed.select(F.col("text_key").alias("_key"), whole(F.col(text)).alias("_text")), least)
    root = "root"
    while root in keyed.columns:
        root += "_"
    joined = keyed.join(roots.select(F.col("_key").alias("text_key"), F.col("root").alias(root)), "text_key", "left")
    own = [c for c in keyed.columns if c != "text_key"]
    return joined.select(*own, "text_key", F.coalesce(root, "text_key").alias(result))


def one_per_class(df: DataFrame, row_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class: that of the smallest id (nulls last), then text key, then digest of
    the other columns. Of rows that are equal in all columns, one stays.

    Classes are settled on keys alone. Rows move once, by their digest, after equal ones have
    become one in each task, so that a row with many copies is no hot spot.
    """
    text_key = F.unhex(F.md5(whole(F.col(text))))
    others = [F.col(c) for c in df.columns if c != text]
    rest = F.unhex(F.md5(F.to_json(F.struct(F.col(text).isNull(), *others))))
    digest = F.concat(text_key, rest).alias("digest")
    # All of a row's own columns are in one, so that helper columns meet no other.
    rows = df.select(F.struct(*df.columns).alias("row"), digest)
    order = F.struct(F.col(row_id).isNull().alias("none"), F.col(row_id).alias("id"), digest)
    keys = df.select(text_key.alias("text_key"), F.col(text).alias("text"), order.alias("order"))
    first = stage(keys.groupBy("text_key").agg(F.min("order").alias("order")), "firsts")
    roots = text_classes(keys.select(F.col("text_key").alias("_key"), whole(F.col("text")).alias("_text")), **options)
    roots = roots.select(F.col("_key").alias("text_key"), "root")
    best = first.join(roots, "text_key", "left").groupBy(F.coalesce("root", "text_key").alias("class"))
    kept = stage(best.agg(F.min("order").alias("order")).select("order.digest"), "kept")
    distinct = rows.groupBy("digest").agg(F.first("row").alias("row"))
    return distinct.join(kept, "digest", "left_semi").select("row.*")
