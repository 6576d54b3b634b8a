"""Prefix trie of conversations, with subtree totals by centroid decomposition.

A conversation is a path of turns; a node is a distinct sequence of first turns, the root the empty
one. Texts are read once, for a 128-bit digest of role and text; from then on a conversation is the
digests of its turns back to back, 16 bytes a turn, which a task must be able to hold. Equal
conversations are brought together in blocks of ids first, so that a conversation that a third of
all rows repeat is no hot spot; the digest over the ids that end at a node reads the blocks in
order and keeps none of them.

Distinct conversations are sorted by their bytes, over a range partitioning, so that a subtree is
a stretch of them and no prefix, however common, gathers in one task: a stretch of a partition with
some `BLOCK_NODES` nodes is a block, and a task builds its trie. Only nodes on the first and last path
of a block can have members outside it. All others are totalled in the block, as a forest of the
parent edges: its trees are split at their centroids again and again, all at once; each time the
centroid's total within its component is added along the path from the centroid to the
component's top, so every node meets every descendant once, in as many rounds as the
number of nodes has bits. Nodes on the border of blocks come together by key, a few per block,
and are totalled alike: first those within one block, then those within `_WIDTH` blocks and so on,
each component handing the totals of its tops to the nodes above.

Turns are ordered by `turn`, nulls first, equal numbers by the digest of role and text. A null
role or text is empty. Rows without `conv_id` belong to no conversation and are left out. Repeated
rows are turns of their own. An empty table has no conversation, so not even a root. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.staging import stage

DIGEST_BYTES = 16
BLOCK_NODES = 1 << 16
_ID_BITS = 12  # conversations of 4,096 neighbouring ids form a block of equal ones
_BLOCK_BITS = 20  # blocks of a partition at most
_WIDTH_BITS = 10  # components of border nodes take 1,024 times as many blocks, level by level
_BROADCAST_ROWS = 200_000


# Conversations as paths


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, digest, size`: what the trie needs of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.unhex(F.md5(content)).alias("digest"), F.octet_length(text).alias("size")
    )


def _ordered() -> Column:
    return F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))


def _path(conv_id: Column, turns: Column) -> list[Column]:
    digests = F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), "")
    return [
        conv_id.alias("conv_id"),
        F.unhex(digests).alias("path"),
        F.transform(turns, lambda t: t["size"]).alias("sizes"),
    ]


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """`conv_id, path, sizes`: digests of the turns back to back, and the bytes of their texts."""
    turns = conversation_turns(conversations).groupBy("conv_id").agg(_ordered().alias("turns"))
    return turns.select(*_path(F.col("conv_id"), F.col("turns")))


def rebuilt_paths(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """The same with planted common beginnings: the first h turns come from the conversation with
    the next lower id that `family` divides, the others from the conversation itself; h is the
    crc32 of the id modulo `most`. The conversations of a family meet in one exchange."""
    turns = conversation_turns(conversations)
    base = F.col("conv_id") - F.col("conv_id") % family
    whole = turns.withColumn("base", base).repartition("base").groupBy("base", "conv_id").agg(_ordered().alias("turns"))
    members = whole.groupBy("base").agg(F.collect_list(F.struct("conv_id", "turns")).alias("members"))
    first = F.get(F.filter("members", lambda m: m["conv_id"] == F.col("base")), F.lit(0))["turns"]
    nothing = F.slice(F.col("member.turns"), 1, 0)
    each = members.select(first.alias("first"), F.explode("members").alias("member"))
    own, h = F.col("member.turns"), F.crc32(F.col("member.conv_id").cast("string")).cast("bigint") % most
    h = h.cast("int")
    head = F.slice(F.coalesce("first", nothing), F.lit(1), h)
    tail = F.slice(own, h + 1, F.size(own))
    each = each.select(F.col("member.conv_id").alias("conv_id"), F.concat(head, tail).alias("turns"))
    return each.select(*_path(F.col("conv_id"), F.col("turns")))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per path out of its rows, which follow each other by block of ids."""
    now, digest = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is None or row["path"] != now["path"]:
                if now is not None:
                    done.append({**now, "ends": digest.hexdigest()})
                now, digest = row, hashlib.sha256(row["ids"].encode())
            else:
                digest.update(b"," + row["ids"].encode())
                now["n"] += row["n"]  # blocks come in order, so the first has the smallest id
        yield _distinct_rows(done)
    if now is not None:
        yield _distinct_rows([{**now, "ends": digest.hexdigest()}])


def _distinct_rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{k: r[k] for k in _DISTINCT.names} for r in rows], _DISTINCT)


_DISTINCT = pa.schema(
    [
        ("path", pa.binary()),
        ("sizes", pa.list_(pa.int32())),
        ("conv_id", pa.int64()),
        ("n", pa.int64()),
        ("ends", pa.string()),
    ]
)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """`path, sizes, conv_id, n, ends`: each path once, with the smallest id, the count and the
    SHA-256 of the ids, in ascending order and comma-joined."""
    block = F.shiftright(F.col("conv_id").cast("bigint"), _ID_BITS).alias("block")
    ids = F.sort_array(F.collect_list(F.col("conv_id").cast("bigint")))
    parts = paths.groupBy(F.md5("path").alias("key"), block).agg(
        F.first("path").alias("path"), F.first("sizes").alias("sizes"), ids.alias("ids")
    )
    rows = parts.select(
        "key",
        "block",
        "path",
        "sizes",
        F.get("ids", F.lit(0)).alias("conv_id"),
        F.size("ids").cast("bigint").alias("n"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
    )
    placed = rows.repartition("key").sortWithinPartitions("key", "block")
    columns = "path binary, sizes array<int>, conv_id bigint, n bigint, ends string"
    return placed.drop("key", "block").mapInArrow(_merged, columns)


# Totals over subtrees


def subtree_totals(parent: np.ndarray, end: np.ndarray, values: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Sum of each value over every node's subtree, by centroid decomposition of the forest.

    Nodes are in preorder; `parent` is -1 for tops, `end` the place after a node's subtree. All
    components are split in the same round, at the deepest node that holds more than half of its
    component: the parts above and below it hold at most half each.
    """
    place = np.arange(len(parent))
    size = end - place  # nodes of the component under each node, itself included
    component = np.maximum.accumulate(np.where(parent < 0, place, 0)) if len(parent) else place
    totals = [np.zeros(len(parent), np.int64) for _ in values]
    centre = np.zeros(len(parent), np.int64)
    live = place  # by component, named by its top, and place
    while len(live):
        top = component[live]
        heavy = 2 * size[live] > size[top]
        centre[top[heavy]] = live[heavy]  # of those of a component, the last one stands
        middle = centre[top]
        below = (live >= middle) & (live < end[middle])
        above = (live <= middle) & (middle < end[live])  # the path from the centroid to the top
        begins = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
        number = np.cumsum(np.concatenate([[False], top[1:] != top[:-1]]))
        for total, value in zip(totals, values):
            held = np.add.reduceat(np.where(below, value[live], 0), begins)
            total[live[above]] += held[number[above]]
        cut = live == middle
        size[live[above & ~cut]] -= size[middle[above & ~cut]]
        new = below & (parent[live] == middle)
        latest = np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))
        lower = below & ~cut
        component[live[lower]] = live[latest[lower]]
        live = live[~cut]
        live = live[np.argsort(component[live], kind="stable")]
    return totals


class _Block:
    """Trie of a stretch of sorted distinct paths; nodes in preorder."""

    def __init__(self):
        self.depth, self.parent, self.size, self.end = [], [], [], []
        self.n, self.conv, self.ends = [], [], []
        self.open: list[int] = []  # the nodes of the last path
        self.path = None
        self.first = b""

    def add(self, path: bytes, sizes: list[int], conv: int, n: int, ends: str):
        depth, shared = len(path) // DIGEST_BYTES, 0
        if self.path is None:
            self.first = path
            self._node(0, 0)
        else:
            most = min(depth, len(self.path) // DIGEST_BYTES)
            while shared < most and _turn(path, shared) == _turn(self.path, shared):
                shared += 1
            self._close(shared + 1)
        for d in range(shared, depth):
            self._node(d + 1, sizes[d])
        last = self.open[-1]
        self.n[last], self.conv[last], self.ends[last] = n, conv, ends
        self.path = path

    def _node(self, depth: int, size: int):
        self.parent.append(self.open[-1] if self.open else -1)
        self.open.append(len(self.depth))
        self.depth.append(depth)
        self.size.append(size)
        self.end.append(0)
        self.n.append(0)
        self.conv.append(None)
        self.ends.append(None)

    def _close(self, kept: int):
        for node in self.open[kept:]:
            self.end[node] = len(self.depth)
        del self.open[kept:]

    def finish(self, block: int) -> pa.RecordBatch:
        """Rows of all nodes: final ones, and border nodes with what the block knows of them."""
        last_path = list(self.open)
        self._close(0)
        depth, parent, end = (np.array(x, np.int64) for x in (self.depth, self.parent, self.end))
        count, size = np.array(self.n, np.int64), np.array(self.size, np.int64)
        sums = np.concatenate([[0], np.cumsum(count)])
        members = sums[end] - sums[:-1]
        smallest = np.array([np.iinfo(np.int64).max if c is None else c for c in self.conv], np.int64)
        by_depth = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[by_depth], np.arange(int(depth.max()) + 2))
        for d in range(int(depth.max()), 0, -1):
            nodes = by_depth[edges[d] : edges[d + 1]]
            np.minimum.at(smallest, parent[nodes], smallest[nodes])
        children = np.bincount(parent[1:], minlength=len(depth)) if len(depth) > 1 else np.zeros(1, np.int64)

        border = np.zeros(len(depth), bool)
        border[: len(self.first) // DIGEST_BYTES + 1] = True
        border[last_path] = True
        inner = np.flatnonzero(~border)
        renumbered = np.concatenate([[0], np.cumsum(~border)])
        above = parent[inner]
        tops = border[above]
        leaf = (children == 0).astype(np.int64)
        saved = (members - 1) * size
        leaves, savings = np.zeros((2, len(depth)), np.int64)
        leaves[inner], savings[inner] = subtree_totals(
            np.where(tops, -1, renumbered[above]), renumbered[end[inner]], [leaf[inner], saved[inner]]
        )
        # Border nodes get the totals of the trees that hang on them; their own part comes later.
        hung = np.zeros(len(depth), np.int64)
        for total, part in ((hung, np.ones(len(depth), np.int64)), (leaves, leaves), (savings, savings)):
            np.add.at(total, above[tops], part[inner[tops]])
        keys = np.full(len(depth), None, object)
        for path, nodes in ((self.first, range(len(self.first) // DIGEST_BYTES + 1)), (self.path, last_path)):
            digest = hashlib.md5()
            for d, node in enumerate(nodes):
                if d:
                    digest.update(_turn(path, d - 1))
                keys[node] = digest.copy().digest()
        upper = np.where(parent < 0, None, keys[parent])
        known = ~border & (parent >= 0) & ~border[parent]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(border),
                pa.array(keys, pa.binary()),
                pa.array(upper, pa.binary()),
                pa.array(depth),
                pa.array(smallest),
                pa.array(np.where(known, smallest[parent], 0), mask=~known),
                pa.array(members),
                pa.array(np.where(border, hung, children)),
                pa.array(leaves),
                pa.array(savings),
                pa.array(self.ends, pa.string()),
                pa.array(np.full(len(depth), block)),
                pa.array(size),
            ],
            [name.split()[0] for name in _NODE.split(", ")],
        )


def _turn(path: bytes, i: int) -> bytes:
    return path[DIGEST_BYTES * i : DIGEST_BYTES * (i + 1)]


_NODE = (
    "border boolean, key binary, upper binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, "
    "block bigint, size bigint"
)


def _block_rows(block_nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << _BLOCK_BITS
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in _DISTINCT.names)):
                if len(block.depth) >= block_nodes:
                    yield block.finish(number)
                    block, number = _Block(), number + 1
                block.add(*row)
        if block.depth:
            yield block.finish(number)

    return run


def _component_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Border nodes of a level, component by component, with their totals."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["component"] != row["component"]:
                yield _component(held)
                held = []
            held.append(row)
    if held:
        yield _component(held)


def _component(rows: list[dict]) -> pa.RecordBatch:
    at = {row["key"]: i for i, row in enumerate(rows)}
    below: list[list[int]] = [[] for _ in rows]
    tops = []
    for i, row in enumerate(rows):
        (below[at[row["upper"]]] if row["upper"] in at else tops).append(i)
    order, parent, end, stack = [], [], np.zeros(len(rows), np.int64), [(i, -1) for i in tops]
    while stack:  # preorder
        i, above = stack.pop()
        if i < 0:
            end[above] = len(order)
            continue
        place = len(order)
        order.append(i)
        parent.append(above)
        stack.append((-1, place))
        stack += [(j, place) for j in below[i]]
    parent = np.array(parent, np.int64)
    for i in order:
        rows[i]["n_children"] += len(below[i])
    leaves = [rows[i]["n_leaves"] + (rows[i]["n_children"] == 0) for i in order]
    saved = [rows[i]["saved_tokens"] + (rows[i]["n_convs"] - 1) * rows[i]["size"] for i in order]
    leaves, saved = subtree_totals(parent, end, [np.array(leaves, np.int64), np.array(saved, np.int64)])
    made = [
        {**rows[i], "n_leaves": int(a), "saved_tokens": int(s), "top": bool(p < 0)}
        for i, a, s, p in zip(order, leaves, saved, parent)
    ]
    # Types are given: where no conversation ends at a node of a component, they can't be told from its rows.
    return pa.RecordBatch.from_pylist(made, _TOTALLED_TYPES)


_TOTALLED = (
    "key binary, upper binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string, top boolean"
)
_ARROW = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
_TOTALLED_TYPES = pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in _TOTALLED.split(", "))])


def _border_totals(partials: DataFrame) -> DataFrame | None:
    """Border nodes brought together and totalled, level by level of the blocks they span."""
    spark = partials.sparkSession
    nodes = partials.groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("upper", "depth", "size", "ends")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("block").alias("low"),
        F.max("block").alias("high"),
    )
    shifts = range(0, 63, _WIDTH_BITS)
    level = F.coalesce(
        *[F.when(F.shiftright("low", s) == F.shiftright("high", s), F.lit(k)) for k, s in enumerate(shifts)]
    )
    nodes = stage(nodes.withColumn("level", level), "border")
    totalled = None
    for (k,) in sorted(nodes.select("level").distinct().collect()):
        now = nodes.where(F.col("level") == k).withColumn("component", F.shiftright("low", shifts[k]))
        if totalled is not None:
            handed = totalled.where("top").groupBy(F.col("upper").alias("key")).agg(
                F.count(F.lit(1)).alias("more_children"),
                F.sum("n_leaves").alias("more_leaves"),
                F.sum("saved_tokens").alias("more_saved"),
            )

            def more(own: str, further: str) -> Column:
                return F.col(own) + F.coalesce(F.col(further), F.lit(0))

            now = now.join(handed, "key", "left").withColumns(
                {
                    "n_children": more("n_children", "more_children"),
                    "n_leaves": more("n_leaves", "more_leaves"),
                    "saved_tokens": more("saved_tokens", "more_saved"),
                }
            )
        wanted = ["component", "key", "upper", "depth", "conv_id", "n_convs", "n_children", "n_leaves"]
        now = now.select(*wanted, "saved_tokens", "ends", "size")
        placed = now.repartition("component").sortWithinPartitions("component")
        done = stage(placed.mapInArrow(_component_rows, _TOTALLED), "totals")
        totalled = done if totalled is None else totalled.unionByName(done)
    return spark.createDataFrame([], _TOTALLED) if totalled is None else totalled


def prefix_trie(paths: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """One row per node: `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens` and `ends_sha256`, for `conv_id, path, sizes` rows."""
    distinct = stage(distinct_paths(paths), "paths")
    ordered = distinct.repartitionByRange("path").sortWithinPartitions("path")
    nodes = stage(ordered.mapInArrow(_block_rows(block_nodes), _NODE), "nodes")
    border = _border_totals(nodes.where("border"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    inner = nodes.where("not border")
    # A block adds its two paths to the border; what hangs on them looks up their smallest member.
    upper = border.select(F.col("key").alias("upper"), F.col("conv_id").alias("above"))
    if border.count() <= _BROADCAST_ROWS:
        upper = F.broadcast(upper)
    hanging = inner.where("upper is not null").select(*columns, "upper")
    hanging = hanging.unionByName(border.select(*columns, "upper"))
    hanging = hanging.join(upper, "upper", "left").select(*columns, F.col("above").alias("parent_conv_id"))
    rows = inner.where("upper is null").select(*columns, "parent_conv_id").unionByName(hanging)
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
