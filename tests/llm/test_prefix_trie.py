"""Prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corploom.llm.prefix_trie import conversation_paths, prefix_trie, rebuilt_paths, subtree_totals

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def conversations_of(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            order = (turn is not None, turn or 0, digest(role, text))
            turns[conv_id].append((order, (role or "", text or "")))
    return {c: [t for _, t in sorted(x)] for c, x in turns.items()}


def rebuilt(own):
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(np.fix(c / 5)) * 5
        found[c] = own.get(base, [])[:h] + turns[h:]
    return found


def nodes_of(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for node, ids in members.items():
        inside = [u for u in members if u[: len(node)] == node]
        children = [u for u in inside if len(u) == len(node) + 1]
        leaves = [u for u in inside if not any(len(v) == len(u) + 1 and v[: len(u)] == u for v in inside)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in inside if u)
        ends = ",".join(str(c) for c in sorted(ids) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        ends = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(ids), len(node), parent, len(ids), len(children), len(leaves), saved, ends))
    return sorted(rows, key=repr)


def found_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(30))
def test_totals(seed):
    random.seed(seed)
    n = random.choice([0, 1, 2, 10, 200])
    above = [-1 if random.random() < 0.1 or i == 0 else random.randint(max(0, i - 4 - seed), i - 1) for i in range(n)]
    below = defaultdict(list)
    for i, p in enumerate(above):
        below[p].append(i)
    parent, end, values, expected = [], [], [], []

    def walk(i, p):
        place = len(parent)
        parent.append(p)
        end.append(0)
        values.append(random.randint(0, 10**15))
        expected.append(values[place])
        for j in below[i]:
            expected[place] += walk(j, place)
        end[place] = len(parent)
        return expected[place]

    for top in below[-1]:
        walk(top, -1)
    found = subtree_totals(np.array(parent, np.int64), np.array(end, np.int64), [np.array(values, np.int64)])
    assert found[0].tolist() == expected


def test_totals_of_a_long_chain():
    n = 100_000
    ones = np.ones(n, np.int64)
    assert (subtree_totals(np.arange(n) - 1, np.full(n, n), [ones])[0] == np.arange(n, 0, -1)).all()


def planted():
    """Many common beginnings, equal conversations, nulls, ties, a long conversation."""
    random.seed(5)
    rows = []
    for c in [*range(-7, 90), 4096, 4101, 8200, 12288]:
        for turn in range(random.choice([1, 2, 4, 9])):
            text = random.choice(["a", "b", "", None, "é" * 5])
            rows.append((c, None if turn == 0 else turn, random.choice(["user", None]), text))
    rows += [(c, t, "user", f"turn {t}") for c in (200, 205, 210, 9000) for t in range(60)]
    rows += [(300, 1, "user", "tie"), (300, 1, "assistant", "tie"), (300, 1, "user", "tie"), (301, 2, "", "")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("block_nodes, partitions", [(1 << 16, 1), (5, 4), (40, 7)])
def test_trie(spark, block_nodes, partitions):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(0) for c in ("path", "key", "base")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        own = conversations_of(rows)
        assert found_rows(prefix_trie(conversation_paths(df), block_nodes)) == nodes_of(own)
        assert found_rows(prefix_trie(rebuilt_paths(df), block_nodes)) == nodes_of(rebuilt(own))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_turnless_and_empty(spark):
    rows = [(6, 0, "user", "x")]  # h of 6 is 2 and there is no conversation 5
    found = found_rows(prefix_trie(rebuilt_paths(spark.createDataFrame(rows, SCHEMA))))
    assert found == nodes_of(rebuilt(conversations_of(rows)))
    assert len(found) == 1 and found[0][1] == 0
    assert prefix_trie(rebuilt_paths(spark.createDataFrame([], SCHEMA))).count() == 0


def test_equal_conversations_meet_in_blocks(spark):
    """As many copies as make several blocks of ids."""
    df = spark.range(20_000).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'hello' as text")
    found = prefix_trie(conversation_paths(df)).where("depth = 1").first()
    ends = ",".join(map(str, range(20_000)))
    assert found.n_convs == 20_000 and found.saved_tokens == 5 * 19_999
    assert found.ends_sha256 == hashlib.sha256(ends.encode()).hexdigest()


def test_border_without_ends(spark):
    """Several blocks in each of several partitions: in some components of border nodes no conversation
    ends, in others some do, and a task has both."""
    rows = [(100 * a + b, t, "user", f"{a} {b * t}") for a in range(10) for b in range(8) for t in range(2)]
    rows += [(10_000 + a, 0, "user", f"{a} 0") for a in range(0, 10, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        assert found_rows(prefix_trie(conversation_paths(df), 5)) == nodes_of(conversations_of(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
