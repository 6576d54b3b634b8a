from math import gcd

import pytest
from pyspark.sql import functions as F

from corploom.operators import lengths


def ranked(spark, values, partitions=3):
    df = spark.createDataFrame([(str(i), i, n) for i, n in enumerate(values)], "k string, pos bigint, len bigint")
    return lengths.rank_by_length(df.repartition(partitions))


def brute_groups(values, budget, min_rows):
    order = sorted(values, reverse=True)
    groups, cum = [], 0
    for rn, n in enumerate(order):
        groups.append(min(cum // budget, rn // min_rows))
        cum += n
    last = groups[-1]
    if groups.count(last) < min_rows and last > 0:
        groups = [min(g, last - 1) for g in groups]
    return order, groups


def brute_choice(values, min_rows):
    total, divisor = sum(values), 0
    for n in values:
        divisor = gcd(divisor, n)
    best = None
    for budget in range(max(divisor, min_rows), total // 2 + 1):
        if total % budget:
            continue
        order, groups = brute_groups(values, budget, min_rows)
        sums = [sum(n for n, g in zip(order, groups) if g == i) for i in set(groups)]
        score = (len(sums) == 1, max(sums) - min(sums), budget)
        best = min(best, score) if best else score
    return best


def test_no_row_is_lost(spark):
    rows = ranked(spark, [6, 4, 4, 2])
    stats = lengths.length_stats(rows).first()
    assert stats.asDict() == {"n_rows": 4, "total": 16, "gcd": 2}
    spread = {r.budget: r.spread for r in lengths.group_spread(lengths.candidate_groups(rows, [2, 4, 8], 1)).collect()}
    assert spread == {2: 4, 4: 4, 8: 4}
    plan = lengths.choose_groups(rows, 1)
    assert plan.budget == 2
    groups = lengths.assign_groups(rows, plan).orderBy("rn").collect()
    assert [(r.len, r.group_id) for r in groups] == [(6, 0), (4, 1), (4, 2), (2, 3)]
    eight = lengths.assign_groups(rows, lengths.GroupPlan(8, 2, 2, 1)).orderBy("rn").collect()
    assert [r.group_id for r in eight] == [0, 0, 1, 1]


@pytest.mark.parametrize("seed, min_rows", [(1, 1), (2, 3), (3, 5), (4, 8), (5, 40)])
def test_choice_against_all_budgets(spark, seed, min_rows):
    import random

    rng = random.Random(seed)
    values = [rng.choice([12, 12, 12, 24, 36, rng.randint(1, 40) * 6]) for _ in range(60)]
    rows = ranked(spark, values)
    plan = lengths.choose_groups(rows, min_rows)
    expected = brute_choice(values, min_rows)
    assert plan.budget == expected[2]
    order, groups = brute_groups(values, plan.budget, min_rows)
    found = lengths.assign_groups(rows, plan).orderBy("rn").collect()
    assert [r.len for r in found] == order
    assert [r.group_id for r in found] == groups
    assert plan.smallest == min(groups.count(g) for g in set(groups))


def test_ties_of_length_keep_their_order_for_any_partitioning(spark):
    values = [5, 9, 5, 5, 9, 1] * 20
    orders = []
    for partitions in (1, 4, 8):
        found = ranked(spark, values, partitions).orderBy("rn").collect()
        orders.append([int(r.k) for r in found])
    assert orders[0] == sorted(range(len(values)), key=lambda i: -values[i])
    assert orders[0] == orders[1] == orders[2]


def test_divisors():
    for n in (1, 2, 16, 97, 360, 9_973 * 7, 2**20):
        assert lengths._divisors(n) == [d for d in range(1, n + 1) if n % d == 0]


def test_one_group_if_no_budget_fits(spark):
    rows = ranked(spark, [7])
    assert lengths.choose_groups(rows, 1) == lengths.GroupPlan(None, 1, 1, 1)
    assert [r.group_id for r in lengths.assign_groups(rows, lengths.choose_groups(rows, 1)).collect()] == [0]


def test_subchunks_and_two_level_shuffle_keep_all_rows(spark):
    values = [(i * 37) % 50 + 1 for i in range(200)]
    df = spark.createDataFrame([(str(i), i, n) for i, n in enumerate(values)], "k string, pos bigint, len bigint")
    placed = lengths.length_places(df, ["k"], min_rows=20, min_subchunk=8).orderBy("pos").collect()
    assert [r.pos for r in placed] == list(range(200))
    assert sorted(int(r.k) for r in placed) == list(range(200))
    runs = [(r.group_id, r.sub_id) for r in placed]
    changes = sum(a != b for a, b in zip(runs, runs[1:]))
    assert changes == len(set(runs)) - 1  # rows of a subchunk stay together
    sizes = {run: runs.count(run) for run in runs}
    target = max(min(sum(n for (g, _), n in sizes.items() if g == group) for group in {g for g, _ in runs}), 8)
    last = {g: max(s for h, s in sizes if h == g) for g, _ in sizes}
    assert all(n == target for (g, s), n in sizes.items() if s != last[g])


def test_gcd_over_many_partitions(spark):
    df = spark.range(1, 2000).select((F.col("id") * 6).alias("len")).repartition(9)
    assert lengths.length_gcd(df).first()["gcd"] == 6


def row_wise_groups(ranked, budgets, min_rows):
    """The groups by trying every budget on every row."""
    out = {}
    for budget in budgets:
        groups = {}
        for rn, cum, size in ranked:
            g = min(cum // budget, rn // min_rows)
            n, total = groups.get(g, (0, 0))
            groups[g] = (n + 1, total + size)
        last = max(groups)
        if groups[last][0] < min_rows and last > 0:
            n, total = groups.pop(last)
            old = groups.get(last - 1, (0, 0))
            groups[last - 1] = (old[0] + n, old[1] + total)
        out[budget] = groups
    return out


def test_groups_from_runs_of_equal_length(spark):
    import random

    from corploom.operators.lengths import candidate_groups

    rnd = random.Random(3)
    for least in (0, 1):
        sizes = sorted((rnd.choice([least, 3, 7, 7, 50]) for _ in range(120)), reverse=True)
        ranked = [(i, sum(sizes[:i]), s) for i, s in enumerate(sizes)]
        df = spark.createDataFrame(ranked, "rn bigint, cum bigint, len bigint")
        budgets = list(range(4, 700, 3))
        for min_rows in (1, 5):
            found = {}
            groups = candidate_groups(df, budgets, min_rows)
            for r in groups.collect():
                found.setdefault(r.budget, {})[r.group_id] = (r.n_rows, r.total)
            assert found == row_wise_groups(ranked, budgets, min_rows)


def test_thousands_of_budgets_touch_no_rows(spark):
    from corploom.operators.lengths import candidate_groups

    df = spark.range(1000).selectExpr("id as rn", "id * 10 as cum", "10L as len")
    groups = candidate_groups(df, list(range(100, 10_100)), 10)
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    # Every explode stands above the aggregation of rows to runs.
    lines = plan.splitlines()
    runs = max(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert all(i < runs for i, line in enumerate(lines) if "explode" in line)
    assert groups.groupBy("budget").count().count() == 10_000
