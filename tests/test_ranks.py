"""Places, running sums, ranks, posting blocks and impact over hot keys, against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnflow.operators import aggregates as A
from cairnflow.operators import graph as G
from cairnflow.operators import joins as J
from cairnflow.operators import ordered as O
from cairnflow.operators import pairs as P
from cairnflow.operators import ranks as R
from cairnflow.plans.registry import QUERIES


@pytest.fixture(scope="module")
def hot(spark):
    """One key with nine tenths of the rows, a null key, ties, null amounts."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 18 + ["a", None]), rng.randint(0, 40), i, rng.choice([None, 0.0, 1.0, 2.0, 5.0])) for i in range(1200)]
    return rows, spark.createDataFrame(rows, "k string, v int, i long, w double").repartition(5)


@pytest.fixture
def small_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbered(spark, hot):
    rows, df = hot
    got = {r.i: r.place for r in R.numbered(df, [F.desc("v"), "i"]).collect()}
    assert got == {r[2]: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))}
    assert R.numbered(df.limit(0), ["i"]).count() == 0


def test_running_sums_of_a_hot_key(spark, hot, small_partitions):
    rows, df = hot
    sums, want = defaultdict(float), {}
    for k, v, i, w in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[k] += w or 0
        want[i] = sums[k]
    got = R.running(df, ["k"], ["v", "i"], F.col("w"))
    assert {r.i: r.upto for r in got.collect()} == want and got.columns == ["k", "v", "i", "w", "upto"]
    assert {r.i for r in R.running(df, ["k"], ["v", "i"], F.col("w"), most=30).collect()} == {i for i, s in want.items() if s <= 30}
    whole = R.running(df, [], ["i"], F.lit(1))
    assert {r.i: r.upto for r in whole.collect()} == {i: i + 1 for i in range(1200)}


def test_a_budget_over_one_key_runs_in_many_tasks(spark, small_partitions):
    df = spark.range(40_000).select("id", F.lit("one").alias("k"))
    laid = R._ranged(df.withColumn("__key", F.struct("k")), ["__key", "id"], "laid")
    sizes = [r["count"] for r in laid.groupBy("__part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 20_000  # one key, and no range has half of it
    kept = O.within_budget(df, ["k"], [F.col("id")], F.lit(2), 1000, F.col("id") % 10_000 == 9_999)
    safe = {9_999, 19_999, 29_999, 39_999}
    assert {r.id for r in kept.collect()} == set(range(500 - 4)) | safe
    assert {r.id: r.chunk for r in O.chunks(df, ["k"], ["id"], 7).collect()} == {i: i // 7 for i in range(40_000)}


def test_nearest_ranks_of_a_hot_and_a_null_key(spark, hot, small_partitions):
    rows, df = hot
    groups = defaultdict(list)
    for k, v, _, _ in rows:
        groups[k].append(v)
    got = {r.k: (r.p1, r.p50, r.p95, r.p100) for r in R.nearest_ranks(df, "v", (1, 50, 95, 100), ["k"]).collect()}
    assert got == {k: tuple(sorted(v)[math.ceil(p * len(v) / 100) - 1] for p in (1, 50, 95, 100)) for k, v in groups.items()}
    assert R.nearest_ranks(df.limit(0), "v", (50,)).count() == 0
    report = {r.k: r for r in A.stats_report(df.withColumn("v", F.col("v") - 3.0), "v", ["k"], pooled=True).filter("k = 'a' OR k IS NULL").collect()}
    good = sorted(v - 3 for v in groups["a"] if v >= 3)
    assert (report["a"].n, report["a"].p95, report["a"].errors) == (len(good), good[math.ceil(0.95 * len(good)) - 1], len(groups["a"]) - len(good))
    plan = A.stats_report(df.withColumn("v", F.col("v") - 3.0), "v")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan or "hashpartitioning(__key" in plan


def test_deep_pages_equal_shallow_ones(spark, hot, small_partitions):
    rows, df = hot
    order = [F.desc("v"), F.col("i")]
    for number in (1, 7, 12, 13):
        deep, facts = O.page(df, order, number, 100, heap=0)
        shallow, same = O.page(df, order, number, 100)
        assert facts == same and sorted(map(str, deep.collect())) == sorted(map(str, shallow.collect()))
    pages = O.pages(df, order, 100).filter("page = 12").collect()
    assert sorted(r.i for r in pages) == sorted(r.i for r in O.page(df, order, 12, 100)[0].collect()) and sorted(r.place for r in pages) == list(range(1, 101))


def test_posting_blocks(spark, small_partitions):
    edges = [("hot", i) for i in range(500)] * 2 + [("b", 3), ("b", 7), (None, 1), ("c", None)]
    df = spark.createDataFrame(edges, "item string, key long")
    blocks = J.posting_blocks(df, "item", "key", 64).collect()
    assert max(r.n for r in blocks) == 64 and sum(r.n for r in blocks) == 502
    assert [k for r in sorted((r for r in blocks if r.item == "hot"), key=lambda r: r.block) for k in r["keys"]] == list(range(500))
    shared = J.sharing(J.posting_blocks(df, "item", "key", 64), df.filter("key = 3"), "item", "key").collect()
    assert {(r.id, r.shared) for r in shared} == {(i, 1) for i in range(500) if i not in (3, 7)} | {(7, 2)}
    assert J.posting_blocks(df.limit(0), "item", "key").count() == 0


def closure(edges):
    users = defaultdict(set)
    for s, d in edges:
        users[d].add(s)
    out = {}
    for v in {x for e in edges for x in e}:
        seen, todo = set(), [v]
        while todo:
            for u in users[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        out[v] = (len(users[v] - {v}), len(seen - {v}))
    return out


def test_impact_of_all_with_cycles(spark):
    rng = random.Random(7)
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 6), (7, 5), (8, 9)] + [(rng.randint(20, 60), rng.randint(20, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(6)] + [(106, 100), (106, 1)]
    df = spark.createDataFrame(edges * 2, "src long, dst long")
    nodes = spark.createDataFrame([(v,) for v in {x for e in edges for x in e} | {999}], "id long")
    got = {r.id: (r.direct, r.affected, r.share) for r in G.impact_of_all(nodes, df).collect()}
    want = closure(edges) | {999: (0, 0)}
    assert got == {v: (d, a, round(a / len(want), 3)) for v, (d, a) in want.items()}
    groups = defaultdict(set)
    for r in G.strong_components(df).collect():
        groups[r.component].add(r.id)
    assert {1, 2, 3} in groups.values() and {4, 5} in groups.values() and set(range(100, 107)) in groups.values()
    assert all(max(v) == k for k, v in groups.items())


def test_impact_of_nothing(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert G.impact_of_all(spark.createDataFrame([], "id long"), none).count() == 0
    assert [tuple(r) for r in G.impact_of_all(spark.createDataFrame([(5,)], "id long"), none).collect()] == [(5, 0, 0, 0, 0.0)]


def test_sharing_sends_lists_not_pairs(spark):
    """Keys in tiles of any size, a null key and one too large for a tile; pairs that meet are counted where they are."""
    rng = random.Random(9)
    rows = [(k, i) for k in [*range(25), None] for i in range(60) if rng.random() < 0.2] + [(7, i) for i in range(60)] + [(3, None), (3, 5), (3, 5)]
    df = spark.createDataFrame(rows, "key long, item long")
    blocks = J.posting_blocks(df, "item", "key", 4)
    pairs = {(k, i) for k, i in rows if i is not None}
    want = Counter((k, other) for k, i in pairs for other, j in pairs if i == j and other is not None and k != other)
    for tile in (1_000_000, 40, 10):
        got = J.sharing(blocks, df, "item", "key", tile).collect()
        assert len(got) == len(want) and {(r.key, r.id): r.shared for r in got} == dict(want)
    plan = J.sharing(blocks, df, "item", "key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate explode(keys")]
    assert J.sharing(blocks, df.limit(0), "item", "key").count() == 0


def brute_shared(pairs):
    lists = defaultdict(set)
    for k, i in pairs:
        if k is not None and i is not None:
            lists[i].add(k)
    return Counter((x, y) for keys in lists.values() for x in keys for y in keys if x != y)


def shuffled(spark):
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_all_sharing_against_brute_force(spark):
    """Items cut by ranges and list sizes, one that all keys list, keys of several tiles, far apart or negative, nulls and copies."""
    rng = random.Random(11)
    near = [(rng.randrange(-40, 60), rng.randrange(80)) for _ in range(900)] + [(k, 7) for k in range(-40, 60)] + [(3, i) for i in range(80)]
    far = [(rng.choice([-(2**63), 2**63 - 1, 0, 5, 2**62, -(2**62)]), rng.randrange(9)) for _ in range(60)]
    for rows, sizes in ((near * 2 + [(None, 3), (4, None), (None, None)], ((1024, 1 << 21), (4, 100), (1, 64))), (far, ((3, 20),)), ([(1, 1)], ((8, 8),))):
        want = brute_shared(rows)
        df = spark.createDataFrame(rows, "key long, item long")
        for size, tile in sizes:
            got = P.all_sharing(df, "item", "key", size, tile).collect()
            assert len(got) == len(want) and {(r.key, r.id): r.shared for r in got} == dict(want)
    assert P.all_sharing(df.limit(0), "item", "key").count() == 0


def test_all_sharing_keeps_types_and_names(spark):
    rows = [(k, f"i{i}") for k in range(12) for i in range(20) if (k * i) % 3 == 1]
    want = {(x, y): n for (x, y), n in brute_shared(rows).items()}
    for kind in ("int", "string"):
        df = spark.createDataFrame(rows, "k int, what string").withColumn("k", F.col("k").cast(kind))
        got = P.all_sharing(df, "what", "k", 2, 8)
        assert dict(got.dtypes) == {"k": kind, "id": kind, "shared": "bigint"}
        assert {(int(r.k), int(r.id)): r.shared for r in got.collect()} == want
    by_number = spark.createDataFrame([(1, float("nan")), (2, float("nan")), (3, -0.0), (4, 0.0)], "k int, what double")
    assert {(r.k, r.id) for r in P.all_sharing(by_number, "what", "k").collect()} == {(1, 2), (2, 1), (3, 4), (4, 3)}


def test_ref_sharing_moves_its_rows_once(spark, tmp_path):
    """What is shuffled: the rows once, and the pairs as differences; sent again and again they were over 50 bytes a row."""
    rng = random.Random(13)
    rows = [(rng.randrange(1000), rng.randrange(600)) for _ in range(30_000)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    before = shuffled(spark)
    got = QUERIES["ref_sharing"](spark, str(tmp_path)).collect()
    moved = shuffled(spark) - before
    assert {(r.l_suppkey, r.id): r.shared for r in got} == dict(brute_shared([(s, p) for p, s in rows]))
    assert moved < 35 * len(rows), moved / len(rows)


def test_pairs_sent_once_take_few_bytes():
    """Pairs that meet once each are packed in about their entropy, and come back whole."""
    rng = np.random.default_rng(5)
    a, b, n = P._summed(rng.integers(0, 500, 20_000), rng.integers(500, 60_500, 20_000))
    raw, packed = P._packed(a, b, n)
    assert all((x == y).all() for x, y in zip((a, b, n), P._unpacked(len(a), raw, packed), strict=True)) and len(packed) < 3 * len(a)
