"""Paths that large inputs take: rules as a table, waves of queries."""

import random

import numpy as np
from pyspark.sql import functions as F

from cairnflow.llm import topk, urls


def test_rules_as_a_table_judge_as_a_few_rules_do(spark, monkeypatch):
    rng = random.Random(1)
    names = ["a", "b", "example", "com", "org", "co", ""]
    host = lambda: ".".join(rng.choices(names, k=rng.randint(1, 4)))
    path = lambda: "".join(rng.choices(["/", "/x", "/é", "1", "?q"], k=rng.randint(0, 4)))
    rows = [(i, rng.choice(["http://", "https://", "", "://"]) + host().upper() + path()) for i in range(400)] + [(900, None), (901, ""), (902, "http://com/"), (902, "http://com/")]
    rules = {(h, p): rng.choice(["allow", "block"]) for h, p in [(host(), path().replace("?q", "")) for _ in range(60)] + [("com", "/"), ("com", ""), ("b.com", "/x")]}
    # Of one length only one rule of a place may be named: lengths of fitting rules differ by construction of a tie rule below.
    triples = sorted(((a, h, p) for (h, p), a in rules.items()), key=lambda t: (t[1], t[2], t[0]))
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, place string, rule string")
    none = spark.createDataFrame([], "page_id long, bad int")
    table = spark.createDataFrame([(h, p, a, 1) for a, h, p in triples] * 2 + [(None, "/", "block", 1)], "host string, path string, action string, n int")
    want = sorted(map(str, urls.judge_urls(pages, none, triples).collect()))
    assert sorted(map(str, urls.judge_urls(pages, none, table).collect())) == want
    plain = urls.weighted_join
    monkeypatch.setattr(urls, "weighted_join", lambda *a, **k: plain(*a, most=2, hot=5, **k))
    assert sorted(map(str, urls.judge_urls(pages, none, table).collect())) == want
    assert urls.judge_urls(pages, none, table.limit(0)).filter("rule IS NOT NULL").count() == 0


def test_waves_are_searched_one_after_the_other(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-9, 10, 5)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, x array<double>")
    asked = df.filter(F.col("vec_id") % 4 == 0)
    one = sorted(map(tuple, topk.top_k(df, asked, 3).collect()))
    many = topk.top_k(df, asked, 3, shard_rows=40, block_rows=4)
    assert sorted(map(tuple, many.collect())) == one and many.columns == ["query_id", "rank", "vec_id", "score"]
