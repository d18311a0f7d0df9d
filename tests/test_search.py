"""Relevance, edit distance and pattern search against brute force over all pairs."""

import math
import random
from collections import Counter

from cairnflow.functions import text as X
from cairnflow.operators import search
from pyspark.sql import functions as F


def terms(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isascii() and c.isalnum():
            word += c
        else:
            if len(word) >= 3 and word not in X.STOP_WORDS:
                out.append(word)
            word = ""
    return out


def brute_recommend(entities, intents, least, most, share=0.6):
    tf = {i: Counter(terms(t)) for i, t in entities}
    df = Counter(w for c in tf.values() for w in c)
    idf = lambda w: math.log1p(len(entities) / df[w] if w in df else len(entities))
    vector = lambda c: {w: (1 + math.log(n)) * idf(w) for w, n in c.items()}
    out = []
    for i, text in intents:
        q, kw = vector(Counter(terms(text))), list(dict.fromkeys(terms(text)))[:15]
        found = []
        for e, c in tf.items():
            d = vector(c)
            dot = sum(x * d.get(w, 0) for w, x in q.items())
            if any(w in d for w in q):
                over = sum(idf(w) for w in kw if w in d) / sum(map(idf, kw))
                score = round(share * over + (1 - share) * dot / math.sqrt(sum(x * x for x in d.values())) / math.sqrt(sum(x * x for x in q.values())), 9)
                if score >= least:
                    found.append((-score, e))
        out += [(i, e, -s, k + 1) for k, (s, e) in enumerate(sorted(found)[:most])]
    return sorted(out)


def test_recommend_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [a + b + c for a in "abcd" for b in "eio" for c in "nrst"]
    text = lambda k, n: " ".join(rng.choices(vocabulary[:k], weights=[1 / (1 + x) for x in range(k)], k=n))
    entities = [(i, text(48, rng.randint(0, 40))) for i in range(150)] + [(200, None), (201, ""), (202, "the of"), (203, "a" * 9000), (204, text(48, 6000))]
    entities += [(300 + i, "common phrase of copies") for i in range(60)]
    intents = [(i, text(48, rng.randint(1, 8))) for i in range(30)] + [(90, None), (91, "  "), (92, "unheard words only"), (93, "copies phrase"), (94, "ben " * 300)]
    index = search.term_index(spark.createDataFrame(entities, "key long, text string"), "key", "text")
    wanted = spark.createDataFrame(intents, "item long, text string")
    for least, most in ((0.4, 20), (0.15, 5), (0.9, 3)):
        got = search.recommend(index, wanted, "item", "text", least, most)
        want = brute_recommend(entities, intents, least, most)
        rows = sorted(tuple(r) for r in got.select("intent", "id", "relevance", "rank").collect())
        assert [(a, b, round(c, 7), d) for a, b, c, d in rows] == [(a, b, round(c, 7), d) for a, b, c, d in want]
    drawn = search.wanted_terms(index, wanted, "item", "text", 0.6, 0.4).groupBy("essential").count().collect()
    assert {r["essential"] for r in drawn} == {True, False}  # some terms draw no candidates


def test_recommend_from_nothing(spark):
    none = spark.createDataFrame([], "key long, text string")
    some = spark.createDataFrame([(1, "alpha beta")], "key long, text string")
    assert search.recommend(search.term_index(none, "key", "text"), some, "key", "text").count() == 0
    assert search.recommend(search.term_index(some, "key", "text"), none, "key", "text").count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_close_pairs_against_all_pairs(spark):
    rng = random.Random(2)
    values = {"".join(rng.choices("abc", k=rng.randint(0, 7))) for _ in range(220)} | {"prefix#" + str(rng.randint(0, 400)) for _ in range(90)} | {"é", "éa", "日本語", "日本", "x" * 300, "x" * 298}
    rows = spark.createDataFrame([(v,) for v in [*values, *values, None]], "s string")
    for most in (0, 1, 2, 3):
        want = {(a, b, edits(a, b)) for a in values for b in values if a < b and abs(len(a) - len(b)) <= most and edits(a, b) <= most}
        for hot in (10_000, 64, 3):
            if most == 3 and hot < 10_000:  # what is left of 300 characters without three of them is too much for a test
                continue
            got = [tuple(r) for r in search.close_pairs(rows.filter("length(s) < 50 OR s IS NULL") if hot < 64 else rows, "s", most, hot).collect()]
            assert sorted(got) == sorted(x for x in want if hot >= 64 or max(len(x[0]), len(x[1])) < 50)
    assert search.close_pairs(rows.limit(0), "s").count() == 0


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x is not None and x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_length(spark):
    rng = random.Random(3)
    pairs = [([rng.choice("abcd") for _ in range(rng.randint(0, n))], [rng.choice("abcd") for _ in range(rng.randint(0, n))]) for n in (3, 8, 30, 62, 90) for _ in range(12)]
    pairs += [([], []), (["a"], []), ([None], [None]), (["a", None], [None, "a"]), (["a"] * 62, ["a"] * 62), (["a"] * 63, ["a"] * 63)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    got = [r.n for r in df.select(search.common_length(F.col("a"), F.col("b")).alias("n")).collect()]
    assert got == [subsequence(a, b) for a, b in pairs]


def test_similar_patterns_against_all_pairs(spark):
    rng = random.Random(4)
    sequences = [[rng.choice("abcdefgh"[: 2 + i % 7]) for _ in range(rng.randint(1, 9))] for i in range(120)]
    store = [(i, s) for i, s in enumerate(sequences[:90])] + [(500, None), (501, []), (502, ["a", None, "b"])]
    probes = [(i, s) for i, s in enumerate(sequences[60:])] + [(500, None), (501, []), (502, [None])]
    kind = "key long, items array<string>, token string"
    frame = lambda rows: spark.createDataFrame([(*r, "t") for r in rows], kind)
    for least in (0.3, 0.6, 1.0):
        want = sorted((p, q, round(2 * subsequence(a, b) / (len(a) + len(b)), 9)) for p, a in probes if a for q, b in store if b and subsequence(a, b) and round(2 * subsequence(a, b) / (len(a) + len(b)), 9) >= least)
        got = sorted(tuple(r) for r in search.similar_patterns(frame(store), frame(probes), "key", "items", least).collect())
        assert got == want
    found = search.similar_patterns(frame([(1, ["develop", "review-qa", "apply-qa-fixes"])]), frame([(7, ["develop", "review-qa"])]), "key", "items").collect()
    assert [tuple(r) for r in found] == [(7, 1, 0.8)]


def test_copies_of_sequences_are_compared_once(spark, monkeypatch):
    """Probes and patterns that are copies of few sequences: only these meet, and bags that are too unlike never do."""
    made, kept = {}, search.written

    def counted(df, name):
        made[name] = kept(df, name)
        return made[name]

    monkeypatch.setattr(search, "written", counted)
    sequences = [list("abcde"), list("abced"), list("aaxyz"), list("vwxyz")]
    rows = lambda n: spark.createDataFrame([(i, sequences[i % 4]) for i in range(n)], "key long, items array<string>")
    got = search.similar_patterns(rows(40), rows(800), "key", "items", 0.8).groupBy("similarity").count().collect()
    assert {(r.similarity, r["count"]) for r in got} == {(1.0, 800 * 10), (0.8, 400 * 10)}
    assert (made["bag_pairs"].count(), made["sequence_pairs"].count()) == (3, 6)


def test_close_pairs_broadcast_nothing_exploded(spark):
    """Names of a few bytes in the file become many strings: a broadcast of those filled the driver."""
    names = spark.range(2_000).selectExpr("format_string('Customer#%09d', id) AS s")
    pairs = search.close_pairs(names, "s", 1)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and plan.count("LeftSemi, BuildRight") + plan.count("LeftAnti, BuildRight") == plan.count("BroadcastHashJoin")
    assert pairs.count() == sum(1 for a in range(2_000) for k in range(4) for d in range(a // 10**k % 10 + 1, 10) if a + (d - a // 10**k % 10) * 10**k < 2_000)
