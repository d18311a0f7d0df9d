"""Source divergence, importance resampling and line dedup against brute force, with odd rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cairnflow.llm import divergence, line_dedup, resampling, shingle_join
from tests.llm.test_operators import ODD, docs_of

CLASH = "doc_id long, text string, lang string, source string, n long, docs long, term string, g long, row string, line string, gone string, score long, place long, able string, bucket int, value long"


def clashing(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns named as the operators name theirs."""
    return spark.createDataFrame([(*r, 1, 1, "t", 1, "r", "l", "g", 1, 1, "a", 1, 1) for r in rows], CLASH)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- source divergence


def brute_audit(rows, least, most):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, counts, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = term.findall(lowered(text))
        docs.update((lang, w) for w in set(words))
        counts.update((lang, source, w) for w in words)
        groups.add((lang, source))
    out = []
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    far = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x for x, _ in groups}:
        kept = [w for (x, w), n in docs.items() if x == lang and n >= least]
        sources = [s for x, s in groups if x == lang]
        n = {s: {w: counts[lang, s, w] for w in kept} for s in sources}
        total = {s: sum(n[s].values()) for s in sources}
        p = {s: {w: share(n[s][w], total[s], len(kept)) for w in kept} for s in sources}
        whole = sum(total.values())
        q = {w: share(sum(n[s][w] for s in sources), whole, len(kept)) for w in kept}
        for s in sources:
            pairs = sorted(((-sum(far(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            best = sorted((-far(p[s][w], q[w]), w.encode(), w) for w in kept if n[s][w] and p[s][w] > q[w])[:most]
            out += [(lang, s, "term", w, -v, i + 1) for i, (v, _, w) in enumerate(best)]
    return sorted(out)


def speech(rng, n, words):
    return " ".join(rng.choice(words) + rng.choice(["", ",", "-x", "9"]) for _ in range(n))


@pytest.mark.parametrize("terms, sources", [(2048, 64), (7, 64), (7, 2), (1, 1)])
def test_audit_against_brute_force(spark, terms, sources):
    rng = random.Random(5)
    words = ["The", "the", "of", "Ärger", "ärger", "größe", "日本", "é", "x1y", *"abcdefghij"]
    rows = [(i, speech(rng, rng.randint(0, 30), words[: 6 + i % 14]), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "ß", "s5"])) for i in range(120)]
    rows += [(200 + i, t, "xx", f"o{i % 3}") for i, t in enumerate(ODD)] + [(300, None, "only", "one"), (301, "", "none", "a"), (302, "12 34", "none", "b")]
    rows += rows[:15]
    got = sorted(map(tuple, divergence.audit(clashing(spark, rows), 4, 3, terms, sources).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == brute_audit(rows, 4, 3)


def test_audit_of_nothing(spark):
    assert divergence.audit(clashing(spark, [])).count() == 0
    assert divergence.audit(clashing(spark, [(1, None, None, None)])).count() == 0


def test_shares_are_exact_where_a_product_would_not_fit():
    rng = random.Random(2)
    for _ in range(300):
        total = rng.randint(1, 9 * 10**15)
        n = rng.randint(0, max(0, total - 2))
        assert divergence.shares(np.array([n]), np.array([total]))[0] == 1 + 10**9 * (n + 2) // total


def test_counts_are_sent_when_many_are_held(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = [(i, "a b c d e " * 3, "en", f"s{i % 2}") for i in range(12)]
    assert sorted(map(tuple, divergence.audit(clashing(spark, rows), 2).select("lang", "source", "part", "item", "value", "rank").collect())) == brute_audit(rows, 2, 10)


# ---- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text):
    w = WORD.findall(lowered(text))
    return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(rows, targets, percent, least):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(x % 10_000 for x in brute_features(text)[1])
    for text in targets:
        t.update(x % 10_000 for x in brute_features(text)[1])
    size, aim = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size + 10_000) / ((s[b] + 1) * (aim + 10_000)))) for b in range(10_000)]
    out, able = {}, []
    for i, text in rows:
        w, f = brute_features(text)
        weight = sum(gain[x % 10_000] for x in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(f), weight, score, None]
        if len(w) >= least:
            able.append((-score, i))
    for k, (_, i) in enumerate(sorted(able)[: percent * len(able) // 100]):
        out[i][3] = k + 1
    return sorted((i, *v) for i, v in out.items())


def test_word_run_crcs_equal_those_of_the_spelled_run():
    rng = random.Random(3)
    pieces = ["a", "Bc", "é", "日本語", "x" * 63, "y" * 64, "Z" * 65, "q" * 5000, "w" * 70_000, "0"]
    for n in (0, 1, 2, 3, 4, 50):
        text = " .,\n"[n % 4].join(rng.choices(pieces, k=n))
        parts = list(resampling.buckets_of(text.encode(), resampling.WordCrcs(), 1 << 31))
        got = Counter(int(x) for _, p in parts for x in p)
        assert got == Counter(x % (1 << 31) for x in brute_features(text)[1])
        assert sum(k for k, _ in parts) == len(brute_features(text)[0])


def test_word_runs_across_slices(monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 16)
    text = " ".join(f"w{i % 7}x" * (1 + i % 3) for i in range(200))
    parts = list(resampling.buckets_of(text.encode(), resampling.WordCrcs(), 1 << 31))
    assert len(parts) > 10 and Counter(int(x) for _, p in parts for x in p) == Counter(x % (1 << 31) for x in brute_features(text)[1])


def test_crc_shift_matrices():
    for n in (0, 1, 5, 63, 64, 100, 4096, 1_000_003):
        a, b = b"some words", bytes(n)
        shifted = resampling.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0]
        assert int(shifted) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_resample_against_brute_force(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "Gamma", "größe", "x9", *"abcdefgh"]
    rows = [(i, speech(rng, rng.randint(0, 60), words)) for i in range(90)] + [(500 + i, t) for i, t in enumerate(ODD)]
    rows += [(600 + i, "alpha beta gamma " * 10) for i in range(6)]  # equal weights
    targets = [speech(rng, 40, words[:5]) for _ in range(5)] + [None, ""]
    docs = clashing(spark, [(i, t, "en", None) for i, t in rows])
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in targets], "text string"), 25, 20)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute_resample(rows, targets, 25, 20)


def test_resample_of_nothing_and_of_repeated_rows(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(clashing(spark, []), none).count() == 0
    docs = clashing(spark, [(None, "a " * 30, None, None)] + [(7, "a " * 30, None, None)] * 5)
    got = resampling.resample(docs, none, 50, 20).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3] and len(got) == 6


# ---- line dedup


def brute_lines(rows, least, chars=1):
    blanks = " \t\n\x0b\x0c\r"
    found = Counter()
    for _, text in rows:
        found.update({lowered(x.strip(blanks)) for x in (text or "").split("\n")})
    gone = {k for k, n in found.items() if n >= least and len(k) >= chars}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if lowered(x.strip(blanks)) not in gone]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, chars", [(3, 1), (2, 4), (1, 1), (3, 0)])
def test_line_dedup_against_brute_force(spark, least, chars):
    rng = random.Random(6)
    lines = ["All rights reserved", " all RIGHTS reserved\t", "", "  ", "é", "É", "one", "x" * 3000, "\x0bone\r", "　wide", "rare 1", "rare 2", "İx", "a\x1fb"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "one\nnew"), (None, "one\nnew"), (3, "one\nthird"), (200, "one\n" * 5000), (201, "\n\n")]
    rows += [(300 + i, f"own {i}") for i in range(5)]
    got = line_dedup.dedup(clashing(spark, [(i, t, "en", None) for i, t in rows]), least, chars)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr) == brute_lines(rows, least, chars)


def test_line_dedup_with_more_shared_lines_than_are_broadcast(spark, monkeypatch):
    plain = line_dedup.weighted_join
    monkeypatch.setattr(line_dedup, "weighted_join", lambda *a, **k: plain(*a, most=2, hot=20, **k))
    rows = [(i, "\n".join(["every document", f"mod {i % 5}", f"half {i % 2}", f"own {i}"])) for i in range(50)]
    got = line_dedup.dedup(docs_of(spark, [t for _, t in rows]), 10)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_lines(rows, 10)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup(clashing(spark, [])).count() == 0


def test_line_dedup_runs_in_the_jvm(spark):
    plan = line_dedup.dedup(docs_of(spark, ["a\nb", "a"]), 2)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- n-gram join: work of the last round


@pytest.mark.parametrize("size", [60, 120])
def test_a_passage_that_links_nobody_is_compared_with_nobody(spark, monkeypatch, size):
    """150 of 180 words are shared, too few for a similarity of 0.75: the last round has no row of them to compare."""
    rows, plain = {}, shingle_join.written

    def counted(df, name):
        out = plain(df, name)
        if name == "mixed":
            rows[name] = out.count()
        return out

    monkeypatch.setattr(shingle_join, "written", counted)
    passage = " ".join(f"p{k}" for k in range(150))
    texts = [f"{passage} " + " ".join(f"d{i}w{k}" for k in range(30)) for i in range(size)]
    twins = [" ".join(f"t{k}" for k in range(100)), " ".join(f"t{k}" for k in range(98))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.join(docs_of(spark, texts + twins)).collect()}
    assert rows["mixed"] == 0
    assert got == {i: (176, i) for i in range(size)} | {size: (96, size), size + 1: (94, size)}


def test_a_smaller_set_is_met_by_larger_ones_of_a_passage(spark):
    """The same passage links a text that is hardly more than the passage with the longer ones."""
    passage = " ".join(f"p{k}" for k in range(150))
    texts = [f"{passage} " + " ".join(f"d{i}w{k}" for k in range(30)) for i in range(8)] + [f"{passage} end"]
    got = {r.doc_id: r.component_id for r in shingle_join.join(docs_of(spark, texts), hub_rounds=0).collect()}
    assert got == dict.fromkeys(range(9), 0)
