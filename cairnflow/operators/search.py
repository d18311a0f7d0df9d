"""Many-to-many search (inventory H1-H3, H5, H8): relevance over a term index, edit distance and pattern similarity.

Each search draws candidates from an index by a bound that no answer can miss, then scores only those: no side is
ever paired with all of the other, and nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import written

#: Slack for bounds in floating point.
SLACK = 1e-9


# ---- relevance


@dataclass
class TermIndex:
    """postings (term, id, weight), entities (id, norm), terms (term, df, idf) and the number of entities."""

    postings: DataFrame
    entities: DataFrame
    terms: DataFrame
    size: int


def _weight(tf: Column, idf: Column) -> Column:
    return (1 + F.log(tf.cast("double"))) * idf


def term_index(rows: DataFrame, key: str, text: str) -> TermIndex:
    """H8: the TF-IDF postings of ``text``, written as tables.

    Terms are keywords (:func:`text.keywords`) without a limit in number, with repeats; weight is (1 + ln tf) x idf,
    idf is ln(1 + entities / df). A null or empty text has no terms and is found by nothing. ``key`` is unique. A term
    that many entities have is counted before the shuffle, and in the join with its df adaptive execution splits it.
    """
    counts = rows.select(F.col(key).alias("id"), F.explode(X.terms(F.col(text))).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    counts = written(counts, "term_counts")
    size = rows.count()
    terms = written(counts.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log1p(F.lit(float(size)) / F.col("df"))), "terms")
    postings = written(counts.join(terms, "term").select("term", "id", _weight(F.col("tf"), F.col("idf")).alias("weight")), "postings")
    entities = written(postings.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")), "entities")
    return TermIndex(postings, entities, terms, size)


def wanted_terms(index: TermIndex, intents: DataFrame, key: str, text: str, share: float, least: float) -> DataFrame:
    """Of every intent its terms: weight q, keyword weight k, sums of both, and whether the term is essential.

    Sorted by df, the most frequent terms of an intent are not essential as long as all of them together could not lift
    an entity to ``least``: their keyword part is added up, their cosine is bounded by their share of the intent's norm.
    """
    kw = X.keywords(F.col(text))
    rows = intents.select(F.col(key).alias("intent"), kw.alias("kw"), F.explode(X.terms(F.col(text))).alias("term"))
    rows = rows.groupBy("intent", "term").agg(F.count("*").alias("tf"), F.max(F.array_contains("kw", F.col("term"))).alias("is_kw"))
    idf = F.coalesce("idf", F.log1p(F.lit(float(index.size))))
    rows = rows.join(index.terms, "term", "left").withColumn("idf", idf)
    rows = rows.select("intent", "term", "df", _weight(F.col("tf"), F.col("idf")).alias("q"), F.when(F.col("is_kw"), F.col("idf")).otherwise(0.0).alias("k"))
    whole = W.partitionBy("intent")  # the terms of one intent
    upto = whole.orderBy(F.desc_nulls_last("df"), "term").rowsBetween(W.unboundedPreceding, 0)
    sums = {"q_all": F.sum(F.col("q") * F.col("q")).over(whole), "k_all": F.sum("k").over(whole), "q_upto": F.sum(F.col("q") * F.col("q")).over(upto), "k_upto": F.sum("k").over(upto)}
    bound = share * F.coalesce(F.try_divide("k_upto", "k_all"), F.lit(0.0)) + (1 - share) * F.sqrt(F.try_divide("q_upto", "q_all"))
    return rows.withColumns(sums).withColumn("essential", bound >= least - SLACK).drop("q_upto", "k_upto")


def recommend(index: TermIndex, intents: DataFrame, key: str, text: str, least: float = 0.4, most: int = 20, share: float = 0.6) -> DataFrame:
    """H8, F1: intent, id, relevance, rank: for every intent the ``most`` entities of at least ``least``, best first.

    relevance = ``share`` x (idf of the intent's keywords that the entity has / idf of all of them)
    + (1 - ``share``) x cosine of the TF-IDF vectors; to nine digits, ties to the smaller id. The weights, the bound 0.4
    and the number 20 are given, the components' formulas ours. An intent without terms finds nothing, nor does any
    intent in an empty index; repeated intents (of one key) are one.
    """
    wanted = written(wanted_terms(index, intents, key, text, share, least), "wanted")
    drawn = wanted.filter("essential AND df IS NOT NULL").select("intent", "term")
    candidates = index.postings.join(drawn, "term").select("intent", "id").distinct()
    hits = candidates.join(wanted.select("intent", "term", "q", "k"), "intent").join(index.postings, ["term", "id"])
    scored = hits.groupBy("intent", "id").agg(F.sum(F.col("q") * F.col("weight")).alias("dot"), F.sum("k").alias("k"))
    totals = wanted.select("intent", "q_all", "k_all").distinct()
    both = scored.join(index.entities, "id").join(totals, "intent")
    overlap = F.coalesce(F.try_divide("k", "k_all"), F.lit(0.0))
    relevance = F.round(share * overlap + (1 - share) * F.col("dot") / (F.col("norm") * F.sqrt("q_all")), 9)
    best = both.select("intent", "id", relevance.alias("relevance")).filter(F.col("relevance") >= least)
    rank = F.row_number().over(W.partitionBy("intent").orderBy(F.desc("relevance"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= most)


# ---- edit distance


def _segments(length: Column, most: int) -> Column:
    """For strings of a length: (i, start, size) of ``most`` + 1 even segments, start from 0."""
    n = most + 1
    size, longer = F.floor(length / n).cast("int"), n - F.pmod(length, F.lit(n))  # the last ones are longer by one
    return F.array(*(F.struct(F.lit(i).alias("i"), (i * size + F.greatest(F.lit(0), i - longer)).cast("int").alias("start"), (size + (F.lit(i) >= longer).cast("int")).cast("int").alias("size")) for i in range(n)))


def _without(value: Column) -> Column:
    """All strings that lack one character of ``value``."""
    n = F.length(value)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.substr(value, F.lit(1), i - 1), F.substr(value, i + 1, n)))


def shortened(value: Column, most: int) -> Column:
    """Distinct strings that lack up to ``most`` characters of ``value``, itself among them."""
    found = last = F.array(value)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(last, _without)))
        found = F.array_union(found, last)
    return found


def close_pairs(values: DataFrame, value: str, most: int = 2, hot: int = 64) -> DataFrame:
    """H1: a, b, distance of all distinct values a < b within ``most`` edits; nulls take no part.

    Two such strings agree in one of ``most`` + 1 segments of the shorter one, near its place: segments meet substrings by
    equality. A segment that more than ``hot`` strings share (a common prefix) says little; its strings meet by what is
    left of them without up to ``most`` characters instead, which two strings within ``most`` edits also share. Candidates
    are verified by the distance itself where they meet, so the result is exact and only answers are told apart. What is
    exploded from a small file is large, which its size does not tell, so these joins sort and never broadcast.
    """
    distinct = written(values.select(F.col(value).alias("s")).filter("s IS NOT NULL").distinct().withColumn("n", F.length("s")), "strings")
    cut = distinct.select("s", F.col("n").alias("l"), F.explode(_segments(F.col("n"), most)).alias("x"))
    index = cut.select("s", "l", "x.i", F.substr(F.col("s"), F.col("x.start") + 1, F.col("x.size")).alias("part"))
    # A string looks for segments of strings as long as itself or up to ``most`` shorter, around the place they stand at.
    shorter = F.sequence(F.greatest(F.lit(0), F.col("n") - most), F.col("n"))
    looks = distinct.select("s", "n", F.explode(shorter).alias("l")).select("s", "n", "l", F.explode(_segments(F.col("l"), most)).alias("x"))
    gap = F.col("n") - F.col("l")
    low = F.greatest(F.lit(0), F.col("x.start") - F.floor((most - gap) / 2).cast("int"))
    high = F.least(F.col("n") - F.col("x.size"), F.col("x.start") + F.floor((most + gap) / 2).cast("int"))
    probes = looks.withColumns({"low": low, "high": high}).filter("low <= high").select("s", "l", "x", F.explode(F.sequence("low", "high")).alias("at"))
    probes = probes.select("s", "l", "x.i", F.substr(F.col("s"), F.col("at") + 1, F.col("x.size")).alias("part")).distinct()
    place = ["l", "i", "part"]
    crowded = written(index.groupBy(*place).agg(F.count("*").alias("k")).filter(F.col("k") > hot).drop("k"), "crowded")
    rare = index.join(crowded, place, "left_anti")
    found = rare.alias("a").join(probes.hint("merge").alias("b"), place).filter("a.s <> b.s").select(F.least("a.s", "b.s").alias("a"), F.greatest("a.s", "b.s").alias("b"))
    many = probes.join(crowded, place, "left_semi").select("s").distinct()
    # One edit leaves out the same place of both or a place of one (0: none), which is told before the distance.
    ways = F.concat(F.array("s"), _without(F.col("s"))) if most == 1 else shortened(F.col("s"), most)
    rests = many.select("s", F.posexplode(ways).alias("place", "rest"))
    fits = "a.s < b.s" + (" AND (a.place = b.place OR a.place = 0 OR b.place = 0)" if most == 1 else "")
    dense = rests.alias("a").join(rests.hint("merge").alias("b"), "rest").filter(fits).select(F.col("a.s").alias("a"), F.col("b.s").alias("b"))
    close = lambda pairs: pairs.withColumn("distance", F.levenshtein("a", "b", most)).filter(F.col("distance") >= 0)
    return close(found).unionByName(close(dense)).distinct()


# ---- pattern similarity

#: Items of a sequence that fit the bits of one number.
BITS = 62


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two arrays; null items equal nothing.

    Up to ``BITS`` items of ``b`` are bits of one number, and an item of ``a`` costs one addition; beyond that the
    table of lengths is folded row by row.
    """
    full = F.lit((1 << BITS) - 1)
    numbered = F.transform(b, lambda y, i: F.struct(y.alias("y"), F.call_function("shiftleft", F.lit(1).cast("long"), i).alias("bit")))
    mask = lambda x: F.aggregate(numbered, F.lit(0).cast("long"), lambda m, y: F.when(y["y"] == x, m.bitwiseOR(y["bit"])).otherwise(m))
    step = lambda v, u: (v + u).bitwiseOR(v - u).bitwiseAND(full)
    left = F.aggregate(a, full, lambda v, x: step(v, v.bitwiseAND(mask(x))))
    bits = F.lit(BITS) - F.bit_count(left)

    def row(before: Column, x: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(F.sequence(F.lit(1), F.size(b)), start, lambda now, j: F.concat(now, F.array(F.greatest(F.get(now, j - 1), F.when(F.get(b, j - 1) == x, F.get(before, j - 1) + 1).otherwise(F.get(before, j))))))

    folded = F.aggregate(a, F.array_repeat(F.lit(0), F.size(b) + 1), row)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0).when(F.size(b) <= BITS, bits).otherwise(F.element_at(folded, -1)).cast("int")


def _heads(rows: DataFrame, order: DataFrame, least: float, name: str) -> DataFrame:
    """(name, token) of the rarest tokens of every sequence: a match shares one of them.

    A token is an item and which of its occurrences it is. A match of n items has at least least / (2 - least) x n
    items, so at least as many are common, and all tokens but so many and one may be left out.
    """
    rows = rows.join(order, "token", "left").withColumn("__at", F.row_number().over(W.partitionBy("id").orderBy(F.coalesce("df", F.lit(0)), "token")))
    spare = F.col("n") - F.ceil(F.col("n") * (least / (2 - least)) - SLACK).cast("int") + 1
    return rows.filter(F.col("__at") <= spare).select(F.col("id").alias(name), "token")


def _tokens(items: Column) -> Column:
    """A token for each item that is not null, sorted."""
    known = F.array_sort(F.filter(items, lambda x: x.isNotNull()))
    return F.transform(known, lambda x, i: F.struct(x.alias("item"), (i + 2 - F.array_position(known, x)).alias("k")))


def _classes(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, items) as members (id, seq) of different sequences (seq, items, bag) of different bags (id, n, tokens)."""
    rows = written(rows, name)
    seqs = written(rows.select("items").distinct().select(F.monotonically_increasing_id().alias("seq"), "items", F.size("items").alias("n"), _tokens(F.col("items")).alias("tokens")), f"{name}_sequences")
    bags = written(seqs.select("n", "tokens").distinct().withColumn("id", F.monotonically_increasing_id()), f"{name}_bags")
    members = rows.join(seqs, "items").select("id", "seq")
    return members, seqs.join(bags, ["n", "tokens"]).select("seq", "items", F.col("id").alias("bag")), bags


def similar_patterns(store: DataFrame, probes: DataFrame, key: str, items: str, least: float = 0.3) -> DataFrame:
    """H5: probe, pattern, similarity of all stored patterns (key, items) at least ``least`` like a probe (key, items).

    similarity = 2 x longest common subsequence / items of both, in (0, 1], to nine digits (the formula is ours). The
    common subsequence is no longer than what the two have in common as bags, so they share one of the rarest tokens of
    either: bags meet by those and are held to that length, then the different sequences of two bags that fit are compared,
    and only what comes out is dealt to the keys that have these sequences. Null and empty sequences match nothing.
    """
    text = F.transform(items, lambda x: x.cast("string"))
    probes, store = (r.select(F.col(key).alias("id"), text.alias("items")).filter(F.size("items") > 0) for r in (probes, store))
    (asking, probes, a), (kept, store, b) = _classes(probes, "probes"), _classes(store, "patterns")
    tokens = lambda bags: bags.select("id", "n", F.explode("tokens").alias("token"))
    order = tokens(b).groupBy("token").agg(F.count("*").alias("df"))
    met = _heads(tokens(a), order, least, "p").join(_heads(tokens(b), order, least, "q"), "token").select("p", "q").distinct()
    met = met.join(a.select(F.col("id").alias("p"), F.col("n").alias("pn"), F.col("tokens").alias("pt")), "p").join(b.select(F.col("id").alias("q"), F.col("n").alias("qn"), F.col("tokens").alias("qt")), "q")
    met = written(met.filter(2 * F.size(F.array_intersect("pt", "qt")) >= least * (F.col("pn") + F.col("qn")) - SLACK).select("p", "q"), "bag_pairs")
    pairs = met.join(probes.select(F.col("seq").alias("probe"), F.col("items").alias("a"), F.col("bag").alias("p")), "p").join(store.select(F.col("seq").alias("pattern"), F.col("items").alias("b"), F.col("bag").alias("q")), "q")
    similarity = F.round(2 * common_length(F.col("a"), F.col("b")) / (F.size("a") + F.size("b")), 9)
    pairs = pairs.select("probe", "pattern", similarity.alias("similarity")).filter((F.col("similarity") >= least) & (F.col("similarity") > 0))
    pairs = written(pairs, "sequence_pairs")
    named = pairs.join(kept.select(F.col("seq").alias("pattern"), "id"), "pattern").select("probe", F.col("id").alias("pattern"), "similarity")
    return named.join(asking.select(F.col("seq").alias("probe"), "id"), "probe").select(F.col("id").alias("probe"), "pattern", "similarity")
