"""Queries of search, ranks, graphs and posting blocks over the driver's tables, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import graph as G
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import pairs as P
from ..operators import search as Q
from .base import Tables, query

_STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
_TERMS = f"list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: length(w) >= 3 AND w NOT IN ({_STOP}))"


@query(f"""WITH e AS MATERIALIZED (SELECT doc_id AS id, unnest({_TERMS}) AS term FROM documents), b AS MATERIALIZED (SELECT item_id AS intent, {_TERMS} AS terms FROM benchmark),
n AS (SELECT count(*)::DOUBLE AS n FROM documents), tf AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM e GROUP BY ALL),
idf AS MATERIALIZED (SELECT term, ln(1 + any_value(n.n) / count(*)) AS idf FROM tf, n GROUP BY term),
p AS MATERIALIZED (SELECT id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)), norm AS (SELECT id, sqrt(sum(w * w)) AS norm FROM p GROUP BY id),
q0 AS (SELECT intent, term, count(*) AS tf, bool_or(list_contains(kw, term)) AS is_kw FROM (SELECT intent, unnest(terms) AS term,
  list_slice(list_transform(list_sort(list_transform(list_distinct(terms), lambda w: {{'at': list_position(terms, w), 'w': w}})), lambda x: x.w), 1, 15) AS kw FROM b) GROUP BY ALL),
q AS MATERIALIZED (SELECT intent, term, (1 + ln(tf)) * i AS q, CASE WHEN is_kw THEN i ELSE 0 END AS k FROM (SELECT q0.*, coalesce(idf, (SELECT ln(1 + n) FROM n)) AS i FROM q0 LEFT JOIN idf USING (term))),
s AS (SELECT intent, sqrt(sum(q * q)) AS qn, sum(k) AS ks FROM q GROUP BY intent),
r AS (SELECT intent, id, round(0.6 * coalesce(sum(k) / any_value(ks), 0) + 0.4 * sum(q * w) / (any_value(norm) * any_value(qn)), 9) AS relevance
  FROM q JOIN p USING (term) JOIN norm USING (id) JOIN s USING (intent) GROUP BY intent, id)
SELECT intent, id, round(relevance, 6) AS relevance, (row_number() OVER (PARTITION BY intent ORDER BY relevance DESC, id))::INTEGER AS rank FROM r WHERE relevance >= 0.4 QUALIFY rank <= 20""")
def ref_recommend(t: Tables) -> DataFrame:
    """H8, F1: the documents that fit each benchmark item, by an index of all documents."""
    index = Q.term_index(t.documents, "doc_id", "text")
    return Q.recommend(index, t.benchmark, "item_id", "text").withColumn("relevance", F.round("relevance", 6))


@query("SELECT a.p_name AS a, b.p_name AS b, levenshtein(a.p_name, b.p_name)::INTEGER AS distance FROM (SELECT DISTINCT p_name FROM part) a JOIN (SELECT DISTINCT p_name FROM part) b ON a.p_name < b.p_name WHERE levenshtein(a.p_name, b.p_name) <= 2")
def ref_close_part_names(t: Tables) -> DataFrame:
    """H1"""
    return Q.close_pairs(t.part, "p_name")


@query("SELECT a.c_name AS a, b.c_name AS b, levenshtein(a.c_name, b.c_name)::INTEGER AS distance FROM customer a JOIN customer b ON a.c_name < b.c_name WHERE levenshtein(a.c_name, b.c_name) <= 1")
def ref_close_customer_names(t: Tables) -> DataFrame:
    """H1 on names that all begin alike."""
    return Q.close_pairs(t.customer, "c_name", 1)


_DAYS = "SELECT user_id, ts::DATE AS day, list(event_type ORDER BY ts, event_id) AS items FROM events GROUP BY ALL HAVING count(*) >= 3"


@query(f"""WITH d AS MATERIALIZED ({_DAYS}), store AS MATERIALIZED (SELECT array_to_string(items, '>') AS key, any_value(items) AS items FROM d GROUP BY 1),
probe AS MATERIALIZED (SELECT user_id AS key, arg_max(items, day) AS items FROM d GROUP BY 1),
x AS (SELECT p.key AS probe, s.key AS pattern, p.items AS a, s.items AS b FROM probe p JOIN store s ON 2 * least(len(p.items), len(s.items)) >= 0.8 * (len(p.items) + len(s.items))),
l AS (SELECT probe, pattern, len(a) + len(b) AS n, list_reduce(a, lambda before, x: list_reduce(range(1, len(b) + 1), lambda now, j:
  list_append(now, CASE WHEN b[j] = x THEN before[j] + 1 ELSE greatest(before[j + 1], now[j]) END), [0::BIGINT]), list_transform(range(0, len(b) + 1), lambda i: 0::BIGINT)) AS last FROM x)
SELECT probe, pattern, round(2 * last[-1] / n, 6) AS similarity FROM l WHERE round(2 * last[-1] / n, 9) >= 0.8""")
def ref_similar_patterns(t: Tables) -> DataFrame:
    """H5: stored days of events that are like the last day of each user."""
    day = t.events.select("user_id", F.to_date("ts").alias("day"), F.struct("ts", "event_id", "event_type").alias("e"))
    days = day.groupBy("user_id", "day").agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["event_type"]).alias("items")).filter(F.size("items") >= 3)
    store = days.groupBy(F.array_join("items", ">").alias("key")).agg(F.first("items").alias("items"))
    probes = days.groupBy(F.col("user_id").alias("key")).agg(F.max_by("items", "day").alias("items"))
    return Q.similar_patterns(store, probes, "key", "items", 0.8).withColumn("similarity", F.round("similarity", 6))


_GRAPH = """SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
UNION SELECT 'n' || c_nationkey, 'n' || s_nationkey FROM (SELECT DISTINCT c_nationkey, s_nationkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE l_orderkey % 500 = 0)
WHERE c_nationkey <> s_nationkey UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation"""


def _trade(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Parts use their suppliers, suppliers their nation, nations those they buy from (every 500th order) and their region."""
    edge = lambda a, x, b, y: F.struct(F.concat(F.lit(a), F.col(x)).alias("src"), F.concat(F.lit(b), F.col(y)).alias("dst")).alias("e")
    bought = t.lineitem.filter("l_orderkey % 500 = 0").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    parts = [t.lineitem.select(edge("p", "l_partkey", "s", "l_suppkey")), t.supplier.select(edge("s", "s_suppkey", "n", "s_nationkey")), bought.filter("c_nationkey <> s_nationkey").select(edge("n", "c_nationkey", "n", "s_nationkey")), t.nation.select(edge("n", "n_nationkey", "r", "n_regionkey"))]
    edges = J.concatenated(*parts).select("e.*").distinct()
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), edges


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_GRAPH}), v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e),
c AS (SELECT dst AS id, src AS dependant FROM e UNION SELECT c.id, e.src FROM c JOIN e ON e.dst = c.dependant),
n AS (SELECT id, count(*) AS affected FROM c WHERE dependant <> id GROUP BY id), d AS (SELECT dst AS id, count(*) AS direct FROM e WHERE src <> dst GROUP BY dst)
SELECT id, coalesce(direct, 0) AS direct, coalesce(affected, 0) - coalesce(direct, 0) AS indirect, coalesce(affected, 0) AS affected, round(coalesce(affected, 0) / (SELECT count(*) FROM v), 3) AS share
FROM v LEFT JOIN n USING (id) LEFT JOIN d USING (id)""")
def ref_impact_of_all(t: Tables) -> DataFrame:
    """I1 of every vertex, cycles included."""
    return G.impact_of_all(*_trade(t))


@query("""SELECT l_suppkey, block::BIGINT AS block, count(*)::INTEGER AS n, array_to_string(list(l_partkey ORDER BY l_partkey), ',') AS keys FROM (SELECT *, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 64 AS block
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) GROUP BY ALL""")
def ref_posting_blocks(t: Tables) -> DataFrame:
    """C6, C16"""
    return J.posting_blocks(t.lineitem, "l_suppkey", "l_partkey", 64).withColumn("keys", F.array_join("keys", ","))


@query("""WITH p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) SELECT a.l_suppkey, b.l_suppkey AS id, count(*) AS shared FROM p a JOIN p b USING (l_partkey) WHERE a.l_suppkey <> b.l_suppkey GROUP BY ALL""")
def ref_sharing(t: Tables) -> DataFrame:
    """Suppliers that share parts."""
    return P.all_sharing(t.lineitem, "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, (row_number() OVER w - 1) // 100 + 1 AS page, (row_number() OVER w - 1) % 100 + 1 AS place FROM orders WINDOW w AS (ORDER BY o_totalprice DESC, o_orderkey)")
def ref_pages(t: Tables) -> DataFrame:
    """all pages of a table at once."""
    return O.pages(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 100).select("o_orderkey", "page", "place")


@query("SELECT doc_id FROM (SELECT doc_id, sum(ceil(length(coalesce(text, '')) / 4)) OVER (ORDER BY doc_id) AS s FROM documents) WHERE s <= 200000")
def ref_pooled_budget(t: Tables) -> DataFrame:
    """One budget over all rows."""
    docs = t.documents.select("doc_id", X.token_estimate(F.col("text")).alias("tokens"))
    return O.within_budget(docs, [], [F.col("doc_id")], F.col("tokens"), 200_000).select("doc_id")


@query("SELECT p_partkey, (CASE WHEN contains(lower(p_name), 'ring') THEN 8 ELSE 0 END + CASE WHEN contains(lower(p_type), 'ring') THEN 5 ELSE 0 END)::DOUBLE AS score FROM part WHERE score >= 1 ORDER BY score DESC, p_partkey LIMIT 20")
def ref_field_search_named(t: Tables) -> DataFrame:
    """F9 for a word that names have."""
    score = O.field_score("RING", {"p_name": 8.0, "p_type": 5.0}, {"p_name": F.col("p_name"), "p_type": F.col("p_type")})
    return O.top(t.part, score, [F.col("p_partkey")], 20, 1.0).select("p_partkey", "score")


@query("""SELECT page_id AS id, 'extra' AS state FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'missing' FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)""")
def ref_extra_and_missing(t: Tables) -> DataFrame:
    """Ids on either side that the other lacks."""
    pages, labels = t.pages.select(F.col("page_id").alias("id")), t.labels.select(F.col("doc_id").alias("id")).distinct()
    return J.missing_from(pages, labels, "id").withColumn("state", F.lit("extra")).unionByName(J.missing_from(labels, pages, "id").withColumn("state", F.lit("missing")))


@query("""WITH w AS (SELECT doc_id, unnest(t) AS word, unnest(range(len(t))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]+') AS t FROM benchmark_words))
SELECT word, n FROM (SELECT word, count(*) AS n, min((doc_id, i)) AS place FROM w WHERE regexp_full_match(word, '[a-z]+') GROUP BY word ORDER BY n DESC, place LIMIT 10)""".replace("benchmark_words", "(SELECT item_id AS doc_id, text FROM benchmark)"))
def ref_first_top_words(t: Tables) -> DataFrame:
    """ties go to the word that comes first."""
    per = t.benchmark.select("item_id", F.posexplode(X.words(F.col("text"))).alias("at", "word"))
    return O.top_words(per, "word", ["item_id", "at"])


@query("""SELECT user_id, round(CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE 0.4 * a + 0.6 * b END, 6) AS overall FROM (SELECT user_id, 100 * avg((event_type <> 'error')::DOUBLE) FILTER (value < 5) AS a,
100 * avg((event_type <> 'error')::DOUBLE) FILTER (value > 20) AS b FROM events GROUP BY user_id)""")
def ref_overall_score(t: Tables) -> DataFrame:
    """The overall figure of two scores."""
    rate = lambda c: 100 * F.avg(F.when(c, (F.col("event_type") != "error").cast("double")))
    per = t.events.groupBy("user_id").agg(rate(F.col("value") < 5).alias("a"), rate(F.col("value") > 20).alias("b"))
    return per.select("user_id", F.round(A.pooled_score(F.col("a"), F.col("b")), 6).alias("overall"))


@query("SELECT doc_id, CASE WHEN length(text) > 350 THEN left(text, 350) || '...' ELSE coalesce(text, '') END AS head FROM documents")
def ref_truncated(t: Tables) -> DataFrame:
    """Texts cut to 100 tokens."""
    return t.documents.select("doc_id", X.truncate_tokens(F.col("text"), 100).alias("head"))
