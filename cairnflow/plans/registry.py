"""All queries outside the training-text subpackage, each beside its DuckDB SQL; those of sources are in ``catalogue``.

``ref_*`` queries apply an operator of the inventory to the driver's tables: the same semantics on other
data. ``ext_*`` queries are standard relational operators that the inventory lacks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import conditions as C
from ..operators import graph as G
from ..operators import joins as J
from ..operators import ordered as O
from ..sources import lines as L
from ..streaming import feeds as R
from . import catalogue, relations, streams
from .base import ORACLES, QUERIES, Tables, query

__all__ = ["ORACLES", "QUERIES", "catalogue", "relations", "streams"]

def _ok():
    """Events that are no errors count as passed runs."""
    return F.col("event_type") != "error"



@query("SELECT user_id, count(*) AS total_runs, avg((event_type <> 'error')::DOUBLE) AS pass_rate, round(avg(value), 6) AS avg_duration, max(ts) AS last_run FROM events GROUP BY user_id")
def ref_run_stats(t):
    """D1"""
    return A.run_stats(t.events, ["user_id"], _ok(), F.col("value"), F.col("ts")).withColumn("avg_duration", F.round("avg_duration", 6))


@query("SELECT user_id, coalesce(sum(l_size) FILTER (event_type = 'error'), 0)::BIGINT AS error, coalesce(sum(l_size) FILTER (event_type = 'view'), 0)::BIGINT AS view FROM (SELECT *, (props->>'k')::BIGINT AS l_size FROM events) GROUP BY user_id")
def ref_severity_counts(t):
    """D2"""
    return A.severity_counts(t.events, ["user_id"], F.col("event_type"), F.get_json_object("props", "$.k").cast("long"), ["error", "view"])


@query("SELECT ts::DATE::VARCHAR AS date, avg((event_type <> 'error')::DOUBLE) AS value, count(*) AS n FROM events GROUP BY 1")
def ref_daily_trend(t):
    """D3"""
    return A.daily(t.events, F.col("ts"), _ok().cast("double")).withColumn("date", F.col("date").cast("string"))


_STATS = "coalesce(min(g), 0) AS min, coalesce(max(g), 0) AS max, coalesce(quantile_disc(g, .5), 0) AS p50, coalesce(quantile_disc(g, .95), 0) AS p95, coalesce(quantile_disc(g, .99), 0) AS p99, round(coalesce(avg(g), 0), 6) AS mean, count(g) AS n, count(*) FILTER (v < 0) AS errors"


@query(f"SELECT event_type, {_STATS} FROM (SELECT event_type, value - 10 AS v, CASE WHEN value >= 10 THEN value - 10 END AS g FROM events) GROUP BY GROUPING SETS ((event_type), ())")
def ref_stats_report(t):
    """D4-D6"""
    return A.stats_report(t.events.withColumn("v", F.col("value") - 10), "v", ["event_type"], pooled=True).withColumn("mean", F.round("mean", 6))


@query("""SELECT o_orderpriority, sum(work) AS total_duration, sum(wall) AS wall_time, sum(n)::BIGINT AS n_tasks, count(*) AS n_waves, round(sum(work) / sum(wall), 9) AS parallel_efficiency, round(100.0 * sum(ok) / sum(n), 9) AS success_rate
FROM (SELECT o_orderpriority, l_orderkey, max(l_quantity) AS wall, sum(l_quantity) AS work, count(*) AS n, count(*) FILTER (l_returnflag <> 'R') AS ok FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY o_orderpriority""")
def ref_wave_metrics(t):
    """D7, D10"""
    rows = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")
    out = A.wave_metrics(rows, "l_orderkey", "l_quantity", F.col("l_returnflag") != "R", ["o_orderpriority"])
    return out.withColumns({c: F.round(c, 9) for c in ("parallel_efficiency", "success_rate")})


@query("SELECT count(*) AS distinct_files, sum(n - 1)::BIGINT AS duplicate_edits FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)")
def ref_file_edits(t):
    """D8"""
    return A.file_edits(t.lineitem, "l_partkey")


@query("SELECT l_partkey, count(*) AS n_tasks, array_to_string(list_slice(list_sort(list(l_suppkey)), 1, 5), ',') AS tasks FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) GROUP BY 1 HAVING count(*) >= 2")
def ref_conflicts(t):
    """D9"""
    return A.conflicts(t.lineitem, "l_partkey", "l_suppkey", 5).withColumn("tasks", F.array_join("tasks", ","))


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ROLLUP (p_brand, p_type)")
def ref_group_subgroup(t):
    """D11, D12"""
    return A.group_subgroup(t.part, "p_brand", "p_type")


@query("SELECT count(*) AS n, CASE WHEN bool_or(event_type = 'error') THEN 'warning' ELSE 'success' END AS status, floor(100.0 * count(*) FILTER (value > 20) / count(*) + 0.5)::BIGINT AS integrity_score FROM events")
def ref_issue_report(t):
    """D13, D24"""
    return A.issue_report(t.events, F.when(F.col("event_type") == "error", "medium"), F.col("value") > 20)


@query("SELECT coalesce(code, 'UNKNOWN') AS code, priority, CASE priority WHEN 'high' THEN 2 WHEN 'low' THEN 4 END AS priority_rank, count(*) AS n FROM (SELECT nullif(event_type, 'view') AS code, CASE WHEN event_type = 'error' THEN 'high' ELSE 'low' END AS priority FROM events) GROUP BY ALL")
def ref_errors_by_code(t):
    """D14"""
    rows = t.events.select(F.nullif("event_type", F.lit("view")).alias("c"), F.when(F.col("event_type") == "error", "high").alias("p"))
    return A.errors_by_code(rows, "c", F.col("p"))


_LINKS = "SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link FROM pages"


@query(f"SELECT link, sum(k)::BIGINT AS n_links, count(*) AS n_sources, array_to_string(list_slice(list_sort(list(page_id)), 1, 10), ',') AS sources FROM (SELECT link, page_id, count(*) AS k FROM ({_LINKS}) GROUP BY ALL) GROUP BY link")
def ref_links_report(t):
    """D15"""
    found = L.links(t.pages, "page_id", "html", 'href="([^"]+)"')
    return A.links_report(found, "page_id", "link", 10).withColumn("sources", F.array_join("sources", ","))


@query("SELECT link, page_id, CASE WHEN k.r IS NOT NULL AND NOT soon THEN 'ok' WHEN k.r IS NOT NULL THEN 'marked-but-there' WHEN soon THEN 'expected-missing' ELSE 'broken' END AS state, count(*) AS n "
       f"FROM (SELECT *, link LIKE '/t%' AS soon FROM ({_LINKS})) l LEFT JOIN (SELECT unnest(['/in', '/the', '/ä']) AS r) k ON k.r = l.link GROUP BY ALL")  # fmt: skip
def ref_link_state(t):
    """C8"""
    found = L.links(t.pages, "page_id", "html", 'href="([^"]+)"')
    known = t.spark.createDataFrame([("/in",), ("/the",), ("/ä",)], "p string")
    return L.link_state(found, known, "link", "p", F.col("link").startswith("/t")).groupBy("link", "page_id", "state").count().withColumnRenamed("count", "n")


@query("SELECT count(*) AS requests, round(sum(l_quantity) / sum(l_linenumber), 9) AS average_wait, round(100 * (1 - sum((l_returnflag = 'R')::INT) / count(*)), 9) AS success_rate FROM lineitem")
def ref_rate_metrics(t):
    """D17"""
    out = A.rate_metrics(t.lineitem, F.col("l_quantity"), F.col("l_linenumber"), (F.col("l_returnflag") == "R").cast("int"))
    return out.withColumns({c: F.round(c, 9) for c in ("average_wait", "success_rate")})


@query("""SELECT o_custkey, n, completed, failed, pending, 100.0 * completed / n AS percent_complete, CASE WHEN failed > 0 THEN 'FAILED' WHEN completed = n THEN 'COMPLETED' WHEN pending = n THEN 'PENDING' ELSE 'IN_PROGRESS' END AS status
FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS completed, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderstatus = 'O') AS pending FROM orders GROUP BY 1)""")
def ref_progress(t):
    """D18, D31"""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").when(F.col("o_orderstatus") == "O", "pending")
    return A.progress(t.orders, ["o_custkey"], status)


@query("SELECT sequence, count(*) AS n, round(avg(r), 6) AS mean_rate, count(*) FILTER (r >= 0.8) AS good FROM (SELECT event_type AS sequence, user_id, avg((value > 5)::DOUBLE) AS r FROM events GROUP BY ALL) GROUP BY sequence")
def ref_pattern_stats(t):
    """D19, D28, D29"""
    per = t.events.groupBy(F.col("event_type").alias("sequence"), "user_id").agg(F.avg((F.col("value") > 5).cast("double")).alias("r"))
    return A.pattern_stats(per, ["sequence"], F.col("r")).select("sequence", "n", F.round("mean_rate", 6).alias("mean_rate"), "good")


@query("SELECT count(*) AS n, count(o.k) AS n_covered, count(o.k) / count(*) AS coverage FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON c_custkey = o.k")
def ref_coverage(t):
    """D20"""
    return A.coverage(t.customer, t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT s AS score, missing, CASE WHEN s >= 90 THEN 'A' WHEN s >= 75 THEN 'B' WHEN s >= 60 THEN 'C' WHEN s >= 45 THEN 'D' ELSE 'F' END AS grade FROM (
SELECT 100.0 * sum(CASE WHEN f.status = 'ok' THEN w * CASE WHEN f.stale THEN 0.5 ELSE 1 END ELSE 0 END) / sum(w) AS s, count(*) FILTER (f.status IS NULL) AS missing
FROM (VALUES ('click', 30), ('view', 30), ('purchase', 20), ('refund', 10), ('error', 10)) r(name, w) LEFT JOIN
(SELECT event_type AS name, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'ok' END AS status, event_type = 'purchase' AS stale FROM events GROUP BY 1) f USING (name))""")
def ref_rubric_score(t):
    """C12, D21"""
    rubric = t.spark.createDataFrame([("click", 30, True), ("view", 30, True), ("purchase", 20, True), ("refund", 10, True), ("error", 10, True), ("signup", 10, False)], "name string, weight int, expected boolean")
    found = t.events.select(F.col("event_type").alias("name")).distinct().select("name", F.when(F.col("name") == "error", "bad").otherwise("ok").alias("status"), (F.col("name") == "purchase").alias("stale"))
    return A.rubric_score(rubric, found)


@query("SELECT CASE WHEN event_type = 'error' THEN 'bad' WHEN value < 1 THEN 'empty' WHEN value > 50 THEN 'degraded' ELSE 'healthy' END AS state, count(*) AS n FROM events GROUP BY 1")
def ref_health(t):
    """D22, D23"""
    status = F.when(F.col("event_type") == "error", "bad").otherwise("ok")
    return A.health(t.events, status, F.col("value"), F.when(F.col("value") < 1, 0).otherwise(1), 50)


@query("""SELECT doc_id, CASE WHEN greatest(a, b) = 0 THEN 'general' WHEN a >= b THEN 'legal' ELSE 'shop' END AS class, greatest(a, b) AS hits FROM (SELECT doc_id,
contains(lower(text), 'rights')::INT + contains(lower(text), 'license')::INT AS a, contains(lower(text), 'price')::INT + contains(lower(text), 'the')::INT AS b FROM documents)""")
def ref_arg_max_class(t):
    """D27"""
    return A.arg_max_class(t.documents, "doc_id", F.col("text"), {"legal": ["rights", "license"], "shop": ["price", "the"]})


@query("SELECT o_custkey, floor(n + 0.5 * coalesce(e, 0) + 2 * hard + 0.5)::BIGINT AS complexity FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS hard FROM orders GROUP BY 1) LEFT JOIN (SELECT o_custkey, count(*) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) USING (o_custkey)")
def ref_complexity(t):
    """D25"""
    edges = t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return A.complexity(t.orders, edges, "o_custkey", F.col("o_orderstatus") == "P")


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 3")
def ref_latest(t):
    """E1, E8, L2"""
    return O.latest(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id")], 3).select("event_id", "user_id")


@query("""WITH e AS (SELECT *, lead(event_type, 1) OVER w AS b, lead(event_type, 2) OVER w AS c, lead(event_type, 3) OVER w AS d FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT s AS sequence, count(*) AS occurrences FROM (SELECT event_type || '>' || b || '>' || c AS s FROM e UNION ALL SELECT event_type || '>' || b || '>' || c || '>' || d FROM e) WHERE s IS NOT NULL AND contains(s, 'purchase') GROUP BY s""")
def ref_ngrams(t):
    """E2"""
    return O.ngrams(t.events, ["user_id"], ["ts", "event_id"], "event_type", (3, 4), ["purchase"]).withColumn("sequence", F.array_join("sequence", ">"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, doc_id % 50 = 0 AS safe, sum(ceil(length(coalesce(text, '')) / 4)) OVER (PARTITION BY source ORDER BY CASE WHEN doc_id % 50 = 0 THEN 0 ELSE 1 END, doc_id) AS s FROM documents) WHERE safe OR s <= 8000")
def ref_token_budget(t):
    """E3, E9, H14"""
    docs = t.documents.select("doc_id", "source", X.token_estimate(F.col("text")).alias("tokens"))
    return O.within_budget(docs, ["source"], [F.col("doc_id")], F.col("tokens"), 8000, F.col("doc_id") % 50 == 0).select("doc_id", "source")


@query("SELECT event_id, gap_seconds FROM (SELECT event_id, epoch_us(ts - lag(ts) OVER w) / 1e6 AS gap_seconds, lag(event_type) OVER w AS was FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE gap_seconds > 86400 AND coalesce(was <> 'signup', true)")
def ref_gaps(t):
    """E4"""
    return O.gaps(t.events, ["user_id"], "ts", "event_id", 86400, F.col("event_type"), "signup").select("event_id", "gap_seconds")


@query("SELECT event_id FROM (SELECT event_id, event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS same FROM events) WHERE same")
def ref_repeats(t):
    """E5"""
    return O.repeats(t.events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id")


@query("""SELECT conv_id, turn, last_value(x IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS previous_other FROM (
SELECT *, CASE WHEN role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) THEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) END AS x FROM conversations)""")
def ref_previous_other(t):
    """E10"""
    return O.previous_other(t.conversations, ["conv_id"], ["turn", "role", "text"], "role").select("conv_id", "turn", "previous_other")


@query("SELECT c_custkey, c_acctbal AS score FROM customer WHERE c_acctbal >= 0.4 ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def ref_top(t):
    """F1, F11"""
    return O.top(t.customer, F.col("c_acctbal"), [F.col("c_custkey")]).select("c_custkey", "score")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS ord FROM orders")
def ref_severity_order(t):
    """F3"""
    return t.orders.select("o_orderkey", O.severity_order(F.col("o_orderpriority"), ("1-URGENT", "2-HIGH")).alias("ord"))


@query("SELECT p_partkey FROM part ORDER BY p_name, p_partkey LIMIT 10 OFFSET 10")
def ref_page(t):
    """F2, F5"""
    return O.page(t.part, [O.by_locale(F.col("p_name")), F.col("p_partkey")], 2, 10)[0].select("p_partkey")


@query("SELECT s_suppkey FROM (SELECT s_suppkey, s_nationkey < 3 AS safe, row_number() OVER (ORDER BY CASE WHEN s_nationkey < 3 THEN 0 ELSE 1 END, s_acctbal, s_suppkey) AS rn FROM supplier) WHERE safe OR rn <= 8")
def ref_prune(t):
    """F6"""
    return O.prune(t.supplier, 8, [F.col("s_acctbal"), F.col("s_suppkey")], F.col("s_nationkey") < 3).select("s_suppkey")


_TOKENS = r"SELECT doc_id, unnest(regexp_extract_all(regexp_replace(lower(text), '[A-Za-z0-9_]*[0-9_][A-Za-z0-9_]*', ' ', 'g'), '[a-z]+')) AS word FROM documents"


@query(f"SELECT word, count(*) AS n FROM ({_TOKENS}) GROUP BY word ORDER BY n DESC, min(doc_id), word LIMIT 10")
def ref_top_words(t):
    """F7, H13"""
    per = t.documents.select("doc_id", F.posexplode(X.words(F.col("text"))).alias("at", "word"))
    return per.groupBy("word").agg(F.count("*").alias("n"), F.min("doc_id").alias("d")).orderBy(F.col("n").desc(), "d", "word").limit(10).drop("d")


@query("SELECT p_partkey, (CASE WHEN contains(lower(p_name), 'be') THEN 8 ELSE 0 END + CASE WHEN contains(lower(p_type), 'be') THEN 5 ELSE 0 END)::DOUBLE AS score FROM part WHERE score >= 1 ORDER BY score DESC, p_partkey LIMIT 20")
def ref_field_search(t):
    """F9"""
    score = O.field_score("BE", {"p_name": 8.0, "p_type": 5.0}, {"p_name": F.col("p_name"), "p_type": F.col("p_type")})
    return O.top(t.part, score, [F.col("p_partkey")], 20, 1.0).select("p_partkey", "score")


@query("SELECT p_partkey, p_brand, rank, CASE WHEN rank <= 3 THEN 'primary' ELSE 'secondary' END AS tier FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 5")
def ref_ranked_areas(t):
    """F8"""
    return O.ranked_areas(t.part, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")]).select("p_partkey", "p_brand", "rank", "tier")


@query("SELECT DISTINCT unnest([p_brand, p_type]) AS tag FROM part")
def ref_distinct_tags(t):
    """F10, G2"""
    return O.distinct_items(t.part.select(F.array("p_brand", "p_type").alias("tags")), "tags", "tag")


@query("SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4)::BIGINT AS chunk FROM orders")
def ref_chunks(t):
    """H23"""
    return O.chunks(t.orders, ["o_custkey"], ["o_orderkey"], 4).select("o_orderkey", "chunk")


_OLD = "SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 7 <> 0"
_NEW = "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN upper(sha256(text)) WHEN doc_id % 11 = 0 THEN 'x' ELSE sha256(text) END AS h FROM documents WHERE doc_id % 8 <> 0"


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two states of a catalogue made from the documents: some keys and digests differ."""
    h = t.documents.select("doc_id", F.sha2("text", 256).alias("h"))
    n = F.col("doc_id")
    new = F.when(n % 5 == 0, F.lit(None)).when(n % 3 == 0, F.upper("h")).when(n % 11 == 0, "x").otherwise(F.col("h"))
    return h.filter(n % 7 != 0), h.filter(n % 8 != 0).withColumn("h", new)


def _diff_sql(fold: str) -> str:
    return f"SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'removed' WHEN coalesce({fold}(o.h) = {fold}(n.h), false) THEN 'unchanged' ELSE 'modified' END AS state FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.doc_id = n.doc_id"


@query(_diff_sql("lower"))
def ref_snapshot_diff(t):
    """C1"""
    return J.snapshot_diff(*_snapshots(t), "doc_id", "h")


@query(_diff_sql(""))
def ref_snapshot_validate(t):
    """C2, C15"""
    return J.snapshot_diff(*_snapshots(t), "doc_id", "h", ignore_case=False)


@query(f"SELECT d.doc_id, CASE WHEN d.state = 'modified' AND d.doc_id % 2 = 0 THEN 'user-modified' ELSE d.state END AS state FROM ({_diff_sql('lower')}) d")
def ref_upgrade_report(t):
    """Files on disk were edited where the key is even."""
    old, new = _snapshots(t)
    disk = old.withColumn("h", F.when(F.col("doc_id") % 2 == 0, "edited").otherwise(F.col("h")))
    return J.upgrade_report(new, old, disk, "doc_id", "h")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def ref_missing_from(t):
    """C3, C5, C14, G1"""
    return J.missing_from(t.customer, t.orders, "c_custkey", "o_custkey").select("c_custkey")


@query("SELECT s_suppkey, array_to_string(list_sort(list(r)), ',') AS orphans FROM (SELECT s_suppkey, unnest([s_suppkey + 1, s_suppkey + 7]) AS r FROM supplier) WHERE r NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def ref_orphans(t):
    """C4"""
    rows = t.supplier.select("s_suppkey", F.array(F.col("s_suppkey") + 1, F.col("s_suppkey") + 7).alias("refs"))
    return J.orphan_references(rows, "s_suppkey", "refs").withColumn("orphans", F.array_join("orphans", ","))


@query("SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS used_by FROM lineitem GROUP BY 1")
def ref_inverse_edges(t):
    """C6, C16"""
    return J.inverse_edges(t.lineitem, "l_partkey", "l_suppkey").withColumn("used_by", F.array_join("used_by", ","))


@query("""SELECT coalesce(e.k, t.k) AS k, CASE WHEN e.k IS NULL THEN t.v ELSE e.v END AS v, CASE WHEN e.k IS NULL THEN 'added' WHEN t.k IS NOT NULL AND e.v IS DISTINCT FROM t.v THEN 'conflict' ELSE 'preserved' END AS outcome,
CASE WHEN e.k IS NOT NULL AND t.k IS NOT NULL AND e.v IS DISTINCT FROM t.v THEN t.v END AS suggestion FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0) e
FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'OTHER' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 5 <> 0) t ON e.k = t.k""")
def ref_keyed_merge(t):
    """C9"""
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    other = c.filter("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 4 == 0, "OTHER").otherwise(F.col("v")))
    return J.keyed_merge(c.filter("k % 3 <> 0"), other, "k", "v")


@query("SELECT prefix, rule, n, CASE rule WHEN 'required' THEN n > 0 ELSE n = 0 END AS ok FROM (SELECT prefix, rule, count(*) FILTER (starts_with(p_type, prefix)) AS n FROM part, (VALUES ('STANDARD', 'required'), ('NOTHING', 'required'), ('PROMO', 'forbidden')) r(prefix, rule) GROUP BY ALL)")
def ref_path_sets(t):
    """C11"""
    return J.path_sets(t.part, "p_type", ["STANDARD", "NOTHING"], ["PROMO"])


@query("SELECT user_id, et1 = et2 AS same_agent, abs(epoch_us(t1) - epoch_us(t2)) <= 6e8 AS close, (et1 = et2)::INT + (abs(epoch_us(t1) - epoch_us(t2)) <= 6e8)::INT AS score FROM (SELECT user_id, arg_min(event_type, event_id) AS et1, arg_max(event_type, event_id) AS et2, arg_min(ts, event_id) AS t1, arg_max(ts, event_id) AS t2 FROM events GROUP BY 1)")
def ref_consistency(t):
    """C13"""
    first = t.events.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("agent"), F.min_by("ts", "event_id").alias("at"))
    last = t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("agent"), F.max_by("ts", "event_id").alias("at"))
    return J.consistency(first, last, "user_id", "agent", "at")


@query("SELECT sequence, sum(n)::BIGINT AS occurrences, round(sum(r * n) / sum(n), 9) AS success_rate FROM (SELECT event_type AS sequence, user_id % 2 AS h, count(*) AS n, avg((value > 5)::DOUBLE) AS r FROM events GROUP BY ALL) GROUP BY 1")
def ref_upsert_patterns(t):
    """L1"""
    per = t.events.groupBy(F.col("event_type").alias("sequence"), (F.col("user_id") % 2).alias("h")).agg(F.count("*").alias("occurrences"), F.avg((F.col("value") > 5).cast("double")).alias("success_rate"))
    return J.upsert_patterns(per.filter("h = 0"), per.filter("h = 1")).withColumn("success_rate", F.round("success_rate", 9))


@query("""WITH l AS (SELECT 1 AS l, 'n' || n_nationkey AS k, n_name AS v FROM nation UNION ALL SELECT 2, 'n' || n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE lower(n_name) END FROM nation WHERE n_nationkey % 2 = 0)
SELECT k AS path, arg_max(coalesce(v, chr(0)), l) AS value FROM l GROUP BY k HAVING arg_max(coalesce(v, chr(0)), l) <> chr(0)""")
def ref_deep_merge(t):
    """A second layer replaces every other value and deletes every fourth."""
    base = t.nation.select(F.lit(1).alias("layer"), F.concat(F.lit("n"), "n_nationkey").alias("path"), F.col("n_name").alias("value"), F.lit(False).alias("is_delete"), F.lit(False).alias("is_append"))
    over = t.nation.filter("n_nationkey % 2 = 0").select(F.lit(2).alias("layer"), F.concat(F.lit("n"), "n_nationkey").alias("path"), F.lower("n_name").alias("value"), (F.col("n_nationkey") % 4 == 0).alias("is_delete"), F.lit(False).alias("is_append"))
    return J.deep_merge(base.unionByName(over))


@query("""WITH RECURSIVE e AS (SELECT 's' || s_suppkey AS src, 'n' || s_nationkey AS dst FROM supplier UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem),
b AS (SELECT src AS id, 1 AS depth FROM e WHERE dst = 'r1' UNION SELECT e.src, b.depth + 1 FROM b JOIN e ON e.dst = b.id)
SELECT 'r1' AS origin, id, min(depth) AS depth FROM b GROUP BY id""")
def ref_impact(t):
    """I1"""
    edge = lambda a, x, b, y: F.struct(F.concat(F.lit(a), x).alias("src"), F.concat(F.lit(b), y).alias("dst")).alias("e")
    edges = t.supplier.select(edge("s", "s_suppkey", "n", "s_nationkey")).unionByName(t.nation.select(edge("n", "n_nationkey", "r", "n_regionkey"))).unionByName(t.lineitem.select(edge("p", "l_partkey", "s", "l_suppkey"))).select("e.*").distinct()
    return G.impact(edges, t.spark.createDataFrame([("r1",)], "id string"))


@query("SELECT src, dst, 'dst' AS missing FROM (SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem WHERE l_suppkey % 4 = 0)")
def ref_dangling_edges(t):
    """Every fourth supplier is taken out of the nodes."""
    edges = t.lineitem.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"))
    nodes = t.supplier.filter("s_suppkey % 4 <> 0").select(F.concat(F.lit("s"), "s_suppkey").alias("id")).unionByName(t.part.select(F.concat(F.lit("p"), "p_partkey").alias("id")))
    return G.dangling_edges(nodes, edges)


@query("SELECT p_partkey, levenshtein(p_name, 'green') AS d FROM part")
def ref_levenshtein(t):
    """H1"""
    return t.part.select("p_partkey", F.levenshtein("p_name", F.lit("green")).alias("d"))


@query("""SELECT p_partkey, CASE WHEN v = q THEN 100.0 WHEN contains(v, q) THEN floor(85 + 14 * length(q) / m) WHEN near >= 0.5 THEN floor(84 * near) ELSE 0 END::DOUBLE AS score
FROM (SELECT p_partkey, lower(p_type) AS v, 'steel' AS q, greatest(length(p_type), 5, 1) AS m, 1 - levenshtein(lower(p_type), 'steel') / greatest(length(p_type), 5, 1) AS near FROM part)""")
def ref_fuzzy_score(t):
    """H2, H3"""
    return t.part.select("p_partkey", X.fuzzy_score(F.col("p_type"), "Steel").alias("score"))


@query("SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS similarity FROM embeddings")
def ref_cosine(t):
    """H4"""
    one = t.embeddings.filter("vec_id = 0").select(F.col("embedding").alias("q"))
    return t.embeddings.join(F.broadcast(one)).select("vec_id", F.round(S.cosine(F.col("embedding"), F.col("q")), 6).alias("similarity"))


@query("SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) AS j FROM (SELECT p_partkey, string_split(p_type, ' ') AS a, ['STEEL', 'PROMO'] AS b FROM part)")
def ref_jaccard(t):
    """H5, H6"""
    return t.part.select("p_partkey", F.round(S.jaccard(F.split("p_type", " "), F.array(F.lit("STEEL"), F.lit("PROMO"))), 9).alias("j"))


@query("""SELECT doc_id, array_to_string(list_slice(list_distinct_ordered, 1, 15), ' ') AS keywords FROM (SELECT doc_id, list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: list_position(w, x[1]) = x[2]), lambda x: x[1]) AS list_distinct_ordered
FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: length(x) >= 3 AND x NOT IN ('and', 'are', 'for', 'from', 'has', 'have', 'that', 'the', 'this', 'was', 'were', 'will', 'with', 'you', 'your')) AS w FROM documents))""")
def ref_keywords(t):
    """H7"""
    return t.documents.select("doc_id", F.array_join(X.keywords(F.col("text")), " ").alias("keywords"))


@query(r"""SELECT doc_id, length(text) AS chars, length(regexp_replace(text, '\s+', '', 'g')) AS chars_no_space, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n_words,
len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: regexp_matches(x, '\S'))) AS n_sentences, len(list_filter(regexp_split_to_array(text, '\n\n+'), lambda x: regexp_matches(x, '\S'))) AS n_paragraphs FROM documents""")
def ref_text_stats(t):
    """H12"""
    s = X.text_stats(F.col("text"))
    return t.documents.select("doc_id", *(s[k].alias(k) for k in ("chars", "chars_no_space", "n_words", "n_sentences", "n_paragraphs")))


@query("SELECT doc_id, sha256(text) AS digest, ceil(length(text) / 4)::BIGINT AS tokens4, ceil(length(text) / 3.5)::BIGINT AS tokens35 FROM documents")
def ref_checksum_tokens(t):
    """H11, H14, H30"""
    return t.documents.select("doc_id", F.substring_index(X.checksum(F.col("text")), ":", -1).alias("digest"), X.token_estimate(F.col("text")).alias("tokens4"), X.token_estimate(F.col("text"), 3.5).alias("tokens35"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_type || ' #' || p_brand), '[^a-z0-9_\s-]', '', 'g'), '[\s_-]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 7) || '…' ELSE p_name END AS short FROM part")
def ref_slug_truncate(t):
    """H15, H16"""
    return t.part.select("p_partkey", X.slugify(F.concat("p_type", F.lit(" #"), "p_brand")).alias("slug"), X.ellipsis(F.col("p_name"), 8).alias("short"))


@query("SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS d FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS s FROM orders)")
def ref_duration(t):
    """H21"""
    return t.orders.select("o_orderkey", X.duration_text(F.col("o_totalprice")).alias("d"))


@query("SELECT p_partkey, CASE WHEN p_size // 10 > 2 OR (p_size // 10 = 2 AND p_size % 10 > 5) THEN 1 WHEN p_size // 10 = 2 AND p_size % 10 = 5 THEN 0 ELSE -1 END AS c, 2 > p_size // 10 AS breaking FROM part")
def ref_version_compare(t):
    """H17, H18"""
    v = F.concat(F.lit("v"), F.floor(F.col("p_size") / 10).cast("string"), F.lit("."), (F.col("p_size") % 10).cast("string"))
    return t.part.select("p_partkey", S.version_compare(v, F.lit("2.5.0")).alias("c"), S.is_breaking(v, F.lit("2.0")).alias("breaking"))


@query("SELECT event_id, 'user ' || user_id || ' did ' || event_type AS message FROM events")
def ref_interpolate(t):
    """H19, H20"""
    text = F.concat(F.lit("user "), "user_id", F.lit(" ${verb} ${what:-"), "event_type", F.lit("}${none}"))
    return t.events.select("event_id", X.interpolate(text, {"verb": "did"}).alias("message"))


@query("SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2000-01-01')::DOUBLE AS days, least(60000.0, 1000.0 * pow(2, o_orderkey % 9)) AS delay FROM (SELECT o_orderkey, date_trunc('day', o_orderdate) AS o_orderdate FROM orders)")
def ref_days_delay(t):
    """H22, H24"""
    day = F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00")
    return t.orders.select("o_orderkey", S.days_since(day, F.lit("2000-01-01").cast("timestamp")).alias("days"), S.retry_delay(F.col("o_orderkey") % 9 + 1, F.lit(None).cast("double")).alias("delay"))


@query("SELECT event_id, round(a, 6) AS score, CASE WHEN a > 0.7 THEN 'HOT' WHEN a >= 0.3 THEN 'WARM' ELSE 'COLD' END AS tier FROM (SELECT event_id, 1.5 * exp(-0.1 * (user_id % 20)) * (1 - 1 / (2 + (event_id % 50))) * 0.9 AS a FROM events)")
def ref_attention(t):
    """H25"""
    a = S.attention(F.lit(1.5), F.col("user_id") % 20, F.col("event_id") % 50, F.lit(0.9))
    return t.events.select("event_id", F.round(a, 6).alias("score"), S.attention_tier(a).alias("tier"))


@query(r"SELECT doc_id, line_no, rule, match FROM (SELECT doc_id, i AS line_no, rule, unnest(regexp_extract_all(l[i], p)) AS match FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)), (VALUES ('number', '[0-9]{3,}'), ('shout', '!!+')) r(rule, p))")
def ref_findings(t):
    """H26"""
    return L.findings(L.lines(t.documents, "doc_id", "text"), "doc_id", {"number": "[0-9]{3,}", "shout": "!!+"})


@query("SELECT event_id, coalesce(props->>'missing', props->>'k') AS payload FROM events")
def ref_payload(t):
    """H33"""
    return t.events.select("event_id", S.payload(F.col("props"), ["$.missing", "$.k"]).alias("payload"))


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 6000 THEN 'FRESH' WHEN c_acctbal >= 4000 THEN 'MODERATE' WHEN c_acctbal >= 2500 THEN 'DEPLETED' ELSE 'CRITICAL' END AS bracket, greatest(0.0, 100 - c_custkey * 1500.0 / 200000 * 100) AS percent FROM customer")
def ref_bracket(t):
    """B14, B15"""
    return t.customer.select("c_custkey", S.bracket(F.col("c_acctbal") / 100).alias("bracket"), S.context_percent(F.col("c_custkey")).alias("percent"))


@query("""SELECT p_partkey, CASE WHEN r >= 0.9 THEN 'REUSE' WHEN ok THEN 'ADAPT' ELSE 'CREATE' END AS action, CASE WHEN r >= 0.9 OR (ok AND r >= 0.8) THEN 'high' WHEN r >= 0.6 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT p_partkey, p_size / 50.0 AS r, p_size / 50.0 >= 0.6 AND (p_partkey % 10) / 10.0 >= 0.6 AND (p_partkey % 7) / 10.0 < 0.3 AS ok FROM part)""")
def ref_decision(t):
    """B16"""
    d = S.decision(F.col("p_size") / 50.0, (F.col("p_partkey") % 10) / 10.0, (F.col("p_partkey") % 7) / 10.0)
    return t.part.select("p_partkey", d["action"].alias("action"), d["confidence"].alias("confidence"))


@query("""SELECT c_custkey, CASE WHEN n >= 3 THEN 'promotion-candidate' WHEN n >= 1 THEN 'monitoring' ELSE 'deprecation-review' END AS promotion, CASE WHEN n <= 4 THEN 'LOW' WHEN n <= 15 THEN 'MEDIUM' ELSE 'HIGH' END AS risk,
CASE WHEN n BETWEEN 1 AND 3 THEN 'full' WHEN n BETWEEN 4 AND 6 OR (n >= 7 AND c_custkey % 2 = 0) THEN 'files' ELSE 'metadata' END AS detail FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)""")
def ref_levels(t):
    """B17, B18, B24"""
    n = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))
    c = F.col("n")
    return n.select("c_custkey", S.promotion(c, F.lit(90)).alias("promotion"), S.risk(c).alias("risk"), S.detail_level(c, F.col("c_custkey") % 2 == 0).alias("detail"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '/en/') THEN 'english' WHEN regexp_matches(url, '[.]html') THEN 'static' ELSE 'other' END AS kind, CASE WHEN event IN ('read', 'grep') THEN 'read' ELSE 'execute' END AS op FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'grep' ELSE 'zap' END AS event FROM pages)")
def ref_path_rules(t):
    """B11-B13, B19-B20, B26"""
    tool = F.when(F.col("page_id") % 3 == 0, "Read").when(F.col("page_id") % 3 == 1, "grep").otherwise("zap")
    return t.pages.select("page_id", S.first_match(F.col("url"), [("/en/", "english"), ("[.]html", "static")], "other").alias("kind"), S.operation_class(tool).alias("op"))


@query("SELECT event_id FROM events WHERE (value > 20 AND event_type = 'click') OR event_type IN ('signup', 'purchase')")
def ref_condition(t):
    """B6, B9"""
    cond = C.compile_condition("(value > 20 AND event_type == 'click') OR event_type IN rare OR missing > 0", t.events.columns, {"rare": ["signup", "purchase"]})
    return t.events.filter(cond).select("event_id")


@query("SELECT event_id, array_to_string(list_filter([CASE WHEN value < 5 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'failed' END], lambda x: x IS NOT NULL), ',') AS errors FROM events")
def ref_checks(t):
    """B8, B21"""
    rules = {"low": F.col("value") < 5, "failed": C.condition_object(F.col("event_type"), "equals", "error")}
    return t.events.select("event_id", F.array_join(C.checks(rules), ",").alias("errors"))


@query("SELECT p_partkey FROM part WHERE lower(p_brand) = 'brand#11' OR (contains(lower(p_type), 'steel') AND list_has_all(string_split(p_type, ' '), ['PROMO', 'STEEL']))")
def ref_filters(t):
    """B1-B5"""
    tags = F.split("p_type", " ")
    both = C.contains_fold(F.col("p_type"), "Steel") & C.all_tags(tags, ["PROMO", "STEEL"]) & C.any_keyword(tags, ["steel", "tin"])
    return t.part.filter(C.equals_fold(F.col("p_brand"), "BRAND#11") | both).select("p_partkey")


@query("SELECT page_id FROM pages WHERE contains(lower(html), 'license') OR contains(lower(html), 'a+b')")
def ref_contains_any(t):
    """B10, B25"""
    return t.pages.filter(X.contains_any(F.col("html"), ["License", "a+b", " "])).select("page_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' OR starts_with(o_orderpriority, '1-')")
def ref_wildcard(t):
    """B22"""
    name = F.concat_ws(".", F.substring("o_orderpriority", 1, 1), F.substring("o_orderpriority", 3, 20))
    return t.orders.filter(X.wildcard(name, ["5.LOW", "1.*"])).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_size / 50.0 >= 0.8")
def ref_duplicate_gate(t):
    """B27"""
    return t.part.filter(C.duplicate_gate(F.col("p_size") / 50.0)).select("p_partkey")


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def ref_retained(t):
    """J5, J6"""
    last = t.events.agg(F.max("ts").alias("__as_of"))
    return R.retained(t.events.join(F.broadcast(last)), "ts", F.col("__as_of"), 7).select("event_id", "user_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'")
def ref_change_feed(t):
    """The last change of each user; an error counts as removal."""
    changes = t.events.select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_type") == "error", "unlink").otherwise("change").alias("action"))
    state = t.spark.createDataFrame([], "user_id long, event_id long, event_type string")
    return R.apply_changes(state, changes, "user_id", "at")


@query("SELECT o_orderkey FROM orders LEFT JOIN (SELECT o_custkey AS k, max(o_orderdate) AS last FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) ON o_custkey = k WHERE last IS NULL OR o_orderdate > last")
def ref_changed_since(t):
    """J3"""
    return R.changed_since(t.orders, t.orders.filter("o_orderkey % 2 = 0").select("o_custkey", F.col("o_orderdate").alias("synced")), "o_custkey", "o_orderdate", "synced").select("o_orderkey")


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT user_id, event_id, rn, true AS allowed, 3 AS remaining, [t] AS times FROM e WHERE rn = 1 UNION ALL
SELECT user_id, event_id, rn, len(h) < 3, greatest(3 - len(h), 0)::INTEGER, CASE WHEN len(h) < 3 THEN list_append(h, t) ELSE h END
FROM (SELECT e.*, list_filter(s.times, lambda x: x > e.t - 86400) AS h FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1))
SELECT user_id, event_id, allowed, remaining FROM s""")
def ref_rate_limit(t):
    """An exact replay, a fold over earlier rejections."""
    return R.rate_limited(t.events, "user_id", "ts", "event_id", 86400.0, 3)


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, event_type = 'error' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT user_id, event_id, rn, 'CLOSED' AS state, f::INTEGER AS bad, 0::DOUBLE AS since FROM e WHERE rn = 1 UNION ALL
SELECT user_id, event_id, rn, CASE WHEN was = 'OPEN' THEN 'OPEN' WHEN f AND (was = 'HALF_OPEN' OR bad + 1 >= 2) THEN 'OPEN' WHEN f THEN was ELSE 'CLOSED' END,
CASE WHEN was = 'OPEN' THEN bad WHEN f THEN bad + 1 ELSE 0 END, CASE WHEN was <> 'OPEN' AND f AND (was = 'HALF_OPEN' OR bad + 1 >= 2) THEN t ELSE since END
FROM (SELECT e.*, s.bad, s.since, CASE WHEN s.state = 'OPEN' AND e.t - s.since >= 86400 THEN 'HALF_OPEN' ELSE s.state END AS was FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1))
SELECT user_id, event_id, state FROM s""")
def ref_breaker(t):
    """A state machine over the calls of each key."""
    return R.breaker_states(t.events, "user_id", "ts", "event_id", "event_type = 'error'", 2, 86400.0)


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def ext_pricing_summary(t):
    rows = t.lineitem.filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def ext_star_join(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY CUBE (p_brand, p_type)")
def ext_cube(t):
    return t.part.cube("p_brand", "p_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, rank() OVER w AS rnk, dense_rank() OVER w AS dense, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS quarter FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)")
def ext_ranks(t):
    w = W.partitionBy("o_custkey").orderBy("o_orderpriority")
    return t.orders.select("o_orderkey", F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("dense"), F.ntile(4).over(W.partitionBy("o_custkey").orderBy("o_orderkey")).alias("quarter"))


@query("(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1")
def ext_set_operations(t):
    both = t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))
    return both.subtract(t.nation.filter("n_regionkey = 1").select("n_nationkey"))


@query("SELECT e.event_id, max(p.ts) AS last_purchase FROM events e LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts GROUP BY e.event_id")
def ext_as_of_join(t):
    """The last purchase up to each event: a running maximum per user, so no pairs are made."""
    w = W.partitionBy("user_id").orderBy("ts").rangeBetween(W.unboundedPreceding, 0)
    return t.events.select("event_id", F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).over(w).alias("last_purchase"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ext_tumbling_window(t):
    return R.windowed_counts(t.events, "ts", "event_type", "1 hour")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(coalesce((ts > was + INTERVAL 6 HOUR)::INT, 1)) OVER (PARTITION BY user_id ORDER BY ts) AS s
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS was FROM events)) GROUP BY user_id, s""")
def ext_session_window(t):
    return t.events.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


@query("SELECT event_type, count(DISTINCT user_id) AS users, true AS close FROM events GROUP BY event_type")
def ext_approx_distinct(t):
    """The sketch beside the exact count: close if within three times its stated standard error of 2 percent."""
    out = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("about"))
    return out.select("event_type", "users", (F.abs(F.col("about") - F.col("users")) <= 0.06 * F.col("users")).alias("close"))
