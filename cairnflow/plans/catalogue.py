"""Queries over sources, sinks and text formats, each beside its DuckDB SQL.

The driver's tables hold no manifests, settings or logs, so these are written from them, as files below the
shared folder or as texts, and read back by the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import conditions as C
from ..operators import joins as J
from ..operators import ordered as O
from ..session import fresh_path
from ..sources import files as FS
from ..sources import lines as L
from ..sources import yamls as Y
from ..streaming import feeds as R
from .base import query


def _text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


@query("SELECT 'folder=r' || n_regionkey AS folder, sum(strlen(n_name) + 1)::BIGINT AS length FROM nation WHERE n_regionkey <> 0 GROUP BY 1")
def ref_scan_files(t):
    """A1-A3: a text file per region, without those of region 0."""
    path = fresh_path(t.spark, "scan")
    t.nation.select(_text("r", F.col("n_regionkey")).alias("folder"), "n_name").repartition("folder").write.partitionBy("folder").text(path)
    found = FS.scan_files(t.spark, path, exclude=["folder=r0/"], extensions=["TXT"], most_depth=2)
    return found.select(F.split("relative", "/")[0].alias("folder"), "length")


@query("SELECT p_brand AS file, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::INTEGER - 1 AS item, p_partkey::VARCHAR AS id, p_name AS path, CASE WHEN p_size % 3 <> 0 THEN p_type END AS kind FROM part")
def ref_yaml_manifest(t):
    """A4, A10: a manifest per brand, written as YAML and read back."""
    rows = t.part.select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("id"), F.col("p_name").alias("path"), F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("kind"))
    texts = Y.yaml_text(rows, "file", "id", ["id", "path", "kind"], "files", "Install manifest\nDo not edit")
    return Y.yaml_items(Y.yaml_paths(texts, "file", "text"), "file", "files", ["id", "path", "kind"])


@query("SELECT p_brand AS category, 'p' || p_partkey AS id, p_name AS path, 'part' AS type, p_type || ': #' || p_size AS purpose, p_type || ',k' || p_size AS keywords FROM part")
def ref_registry(t):
    """A5: a registry kept as nested YAML, one file per brand."""
    entity = _text("    p", F.col("p_partkey"), ":\n      path: ", F.col("p_name"), "  # where\n      type: part\n      purpose: '", F.col("p_type"), ": #", F.col("p_size"), "'\n      keywords:\n        - ", F.col("p_type"), "\n        - k", F.col("p_size"), "\n")
    texts = t.part.groupBy("p_brand").agg(_text("version: 1\nentities:\n  '", F.col("p_brand"), "':\n", F.array_join(F.collect_list(entity), "")).alias("text"))
    found = Y.registry_rows(Y.yaml_paths(texts, "p_brand", "text"), "p_brand")
    return found.select("category", "id", "path", "type", "purpose", F.array_join("keywords", ",").alias("keywords"))


@query("""SELECT c_nationkey AS file, 'K' || c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN 'last' ELSE c_mktsegment || '=x' END AS value,
CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 <> 0 THEN 'about ' || c_custkey END AS comment FROM customer""")
def ref_env_file(t):
    """Settings of each nation; some keys are set twice, some comments stand apart."""
    k = F.col("c_custkey")
    entry = _text("# about ", k, "\n", F.when(k % 3 == 0, "\n").otherwise(""), "K", k, " = ", F.col("c_mktsegment"), "=x\n", F.when(k % 5 == 0, _text("K", k, "=last\n")).otherwise(""))
    texts = t.customer.groupBy(F.col("c_nationkey").alias("file")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", entry.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return L.env_entries(L.lines(texts, "file", "text")).drop("line_no")


@query("""SELECT n_nationkey AS file, section, CASE section WHEN 1 THEN n_name WHEN 2 THEN 'm' WHEN 4 THEN 'sub' ELSE '' END AS title, CASE section WHEN 1 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS level, a AS first_line,
CASE WHEN odd AND section = 2 THEN 9 ELSE b END AS last_line, section = 2 AS managed, section = 2 AND odd AS unclosed
FROM (SELECT *, n_nationkey % 4 = 0 AS odd FROM nation), (VALUES (0, 1, 1), (1, 2, 3), (2, 4, 6), (3, 7, 7), (4, 8, 9)) s(section, a, b) WHERE NOT odd OR section <= 2""")
def ref_markdown_sections(t):
    """Preamble, headers, a managed section, which in some files is never closed."""
    end = F.when(F.col("n_nationkey") % 4 == 0, "still inside").otherwise("<!-- managed:end m -->")
    texts = t.nation.select(F.col("n_nationkey").alias("file"), _text("intro\n# ", F.col("n_name"), "\nbody\n<!-- managed:start m -->\n# inside\n", end, "\ntail\n## sub ##\nx").alias("text"))
    return L.markdown_sections(L.lines(texts, "file", "text"))


@query("SELECT 'user/' || user_id AS path, count(*) AS n FROM events WHERE event_type = 'click' AND contains('user/' || user_id, 'user/1') GROUP BY 1")
def ref_audit_log(t):
    """Events emitted as JSON lines, read back and asked; a log that is not there has no rows."""
    path = fresh_path(t.spark, "audit")
    FS.write_json(t.events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("action"), _text("user/", F.col("user_id")).alias("path")), path)
    log = FS.read_json_lines(t.spark, path).unionByName(FS.read_json_lines(t.spark, f"{path}-none"))
    return FS.query_audit(log, "click", "user/1").groupBy("path").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey::VARCHAR AS id, c_name || ',"' || c_mktsegment || '" x' AS label, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer""")
def ref_csv_round_trip(t):
    """Quotes, commas and empty fields written and read back."""
    path, columns = fresh_path(t.spark, "csv"), ["id", "label", "segment"]
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).otherwise(F.when(F.col("c_custkey") % 2 == 0, ""))
    FS.write_csv(t.customer.select(F.col("c_custkey").cast("string").alias("id"), _text(F.col("c_name"), ',"', F.col("c_mktsegment"), '" x').alias("label"), segment.alias("segment")), path, columns)
    return FS.read_csv(t.spark, path, columns, required=["id"])


@query("SELECT '| ' || r_regionkey || ' | ' || r_name || ' |' AS line FROM region UNION ALL VALUES ('| r_regionkey | r_name |'), ('| --- | --- |')")
def ref_report(t):
    """The Markdown half of a report, replaced whole."""
    stem = fresh_path(t.spark, "report")
    FS.replace_file(t.spark, f"{stem}.md", "old")
    FS.report_pair(t.region.select("r_regionkey", "r_name").orderBy("r_regionkey"), stem)
    return t.spark.read.text(f"{stem}.md").withColumnRenamed("value", "line")


@query("""SELECT 'count' AS kind, count(*)::VARCHAR AS text FROM region UNION ALL SELECT 'tree', string_agg(r_regionkey || chr(10) || '  ' || r_name, chr(10) ORDER BY r_regionkey) FROM region
UNION ALL SELECT 'yaml', string_agg('- r_regionkey: ' || r_regionkey || chr(10) || '  r_name: "' || r_name || '"' || chr(10), '' ORDER BY r_regionkey) FROM region
UNION ALL SELECT 'json', '[' || chr(10) || string_agg('  {' || chr(10) || '    "r_regionkey": ' || r_regionkey || ',' || chr(10) || '    "r_name": "' || r_name || '"' || chr(10) || '  }', ',' || chr(10) ORDER BY r_regionkey) || chr(10) || ']' FROM region
UNION ALL SELECT 'table', 'r_regionkey  r_name' || chr(10) || string_agg(rpad(r_regionkey::VARCHAR, 11, ' ') || '  ' || r_name, chr(10) ORDER BY r_regionkey) FROM region""")
def ref_formats(t):
    """One small result in every format."""
    rows = t.region.select("r_regionkey", "r_name").orderBy("r_regionkey")
    return t.spark.createDataFrame([(kind, L.formatted(rows, kind)) for kind in ("count", *L.REPORTERS)], "kind string, text string")


@query("SELECT ts::DATE::VARCHAR AS date, count(*) AS n FROM events GROUP BY 1")
def ref_dated_log(t):
    """A log in folders per day."""
    path = fresh_path(t.spark, "log")
    FS.write_dated(t.events.select("event_id", "ts"), path, "ts")
    log = t.spark.read.schema("event_id long, date string").json(path)
    return log.groupBy("date").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' ORDER BY o_orderkey LIMIT 50")
def ref_select_text(t):
    """Emitted text with named parameters, run by the engine; the limit is part of the statement."""
    text, args = C.select_text("orders", ["o_orderkey", "o_custkey"], {"o_orderstatus": "F", "o_orderpriority": "5-LOW"}, "o_orderkey", 50)
    return t.spark.sql(text.replace("FROM orders", "FROM {orders}"), args=args, orders=t.orders)


@query("SELECT o_orderkey, o_orderkey % 4 >= 2 AS allowed FROM orders")
def ref_statement_guard(t):
    """A16."""
    sql = F.element_at(F.array(*map(F.lit, ("DROP TABLE x", " create index", "SELECT 1", "delete from y"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", C.statement_allowed(sql).alias("allowed"))


@query("SELECT n_nationkey, 'name' AS path, n_name AS value FROM nation WHERE n_nationkey % 5 <> 0")
def ref_yaml_block(t):
    """YAML in a code block, in front matter, or not at all."""
    n = F.col("n_nationkey")
    text = F.when(n % 5 == 0, "no: block").when(n % 2 == 0, _text("# T\n```yaml\nname: ", F.col("n_name"), "\n```\n")).otherwise(_text("---\nname: ", F.col("n_name"), "\n---\nbody"))
    return Y.yaml_paths(t.nation.select("n_nationkey", Y.yaml_block(text).alias("y")), "n_nationkey", "y").drop("line_no")


@query("SELECT event_type AS type, count(*) AS n, 4::BIGINT AS backups FROM events GROUP BY 1")
def ref_rotated_log(t):
    """A log that is moved away whenever it has grown too large; nothing is lost on the way."""
    log, backups = fresh_path(t.spark, "log"), fresh_path(t.spark, "backups")
    for part in range(4):
        t.events.filter(F.pmod("event_id", F.lit(4)) == part).select("event_id", "event_type").coalesce(1).write.mode("append").json(log)
        FS.rotate(t.spark, log, backups, most_bytes=1000)
    kept = t.spark.read.schema("event_id long, event_type string").json(f"{backups}/*").withColumn("file", F.regexp_extract(F.input_file_name(), r"/(\d+)-log", 1))
    return kept.groupBy(F.col("event_type").alias("type")).agg(F.count("*").alias("n"), F.count_distinct("file").alias("backups"))


@query("""SELECT printf('%07x', o_orderkey) AS id, CASE WHEN k < 2 THEN lower(left(o_orderstatus, 1)) || 'ix' END AS kind, CASE WHEN k = 1 THEN o_custkey::VARCHAR END AS scope, k = 1 AS breaking,
CASE WHEN k < 2 THEN o_orderpriority ELSE 'order ' || o_orderpriority END AS message FROM (SELECT *, o_orderkey % 4 AS k FROM orders) WHERE k < 3""")
def ref_commit_rows(t):
    """Log lines of a command as rows; lines of other kinds are left out."""
    k, ident = F.col("o_orderkey") % 4, F.format_string("%07x", "o_orderkey")
    kind = _text(F.lower(F.substring("o_orderstatus", 1, 1)), "ix")
    line = F.when(k == 0, _text(ident, " ", kind, ": ", F.col("o_orderpriority"))).when(k == 1, _text(ident, " ", kind, "(", F.col("o_custkey"), ")!: ", F.col("o_orderpriority"))).when(k == 2, _text(ident, " order ", F.col("o_orderpriority"))).otherwise("fatal: no log")
    return FS.commits(t.orders.select(line.alias("text"))).drop("subject")


@query("""SELECT CASE k WHEN 0 THEN 'M' WHEN 3 THEN 'R' WHEN 2 THEN '?' ELSE '' END AS staged, CASE k WHEN 1 THEN 'M' WHEN 2 THEN '?' ELSE '' END AS unstaged, 'f' || o_orderkey AS path, CASE k WHEN 3 THEN 'old' END AS old_path
FROM (SELECT o_orderkey, o_orderkey % 5 AS k FROM orders) WHERE k < 4""")
def ref_command_rows(t):
    """Status lines of a command as rows."""
    k, f = F.col("o_orderkey") % 5, _text("f", F.col("o_orderkey"))
    line = F.when(k == 0, _text("M  ", f)).when(k == 1, _text(" M ", f)).when(k == 2, _text("?? ", f)).when(k == 3, _text("R  old -> ", f)).otherwise("fatal")
    return FS.porcelain(t.orders.select(line.alias("text")))


@query("SELECT c_custkey, coalesce(CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END, length(c_mktsegment) > 9) AS exceeds FROM customer")
def ref_scope(t):
    """B7."""
    flag = F.when(F.col("c_custkey") % 3 == 0, True).when(F.col("c_custkey") % 3 == 1, False)
    return t.customer.select("c_custkey", C.scope_exceeds(flag, F.col("c_mktsegment"), F.lit("furniture")).alias("exceeds"))


@query("SELECT p_partkey, CASE WHEN s >= 0.5 THEN 'CRITICAL' WHEN s >= 0.3 THEN 'HIGH' WHEN s >= 0.1 THEN 'MEDIUM' WHEN s > 0 THEN 'LOW' ELSE 'NONE' END AS risk FROM (SELECT p_partkey, (p_size - 1) / 49.0 AS s FROM part)")
def ref_impact_risk(t):
    """B23."""
    return t.part.select("p_partkey", S.impact_risk((F.col("p_size") - 1) / F.lit(49.0)).alias("risk"))


@query("""SELECT p_partkey, round(r, 9) AS relevance, r >= 0.5 AS blocked FROM (SELECT p_partkey, 0.6 * len(list_intersect([lower(p_type), 's' || p_size], ['steel', 's7', 'promo'])) / 3
+ 0.4 * len(list_intersect(w, ['small', 'green', 'box'])) / len(list_distinct(list_concat(w, ['small', 'green', 'box']))) AS r FROM (SELECT *, string_split(lower(p_name), ' ') AS w FROM part))""")
def ref_relevance(t):
    """H8, B27."""
    own = F.array("p_type", _text("S", F.col("p_size")))
    r = X.relevance(own, F.col("p_name"), F.array(*map(F.lit, ("steel", "S7", "promo", "PROMO"))), F.lit("Small green box"))
    return t.part.select("p_partkey", F.round(r, 9).alias("relevance"), C.duplicate_gate(r, 0.5).alias("blocked"))


@query("""SELECT n_name AS section, CASE WHEN e AND NOT (m AND i) THEN 'old ' ELSE 'new ' END || n_name AS body, NOT e AS added, n_nationkey AS at
FROM (SELECT *, n_nationkey % 3 <> 0 AS e, n_nationkey % 2 = 0 AS i, n_nationkey % 4 = 0 AS m FROM nation) WHERE e OR i""")
def ref_section_merge(t):
    """C10."""
    n = t.nation.select(F.col("n_name").alias("section"), F.col("n_nationkey").alias("at"))
    old = n.filter("at % 3 <> 0").withColumn("body", _text("old ", F.col("section")))
    new = n.filter("at % 2 = 0").withColumns({"body": _text("new ", F.col("section")), "managed": F.col("at") % 4 == 0})
    return J.section_merge(old, new, "section", "at", "body", "managed").select("section", "body", "order.added", "order.at")


@query("""SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS critical, count(*) FILTER (event_type = 'refund') AS high, 0::BIGINT AS medium, count(*) FILTER (event_type NOT IN ('error', 'refund')) AS low,
count(*) FILTER (value > 20) AS auto_healable, 100.0 * count(*) FILTER (value > 20) / count(*) AS rate FROM events""")
def ref_heal_summary(t):
    """D16."""
    severity = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "refund", "high").otherwise("low")
    return A.heal_summary(t.events, severity, F.col("value") > 20)


@query("SELECT event_type AS severity, count(*) AS n FROM events WHERE user_id % 4 IN (1, 2, 3) GROUP BY 1")
def ref_issues_by_severity(t):
    """D32."""
    status = F.element_at(F.array(*map(F.lit, ("pass", "fail", "warning", "error"))), (F.col("user_id") % 4 + 1).cast("int"))
    return A.issues_by_severity(t.events, status, F.col("event_type"))


@query("SELECT CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 'unknown' ELSE p_brand END AS domain, count(*) AS n FROM part GROUP BY 1")
def ref_by_domain(t):
    """D26."""
    return A.by_domain(t.part, F.when(F.col("p_size") % 5 == 0, F.lit(None)).when(F.col("p_size") % 7 == 0, "").otherwise(F.col("p_brand")))


@query("""SELECT l_orderkey, round(tests, 9) AS tests, round(criteria, 9) AS criteria, round(30 * tests + 70 * criteria, 7) AS overall FROM (SELECT l_orderkey, coalesce(count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') / nullif(count(*) FILTER (l_returnflag = 'A'), 0), 1.0) AS tests,
count(*) FILTER (l_quantity > 10) / count(*) AS criteria FROM lineitem GROUP BY 1)""")
def ref_delivery_confidence(t):
    """Weights ours."""
    parts = {"tests": (F.col("l_returnflag") == "A", F.col("l_linestatus") == "F", 3.0), "criteria": (F.lit(True), F.col("l_quantity") > 10, 7.0)}
    out = A.delivery_confidence(t.lineitem, ["l_orderkey"], parts)
    return out.select("l_orderkey", F.round("tests", 9).alias("tests"), F.round("criteria", 9).alias("criteria"), F.round("overall", 7).alias("overall"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def ref_newest_first(t):
    """the newest entry of each index."""
    return O.latest(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, NULL FROM supplier")
def ref_concatenated(t):
    """G3."""
    return J.concatenated(t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")), t.supplier.select(F.col("s_name").alias("name")))


@query("SELECT 'n' || n_nationkey || '.list' AS path, CASE WHEN n_nationkey % 3 = 0 THEN lower(n_name) ELSE n_name END || CASE WHEN n_nationkey % 2 = 0 THEN ',x,y' ELSE '' END AS value FROM nation")
def ref_array_merge(t):
    """A layer that replaces, one that appends."""
    layer = lambda k, rows, value, append: rows.select(F.lit(k).alias("layer"), _text("n", F.col("n_nationkey"), ".list").alias("path"), value.alias("value"), F.lit(False).alias("is_delete"), F.lit(append).alias("is_append"))
    even = t.nation.filter("n_nationkey % 2 = 0")
    layers = [layer(1, t.nation, F.col("n_name"), False), layer(2, t.nation.filter("n_nationkey % 3 = 0"), F.lower("n_name"), False), layer(3, even, F.lit("x"), True), layer(4, even, F.lit("y"), True)]
    return J.deep_merge(J.concatenated(*layers))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_brand ELSE p_brand || ',' || p_type || CASE WHEN p_name IN (p_brand, p_type) THEN '' ELSE ',' || p_name END END AS items FROM part""")
def ref_ordered_union(t):
    """G6."""
    more = F.when(F.col("p_size") % 4 != 0, F.array("p_type", "p_brand", "p_name"))
    return t.part.select("p_partkey", F.array_join(J.ordered_union(F.array("p_brand", "p_brand"), more), ",").alias("items"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type || ' things' ELSE 'Part ' || p_name END AS purpose, 'tool' || p_size || ',b' || p_size AS dependencies, 'src/x' || p_partkey || '.js' AS paths,
CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'Fix ' || p_name || ' now' END AS title FROM part""")
def ref_text_extract(t):
    """H9, H10, H31, H34."""
    size = F.col("p_size")
    text = _text("# Part ", F.col("p_name"), "\n", F.when(size % 2 == 0, _text("## Purpose\n\n", F.col("p_type"), " things\n")).otherwise(""), "const a = require('./lib/tool", size, ".js');\n- b", size, ".md\n- self.md\nimport x from 'react'\nwrote src/x", F.col("p_partkey"), ".js\nsee `src/x", F.col("p_partkey"), ".js`\n")
    said = F.when(size % 3 == 0, "*help").otherwise(_text(" Fix ", F.col("p_name"), " now "))
    return t.part.select("p_partkey", X.purpose(text, F.lit("p")).alias("purpose"), F.array_join(X.dependencies(text, F.lit("self")), ",").alias("dependencies"), F.array_join(X.paths_in(text), ",").alias("paths"), X.title(said).alias("title"))


@query("SELECT o_orderkey, TIMESTAMP '2025-01-15 05:00:00' + INTERVAL 1 MINUTE * (o_orderkey % 1440) AS at FROM orders")
def ref_zoned(t):
    """Clock times of a winter day in New York."""
    minute = F.col("o_orderkey") % 1440
    clock = F.format_string("%02d:%02d", F.floor(minute / 60).cast("int"), (minute % 60).cast("int"))
    return t.orders.select("o_orderkey", S.zoned("2025-01-15", clock, "America/New_York").alias("at"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'Sheet ' || n_nationkey END AS sheet, 'A' AS first_col, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey + 1 END AS first_row, 'B' AS last_col, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey + 9 END AS last_row FROM nation")
def ref_sheet_range(t):
    """H32."""
    n = F.col("n_nationkey")
    row = lambda k: F.when(n % 3 > 0, (n + k).cast("string")).otherwise("")
    text = _text(F.when(n % 2 == 0, _text("'Sheet ", n, "'!")).otherwise(""), "A", row(1), ":B", row(9))
    return t.nation.select("n_nationkey", X.sheet_range(text).alias("r")).select("n_nationkey", "r.*")


@query("SELECT c_custkey, 'from:' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' subject:\"a ' || c_mktsegment || '\"' ELSE '' END AS q FROM customer")
def ref_filter_text(t):
    """H27."""
    subject = F.when(F.col("c_custkey") % 2 == 0, _text("a ", F.col("c_mktsegment")))
    return t.customer.select("c_custkey", X.filter_text({"from": F.col("c_name"), "subject": subject, "label": F.lit("")}).alias("q"))


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'keyed' WHEN 1 THEN 'sections' WHEN 2 THEN 'deep' WHEN 3 THEN 'replace' ELSE 'replace' END AS strategy FROM part")
def ref_merge_strategy(t):
    """K3."""
    name = F.element_at(F.array(*map(F.lit, ("cfg/.env", "docs/a.MD", "x/settings.yaml", "run.js", "dir.md/plain"))), (F.col("p_size") % 5 + 1).cast("int"))
    return t.part.select("p_partkey", J.strategy_of(name).alias("strategy"))


@query("SELECT event_id, value >= 5 AND event_type <> 'error' AS valid, array_to_string(list_filter([CASE WHEN value < 5 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'failed' END], lambda x: x IS NOT NULL), ',') AS errors FROM events")
def ref_validated(t):
    """K2."""
    v = C.validated({"low": F.col("value") < 5, "failed": F.col("event_type") == "error"})
    return t.events.select("event_id", v["valid"].alias("valid"), F.array_join(v["errors"], ",").alias("errors"))


@query("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS completed, arg_max(o_orderstatus, o_orderkey) AS last FROM orders GROUP BY 1")
def ref_checkpoints(t):
    """L3."""
    return A.checkpoints(t.orders, ["o_custkey"], "o_orderstatus", "o_orderkey")


@query("SELECT l_partkey, l_suppkey FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) QUALIFY count(*) OVER (PARTITION BY l_partkey) >= 2")
def ref_conflict_rows(t):
    """Every task of every file in conflict."""
    return A.conflict_rows(t.lineitem, "l_partkey", "l_suppkey")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'")
def ref_stream_upsert(t) -> DataFrame:
    """J1, J2 as a stream: change files are read as they come and kept as state; an error counts as removal."""
    feed, state, log = (fresh_path(t.spark, n) for n in ("feed", "state", "progress"))
    at = F.struct("ts", "event_id").alias("at")
    changes = t.events.select("user_id", "event_id", "event_type", at, F.when(F.col("event_type") == "error", "unlink").otherwise("change").alias("action"))
    changes.write.parquet(feed)
    stream = R.parquet_feed(t.spark, feed, changes.schema, files_per_trigger=1000)
    run = stream.writeStream.foreachBatch(R.upsert_sink(state, "user_id", "at")).option("checkpointLocation", log).trigger(availableNow=True).start()
    run.awaitTermination()
    return R.read_state(t.spark, state).select("user_id", "event_id", "event_type")
