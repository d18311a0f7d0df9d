"""The pinned examples of the inventory on tiny tables."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cairnflow.functions import scalar as S
from cairnflow.functions import text as X
from cairnflow.operators import aggregates as A
from cairnflow.operators import conditions as C
from cairnflow.operators import graph as G
from cairnflow.operators import joins as J
from cairnflow.operators import ordered as O
from cairnflow.sources import files as Fi
from cairnflow.sources import lines as L
from cairnflow.sources import yamls as Y
from cairnflow.streaming import feeds as R


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_pass_rate_and_mean(spark):
    rows = spark.createDataFrame([(1, True, 1000), (1, True, 2000), (1, True, 3000), (1, False, 2000)], "layer int, passed boolean, ms int")
    r = A.run_stats(rows, ["layer"], F.col("passed"), F.col("ms"), F.col("ms")).first()
    assert (r.total_runs, r.pass_rate, r.avg_duration) == (4, 0.75, 2000)


def test_nearest_rank(spark):
    rows = spark.createDataFrame([(float(v),) for v in [*range(1, 11), -1]], "v double")
    r = A.stats_report(rows, "v").first()
    assert (r.p50, r.p95, r.p99, r.n, r.errors) == (5.0, 10.0, 10.0, 10, 1)
    assert A.stats_report(rows.filter("v > 99"), "v").first().p50 == 0


def test_waves(spark):
    rows = spark.createDataFrame([(1, 1000, True), (1, 2000, True)], "w int, d int, ok boolean")
    r = A.wave_metrics(rows, "w", "d", F.col("ok")).first()
    assert (r.total_duration, r.wall_time, r.parallel_efficiency, r.success_rate) == (3000, 2000, 1.5, 100)
    assert A.wave_metrics(rows.filter("d < 0"), "w", "d", F.col("ok")).first().success_rate == 100


def test_file_edits_and_conflicts(spark):
    rows = spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t2", "b"), ("t2", "c")], "task string, file string")
    assert tuple(A.file_edits(rows, "file").first()) == (3, 1)
    assert [tuple(r) for r in A.conflicts(rows, "file", "task").collect()] == [("b", 2, ["t1", "t2"])]


def test_bins(spark):
    for v, want in ((60.0, "FRESH"), (59.99, "MODERATE"), (40.0, "MODERATE"), (39.99, "DEPLETED"), (25.0, "DEPLETED"), (24.99, "CRITICAL"), (float("nan"), "CRITICAL"), (101.0, "FRESH"), (-1.0, "CRITICAL")):
        assert one(spark, S.bracket(F.lit(v))) == want


@pytest.mark.parametrize("r, a, i, want", [(0.9, 0.5, 0.5, "REUSE"), (0.6, 0.6, 0.29, "ADAPT"), (0.6, 0.8, 0.35, "CREATE"), (0.59, 0.8, 0.1, "CREATE")])
def test_decision(spark, r, a, i, want):
    assert one(spark, S.decision(F.lit(r), F.lit(a), F.lit(i)))["action"] == want


def test_text_functions(spark):
    assert one(spark, X.fuzzy_score(F.lit("json"), "JSON")) == 100
    assert one(spark, X.fuzzy_score(F.lit("json-tool"), "json")) >= 85
    assert one(spark, X.fuzzy_score(F.lit("zzzz"), "json")) == 0
    assert one(spark, X.words(F.lit("café the naïve x1"))) == ["caf", "the", "na", "ve"] or one(spark, X.words(F.lit("The end"))) == ["the", "end"]
    assert one(spark, X.slugify(F.lit("  Hello, World_x  -- y "))) == "hello-world-x-y"
    assert one(spark, X.ellipsis(F.lit("abcdef"), 4)) == "abc…"
    assert one(spark, X.ellipsis(F.lit(None).cast("string"), 4)) == ""
    assert one(spark, X.token_estimate(F.lit("abcde"))) == 2
    assert [one(spark, X.duration_text(F.lit(s))) for s in (9000, 330, 45)] == ["2h 30m", "5m 30s", "45s"]
    assert one(spark, X.interpolate(F.lit("a ${X} ${Y:-d} ${Z}!"), {"X": "1"})) == "a 1 d !"
    assert one(spark, X.missing_names(F.lit("${X} ${Z}"), {"X": "1"})) == ["Z"]
    assert one(spark, X.checksum(F.lit("a\r\nb"))) == one(spark, X.checksum(F.lit("a\nb")))
    assert one(spark, X.sheet_range(F.lit("'My Sheet'!A1:B2"))).asDict() == {"sheet": "My Sheet", "first_col": "A", "first_row": 1, "last_col": "B", "last_row": 2}
    assert one(spark, X.title(F.lit("*help me"))) is None and one(spark, X.title(F.lit("word"))) is None
    assert one(spark, X.title(F.lit("fix " + "word " * 20))).startswith("fix word")
    assert one(spark, X.dependencies(F.lit("const a = require('./lib/tool.js');\n- other.md\nimport x from 'react'"))) == ["tool", "other"]
    assert one(spark, X.paths_in(F.lit("wrote src/a.js and `b/c.md`"))) == ["b/c.md", "src/a.js"]
    assert one(spark, X.purpose(F.lit("# T\n## Purpose\nDo it\n"), F.lit("p"))) == "Do it"
    assert one(spark, X.wildcard(F.lit("pro.squads.x"), ["pro.squads.*"])) and not one(spark, X.wildcard(F.lit("prox"), ["pro.*"]))


def test_versions(spark):
    assert one(spark, S.version_compare(F.lit("v1.10.0"), F.lit("1.9"))) == 1
    assert one(spark, S.version_compare(F.lit("1.0"), F.lit("v1.0.0"))) == 0
    assert one(spark, S.is_breaking(F.lit("1.9.9"), F.lit("2.0.0")))


def test_vectors(spark):
    a = F.array(F.lit(1.0), F.lit(0.0))
    assert one(spark, S.cosine(a, a)) == 1.0 and one(spark, S.cosine(a, F.array(F.lit(0.0), F.lit(1.0)))) == 0.0


def test_conditions(spark):
    rows = spark.createDataFrame([(5, "HIGH", None), (None, "LOW", True)], "n int, risk string, flag boolean")
    run = lambda text, **k: [r.risk for r in rows.filter(C.compile_condition(text, rows.columns, **k)).collect()]
    assert run("n > 3") == ["HIGH"] and run("n <= 0") == ["LOW"] and run("absent == 0") == ["HIGH", "LOW"]
    assert run("risk IN bad OR flag", lists={"bad": ["HIGH"]}) == ["HIGH", "LOW"] and run("flag") == ["LOW"]
    assert run("${n} > 3 AND (risk == 'HIGH' OR flag == true)") == ["HIGH"]
    with pytest.raises(C.ConditionError):
        C.compile_condition("n >", rows.columns)
    assert C.select_text("t", ["a"], {"b": 1}, "a", 5) == ("SELECT a FROM t WHERE b = :b ORDER BY a LIMIT 5", {"b": 1})
    with pytest.raises(ValueError):
        C.select_text("t; drop")
    assert [one(spark, C.statement_allowed(F.lit(s))) for s in ("drop table x", "Create y", "select 1", "delete from x")] == [False, False, True, True]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("a", "H"), ("b", None), ("c", "x")], "k string, h string")
    new = spark.createDataFrame([("a", "h"), ("b", None), ("d", "x")], "k string, h string")
    assert {tuple(r) for r in J.snapshot_diff(old, new, "k", "h").collect()} == {("a", "unchanged"), ("b", "modified"), ("c", "removed"), ("d", "new")}


def test_pattern_upsert(spark):
    row = lambda rate: spark.createDataFrame([(["a", "b"], 1, rate)], "sequence array<string>, occurrences long, success_rate double")
    assert tuple(J.upsert_patterns(row(1.0), row(0.5)).first())[1:] == (2, 0.75)


def test_deep_merge(spark):
    def merged(*rows):
        df = spark.createDataFrame([(*r, *[False] * (5 - len(r))) for r in rows], "layer int, path string, value string, is_delete boolean, is_append boolean")
        return {r.path: r.value for r in J.deep_merge(df).collect()}

    assert merged((1, "a.x", "1"), (1, "a.y", "2"), (2, "a.x", None, True)) == {"a.y": "2"}
    assert merged((1, "a.x", "1"), (2, "a", "5")) == {"a": "5"}
    assert merged((1, "a", "5"), (2, "a.x", "1")) == {"a.x": "1"}
    assert merged((1, "k", "1"), (2, "k", "2", False, True)) == {"k": "1,2"}
    assert merged((1, "k", "1"), (2, "k", "2"), (3, "k", "3", False, True)) == {"k": "2,3"}


def test_impact_with_cycle(spark):
    edges = spark.createDataFrame([("create", "engine"), ("po", "create"), ("sm", "create"), ("engine", "po")], "src string, dst string")
    found = G.impact(edges, spark.createDataFrame([("engine",)], "id string"))
    r = G.impact_summary(found, 5).first()
    assert (r.direct, r.indirect) == (1, 2)


def test_impact_reaches_all_levels(spark):
    edges = spark.createDataFrame([(f"v{i + 1}", f"v{i}") for i in range(23)], "src string, dst string")
    found = G.impact(edges, spark.createDataFrame([("v0",)], "id string"))
    assert {(r.id, r.depth) for r in found.collect()} == {(f"v{i}", i) for i in range(1, 24)}


def test_ordered(spark):
    rows = spark.createDataFrame([(i, "abcab"[i]) for i in range(5)], "i int, x string").withColumn("g", F.lit(1))
    grams = {tuple(r.sequence): r.occurrences for r in O.ngrams(rows, ["g"], ["i"], "x").collect()}
    assert grams == {tuple("abc"): 1, tuple("bca"): 1, tuple("cab"): 1, tuple("abca"): 1, tuple("bcab"): 1}
    page, facts = O.page(spark.range(50), [F.col("id")], 2, 10)
    assert [r.id for r in page.collect()] == list(range(10, 20)) and (facts["start"], facts["end"], facts["total_pages"]) == (11, 20, 5)
    assert O.page(spark.range(0), [F.col("id")], 1, 10)[1]["total_pages"] == 0
    assert O.prune(spark.range(8), 5, [F.col("id")], F.lit(False)).count() == 5
    assert [r.chunk for r in O.chunks(spark.range(5).withColumn("g", F.lit(1)), ["g"], ["id"], 2).orderBy("id").collect()] == [0, 0, 1, 1, 2]


def test_rubric(spark):
    rubric = spark.createDataFrame([("a", 50, True), ("b", 50, True), ("c", 10, False)], "name string, weight int, expected boolean")
    found = spark.createDataFrame([("a", "ok", False), ("b", "ok", True)], "name string, status string, stale boolean")
    r = A.rubric_score(rubric, found).first()
    assert (r.score, r.missing, r.grade) == (75.0, 0, "B")


def test_env_and_markdown(spark):
    text = "# note\nA=1\n\nB=x=y\nA=2\n"
    rows = L.lines(spark.createDataFrame([("f", text)], "file string, t string"), "file", "t")
    assert {r.key: (r.value, r.comment) for r in L.env_entries(rows).collect()} == {"A": ("2", None), "B": ("x=y", None)}
    text = "intro\n# One\na\n<!-- managed:start x -->\n# inside\n<!-- managed:end x -->\n## Two\nb\n<!-- managed:start y -->\nz"
    rows = L.lines(spark.createDataFrame([("f", text)], "file string, t string"), "file", "t")
    got = [(r.title, r.level, r.first_line, r.last_line, r.managed, r.unclosed) for r in L.markdown_sections(rows).orderBy("section").collect()]
    assert got == [("", 0, 1, 1, False, False), ("One", 1, 2, 3, False, False), ("x", 0, 4, 6, True, False), ("Two", 2, 7, 8, False, False), ("y", 0, 9, 10, True, True)]
    assert L.parse_flat_yaml("a: 1\nb:\n  - x\n  - y\n") == {"a": "1", "b": ["x", "y"]} and L.parse_flat_yaml("][") is None


def test_files(spark, tmp_path):
    assert Fi.read_json_lines(spark, str(tmp_path / "none")).count() == 0
    assert Fi.read_registry(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "r.jsonl").write_text(json.dumps({"category": "task", "id": "a"}) + "\n")
    assert Fi.read_registry(spark, str(tmp_path / "r.jsonl")).first().id == "a"
    (tmp_path / "bad.jsonl").write_text("{nope\n")
    with pytest.raises(Exception, match="Failed to parse registry"):
        Fi.read_registry(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "x.csv").write_text('a,b\n"1,2","say ""hi"""\n3,\n')
    assert [tuple(r) for r in Fi.read_csv(spark, str(tmp_path / "x.csv"), ["a", "b"]).collect()] == [("1,2", 'say "hi"'), ("3", "")]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "y.MD").write_text("hi")
    assert [r.relative for r in Fi.scan_files(spark, str(tmp_path), ["bad"], ["md"]).collect()] == ["sub/y.MD"]
    j, m = Fi.report_pair(spark.range(2), str(tmp_path / "rep"))
    assert json.load(open(j)) == [{"id": 0}, {"id": 1}] and "| id |" in open(m).read()
    assert L.formatted(spark.range(1), "json") and L.formatted(spark.range(3), "count") == "3"


def test_change_feed_and_limits(spark, tmp_path):
    state = spark.createDataFrame([("a", ["b", "c"]), ("b", [])], "id string, used_by array<string>")
    changes = spark.createDataFrame([("b", "change", 1), ("b", "unlink", 2), ("c", "add", 1)], "id string, action string, at int")
    assert {r.id: r.used_by for r in R.apply_changes(state, changes, "id", "at").collect()} == {"a": ["c"], "c": []}
    rows = spark.createDataFrame([(1, i, datetime(2024, 1, 1, 0, 0, s)) for i, s in enumerate((0, 1, 2, 3, 11))], "k int, i int, at timestamp")
    got = [(r.allowed, r.remaining) for r in R.rate_limited(rows, "k", "at", "i", 10, 3).orderBy("i").collect()]
    assert got == [(True, 3), (True, 2), (True, 1), (False, 0), (True, 2)]
    calls = spark.createDataFrame([(1, i, datetime(2024, 1, 1, 0, m), f) for i, (m, f) in enumerate(((0, True), (0, True), (0, False), (2, False)))], "k int, i int, at timestamp, failed boolean")
    assert [r.state for r in R.breaker_states(calls, "k", "at", "i", "failed", 2, 60).orderBy("i").collect()] == ["CLOSED", "OPEN", "OPEN", "CLOSED"]
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "1.json").write_text('{"id": "a", "action": "add", "at": 1}\n{"id": "b", "action": "add", "at": 1}\n')
    feed = R.json_feed(spark, str(folder), "id string, action string, at long")
    q = feed.writeStream.foreachBatch(R.upsert_sink(str(tmp_path / "state"), "id", "at")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.id for r in R.read_state(spark, str(tmp_path / "state"), 0).collect()} == {"a", "b"}


def test_impact_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"v{i + 1}", f"v{i}") for i in range(40)], "src string, dst string")
    start = spark.createDataFrame([("v0",)], "id string")
    assert G.impact(edges, start).count() == 40 and G.impact(edges, start, most_depth=3).count() == 3


def test_interpolation_is_done_once(spark):
    values = {"A": "${B}", "B": "b", "a.b": "dot"}
    assert one(spark, X.interpolate(F.lit("${A}|${axb}|${a.b}|${N:-${B}|${N:-d$1}|$x"), values)) == "${B}||dot|${B|d$1|$x"
    assert one(spark, X.interpolate(F.lit("${A} ${N} ${N:-e}"), {}, keep_missing=True)) == "${A} ${N} e"
    assert one(spark, X.interpolate(F.lit(None).cast("string"), values)) == ""


def test_corrupt_registry_raises_whatever_is_read(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"category": "task", "id": "x"}\n{broken\n')
    for read in (lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="Failed to parse registry"):
            read(Fi.read_registry(spark, str(tmp_path / "r.jsonl")))


def test_prune_keeps_repeated_rows(spark):
    rows = spark.createDataFrame([(1, True), (1, True), (2, False), (2, False), (3, False)], "v int, safe boolean")
    assert sorted(r.v for r in O.prune(rows, 4, [F.col("v")], F.col("safe")).collect()) == [1, 1, 2, 2]
    assert O.prune(rows, 1, [F.col("v")], F.col("safe")).count() == 2


def test_lists_are_bounded_and_rows_are_whole(spark):
    edits = spark.createDataFrame([("f", i) for i in range(7)] + [("g", 1)], "file string, task int")
    r = A.conflicts(edits, "file", "task", 3).first()
    assert (r.file, r.n_tasks, r.tasks) == ("f", 7, [0, 1, 2]) and A.conflict_rows(edits, "file", "task").count() == 7
    assert A.links_report(edits, "task", "file", 2).orderBy("file").first().sources == [0, 1]


def test_nearest_ranks_of_groups(spark):
    rows = spark.createDataFrame([("a", float(i)) for i in range(1, 101)] + [("b", 5.0), ("c", None), (None, 1.0), (None, 2.0)], "k string, v double")
    got = {r.k: (r.p50, r.p95, r.p99) for r in A.nearest_ranks(rows, "v", (50, 95, 99), ["k"]).collect()}
    assert got == {"a": (50.0, 95.0, 99.0), "b": (5.0, 5.0, 5.0), None: (1.0, 2.0, 2.0)}
    report = {r.k: (r.p50, r.n) for r in A.stats_report(rows, "v", ["k"]).collect()}
    assert report == {"a": (50.0, 100), "b": (5.0, 1), "c": (0.0, 0), None: (1.0, 2)}
    assert A.stats_report(rows.limit(0), "v").first().p50 == 0.0


YAML = """# head
files:
  - path: "a/b: c.md"   # note
    hash: 'x''y'
    tags:
    - t1
    - "t 2"
  - path: plain.md
empty:
last: ~
"""


def test_nested_yaml(spark):
    rows = spark.createDataFrame([(1, YAML), (2, "][\n"), (3, None), (4, ""), (5, "- a\n-\n  b: 2\n- c: 3\n  d: 4")], "k int, t string")
    got = [(r.k, r.path, r.value) for r in Y.yaml_paths(rows, "k", "t").orderBy("k", "line_no").collect()]
    assert got == [
        (1, "files.0.path", "a/b: c.md"), (1, "files.0.hash", "x'y"), (1, "files.0.tags.0", "t1"), (1, "files.0.tags.1", "t 2"), (1, "files.1.path", "plain.md"), (1, "last", None),
        (5, "0", "a"), (5, "1.b", "2"), (5, "2.c", "3"), (5, "2.d", "4"),
    ]
    assert Y.to_yaml([{"a": 1, "b": None}], "x") == "# x\n- a: 1\n  b: null\n"


def test_text_statistics_of_odd_texts(spark):
    s = lambda t: tuple(one(spark, F.struct(*(X.text_stats(F.lit(t).cast("string"))[k] for k in ("n_words", "n_sentences", "n_paragraphs")))))
    assert s(None) == s("") == s(" \n\n ") == (0, 0, 0)
    assert s("..a. b!? \n\n\n c\n \nd") == (4, 3, 2) and s("\n\nx") == (1, 1, 1)


def test_formats(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "x string, y int").orderBy("x", "y")
    assert L.formatted(rows, "tree") == "a\n  1\n  2\nb\n  2"
    with pytest.raises(ValueError):
        L.formatted(rows, "pdf")


def fold_limit(times, window, most):
    held, out = [], []
    for t in times:
        held = [h for h in held if h > t - window]
        out.append((len(held) < most, max(most - len(held), 0)))
        held += [t] * (len(held) < most)
    return out


def test_rate_limit_as_a_stream_and_against_a_fold(spark, tmp_path):
    rng = random.Random(3)
    calls = [(k, i, datetime(2024, 1, 1) + timedelta(seconds=s)) for k in range(4) for i, s in enumerate(sorted(rng.randrange(600) for _ in range(60)))]
    rows = spark.createDataFrame(calls, "k int, i int, at timestamp")
    want = {}
    for k in range(4):
        mine = [c for c in calls if c[0] == k]
        want |= {(k, c[1]): w for c, w in zip(mine, fold_limit([c[2].timestamp() for c in mine], 30, 2), strict=True)}
    assert {(r.k, r.i): (r.allowed, r.remaining) for r in R.rate_limited(rows, "k", "at", "i", 30, 2).collect()} == want
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = R.rate_limited_stream(R.parquet_feed(spark, str(tmp_path / "in"), rows.schema), "k", "at", "i", 30, 2)
    out = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    out.awaitTermination()
    assert {(r.k, r.i): (r.allowed, r.remaining) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_state_versions(spark, tmp_path):
    state = str(tmp_path / "state")
    step = R.upsert_sink(state, "id", "at")
    for batch in range(4):
        step(spark.createDataFrame([(f"k{batch}", "add", batch), ("k", "change", batch)], "id string, action string, at int"), batch)
    (tmp_path / "state" / "v=000000009").mkdir()  # a write that was not finished
    assert R.whole_versions(spark, state) == [2, 3]
    assert {(r.id, r.at) for r in R.read_state(spark, state).collect()} == {("k", 3), *((f"k{b}", b) for b in range(4))}
    assert R.read_state(spark, str(tmp_path / "none")) is None


def test_locale_order(spark):
    rows = spark.createDataFrame([(x,) for x in ("b", "B", "a", "É", "e", "Z", "f")], "x string")
    assert [r.x for r in rows.orderBy(O.by_locale(F.col("x"))).collect()] == ["a", "b", "B", "e", "É", "f", "Z"]


def test_log_rotation_keeps_some_backups(spark, tmp_path):
    log, backups = str(tmp_path / "log"), tmp_path / "backups"
    assert Fi.rotate(spark, log, str(backups)) is None
    for k in range(4):
        spark.createDataFrame([(k, "x" * 50)], "k int, t string").coalesce(1).write.mode("append").json(log)
        assert Fi.rotate(spark, log, str(backups), most_bytes=10_000) is None
        assert Fi.rotate(spark, log, str(backups), most_bytes=20, keep=2).endswith(f"{k + 1:06d}-log")
    assert sorted(p.name for p in backups.iterdir()) == ["000003-log", "000004-log"]
    assert sorted(r.k for r in spark.read.json(f"{backups}/*").collect()) == [2, 3]


def test_commit_lines(spark):
    rows = spark.createDataFrame([("abc1234 feat: add new feature",), ("def5678 fix(ui)!: bug fix ",), ("abc12345 plain words",), ("fatal: none",), ("",), (None,)], "text string")
    got = [(r.id, r.kind, r.scope, r.breaking, r.message, r.subject) for r in Fi.commits(rows).collect()]
    assert got == [("abc1234", "feat", None, False, "add new feature", "feat: add new feature"), ("def5678", "fix", "ui", True, "bug fix", "fix(ui)!: bug fix"), ("abc12345", None, None, False, "plain words", "plain words")]
