"""YAML as rows: block scalars, flow collections, corrupt files, nested output."""

import time

import pyarrow as pa
import pytest

from cairnflow.sources import yamls as Y

TEXT = """# head
name: "a b"   # said
list: [one, "two, three", 'it''s', 4]   # flow
empty: []
map: {x: 1, y: "p: q", 'z': null}
story: |
  first line
    deeper: not a key
  - no item

  last
folded: >-
  these words
  are one line

  this is another
kept: |+
  end

after: yes
items:
  - note: >
      folded
      note
    id: 7
  - |
    an item
  - [a, b]
"""
WANT = {
    "name": "a b", "list.0": "one", "list.1": "two, three", "list.2": "it's", "list.3": "4", "map.x": "1", "map.y": "p: q", "map.z": None,
    "story": "first line\n  deeper: not a key\n- no item\n\nlast\n", "folded": "these words are one line\nthis is another", "kept": "end\n\n", "after": "yes",
    "items.0.note": "folded note\n", "items.0.id": "7", "items.1": "an item\n", "items.2.0": "a", "items.2.1": "b",
}


def paths(spark, text):
    rows = spark.createDataFrame([("k", text)], "k string, t string")
    return {r.path: r.value for r in Y.yaml_paths(rows, "k", "t").collect()}


def test_block_and_flow_values(spark):
    assert paths(spark, TEXT) == WANT
    assert paths(spark, TEXT.replace("\n", "\r\n").replace("\r\n", "\n")) == WANT
    assert paths(spark, "a: |\n  x") == {"a": "x\n"}
    assert paths(spark, "") == paths(spark, "\n# only\n") == {}
    assert paths(spark, "a: >\nb: 2") == {"a": "", "b": "2"}


@pytest.mark.parametrize("text", ["a: [1, 2", "a: 'open", 'a: "open', "just words", "a: 1\n{{{ bad"])
def test_corrupt_texts(spark, text):
    assert paths(spark, text) == {}


def test_files(spark, tmp_path):
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.yaml").write_text("entities:\n  task:\n    t1:\n      path: x/y\n      purpose: |\n        Does\n        it.\n      keywords: [one, two]\n      used_by:\n        - t2\n")
    (tmp_path / "good" / "empty.yaml").write_text("")
    (tmp_path / "bad.yaml").write_text("entities:\n  task:\n    broken [\n")
    found = Y.read_yaml_registry(spark, str(tmp_path / "good")).collect()
    assert [(r.category, r.id, r.path, r.purpose, r["keywords"], r.used_by) for r in found] == [("task", "t1", "x/y", "Does\nit.\n", ["one", "two"], ["t2"])]
    assert Y.read_yaml_registry(spark, str(tmp_path / "missing.yaml")).count() == 0
    for read in (lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="Failed to parse registry.*bad.yaml, line 3"):
            read(Y.read_yaml_registry(spark, str(tmp_path / "bad.yaml")))


def test_nested_values_come_back(spark):
    rows = spark.createDataFrame([("f", 1, ['x, "y"', "z"], ("p: q", None)), ("f", 2, [], ("1", "a\nb")), ("f", 3, None, None)], "file string, id int, tags array<string>, at struct<u: string, v: string>")
    text = Y.yaml_text(rows, "file", "id", ["id", "tags", "at"], "items")
    got = {(r.path, r.value) for r in Y.yaml_paths(text, "file", "text").collect()}
    assert got == {("items.0.id", "1"), ("items.0.tags.0", 'x, "y"'), ("items.0.tags.1", "z"), ("items.0.at.u", "p: q"), ("items.0.at.v", None), ("items.1.id", "2"), ("items.1.at.u", "1"), ("items.1.at.v", "a\nb"), ("items.2.id", "3"), ("items.2.tags", None), ("items.2.at", None)}


def test_long_documents_take_time_by_their_lines(spark):
    """30,000 entities in one text and 20,000 items in another: time grew with the square of the lines before."""
    lines = lambda n: "entities:\n  part:\n" + "".join(f"    p{i}:\n      path: a/{i}  # where\n      keywords:\n        - k\n        - {i}\n" for i in range(n))
    texts = spark.createDataFrame([("a", lines(30_000)), ("b", "list:\n" + "".join(f"- {i}\n" for i in range(20_000))), ("c", lines(3_000) + "just words\n"), (None, "x: 1")], "k string, t string").coalesce(1)
    start = time.time()
    found = Y.yaml_paths(texts, "k", "t").persist()
    assert {r.k: r["count"] for r in found.groupBy("k").count().collect()} == {"a": 90_000, "b": 20_000, None: 1}
    assert time.time() - start < 60
    last = {(r.line_no, r.path, r.value) for r in found.filter("k = 'a' AND line_no > 149998 OR k = 'b' AND path = 'list.19999'").collect()}
    assert last == {(150_001, "entities.part.p29999.keywords.0", "k"), (150_002, "entities.part.p29999.keywords.1", "29999"), (149_999, "entities.part.p29999.path", "a/29999"), (20_001, "list.19999", "19999")}
    found.unpersist()


def test_long_manifests_come_back(spark):
    """A manifest of 20,000 items, written and read: time grew with the square of the lines before."""
    rows = spark.range(20_000).selectExpr("'f' AS file", "id", "concat('p: ', id) AS path", "if(id % 3 = 0, NULL, 'k') AS kind")
    start = time.time()
    found = Y.yaml_items(Y.yaml_paths(Y.yaml_text(rows, "file", "id", ["id", "path", "kind"], "files", "Head"), "file", "text"), "file", "files", ["id", "path", "kind"])
    got = found.selectExpr("count(*) AS n", "count_if(id = item AND path = concat('p: ', item) AND kind <=> if(item % 3 = 0, NULL, 'k')) AS same").first()
    assert tuple(got) == (20_000, 20_000)
    assert time.time() - start < 60


def test_fold_makes_no_object_per_value():
    """The fold over 60,000 lines takes less time than Arrow needs to make an object of each of their values: it made these before."""
    n = 20_000
    told = [(3 * i + j + 1, "", 0 if j == 0 else 2, 2, j == 0, k, "v", Y._VALUE) for i in range(n) for j, k in enumerate("abc")]
    names = ["line_no", "line", "indent", "own", "is_item", "name", "rest", "kind"]
    batches = pa.table({"k": ["x"] * len(told), **dict(zip(names, map(list, zip(*told))))}).to_batches(10_000)

    def seconds(f):
        start = time.perf_counter()
        f()
        return time.perf_counter() - start

    found = pa.Table.from_batches(Y._folded("k", "drop")(iter(batches)))
    assert found.num_rows == len(told) and found["path"][-1].as_py() == f"{n - 1}.c" and found["path"][0].as_py() == "0.a"
    folding = min(seconds(lambda: list(Y._folded("k", "drop")(iter(batches)))) for _ in range(3))
    assert folding < min(seconds(lambda: [c.to_pylist() for b in batches for c in b.columns[1:]]) for _ in range(3))


def test_odd_lines(spark):
    """Patterns are tried by a line's first character: marks, tabs, dashes and dollar signs where they begin no item or comment."""
    text = "---\n-a: 1\n  -\tb: $1\n  - 'c': d: e\n  -\n\t# note\n\"f: g\": h # i\nj: l#m\n-- n: o\n 0: p\n...\nq:\n- -r: s\n-  t: {u: v}\nw: |x\ny: >\n  z\n"
    want = {"-a": "1", "-a.0.b": "$1", "-a.1.c": "d: e", "f: g": "h", "j": "l#m", "-- n": "o", "0": "p", "q.0.-r": "s", "q.1.t.u": "v", "w": "|x", "y": "z\n"}
    assert paths(spark, text) == want
    rows = spark.createDataFrame([("k", "a: 1\n\t\n \t--- \nb: \\$2\n")], "k string, t string")
    assert [(r.line_no, r.path, r.value) for r in Y.yaml_paths(rows, "k", "t").orderBy("line_no").collect()] == [(1, "a", "1"), (4, "b", "\\$2")]
