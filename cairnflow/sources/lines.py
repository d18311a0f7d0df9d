"""Line-oriented formats and printing (inventory A6, A7, A12, H26, C8, E6, E7, K4); YAML is in ``yamls``."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .yamls import to_yaml


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 1), text: one row per line; a generator, no shuffle."""
    return docs.select(key, F.posexplode(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n")).alias("__k", "text")).select(key, (F.col("__k") + 1).alias("line_no"), "text")


def env_entries(rows: DataFrame, file: str = "file", line_no: str = "line_no", text: str = "text") -> DataFrame:
    """File, key, value, line_no, comment of ``.env`` lines.

    Split at the first ``=``; the last of equal keys wins; a comment belongs to the key on the next line.
    """
    key = F.regexp_extract(text, r"^\s*(?:export\s+)?([a-zA-Z_][a-zA-Z0-9_]*)\s*=", 1)
    w = W.partitionBy(file).orderBy(line_no)
    before = F.trim(F.lag(text).over(w))
    comment = F.when(before.startswith("#"), F.trim(F.regexp_replace(before, "^#+", "")))
    parsed = rows.select(file, line_no, key.alias("key"), F.trim(F.regexp_extract(text, r"(?s)^[^=]*=(.*)$", 1)).alias("value"), comment.alias("comment")).filter("key <> ''")
    last = parsed.groupBy(file, "key").agg(F.max_by(F.struct("value", F.col(line_no).alias("line_no"), "comment"), line_no).alias("r"))
    return last.select(file, "key", "r.value", "r.line_no", "r.comment")


#: Patterns of the lines that begin and end a managed section; group 1 is its name.
MARKERS = (r"<!--\s*managed:start\s+([\w-]+)", r"<!--\s*managed:end\s+([\w-]+)")


def markdown_sections(rows: DataFrame, file: str = "file", line_no: str = "line_no", text: str = "text", markers: tuple[str, str] = MARKERS) -> DataFrame:
    """Sections (file, section number, title, level, first_line, last_line, managed, unclosed).

    From a line that matches the first of ``markers`` to one that matches the second is one section whatever
    headers are inside; outside, a header opens a section; lines before the first are the preamble (level 0).
    """
    w = W.partitionBy(file).orderBy(line_no)
    begins, ends = (F.regexp_extract(text, m, 1) for m in markers)
    rows = rows.select(file, line_no, text, begins.alias("__b"), ends.alias("__e"))
    depth = F.sum(F.when(F.col("__b") != "", 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)) - F.coalesce(F.sum(F.when(F.col("__e") != "", 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("__in", depth > 0)
    header = (F.col(text).rlike(r"^#{1,6}\s+\S")) & ~F.col("__in")
    left = F.coalesce(F.lag("__in").over(w), F.lit(False)) & ~F.col("__in")
    rows = rows.withColumn("__open", (header | (F.col("__b") != "") | left).cast("int"))
    rows = rows.withColumn("section", F.sum("__open").over(w.rowsBetween(W.unboundedPreceding, 0)))
    first = lambda c: F.min_by(c, line_no)
    out = rows.groupBy(file, "section").agg(
        first("__b").alias("id"), first(text).alias("__t"), F.min(line_no).alias("first_line"), F.max(line_no).alias("last_line"),
        F.max((F.col("__e") != "").cast("int")).alias("__closed"), F.max(F.col("__in").cast("int")).alias("__managed"),
    )
    managed = F.col("__managed") == 1
    return out.select(
        file, "section", F.when(managed, F.col("id")).otherwise(F.regexp_extract("__t", r"^#+\s+(.*?)\s*#*$", 1)).alias("title"),
        F.when(managed, 0).otherwise(F.length(F.regexp_extract("__t", r"^(#+)\s", 1))).alias("level"),
        "first_line", "last_line", managed.alias("managed"), (managed & (F.col("__closed") == 0)).alias("unclosed"),
    )


def findings(rows: DataFrame, key: str, rules: dict[str, str], line_no: str = "line_no", text: str = "text") -> DataFrame:
    """Key, line_no, rule, match for every match of every rule, from one pass over the lines."""

    def found(name: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(name).alias("rule"), m.alias("match")))

    each = F.explode(F.flatten(F.array(*(found(*rule) for rule in rules.items()))))
    return rows.select(key, line_no, each.alias("f")).select(key, line_no, "f.rule", "f.match")


def links(docs: DataFrame, key: str, text: str, pattern: str = r"\[[^\]]*\]\(([^)\s]+)\)") -> DataFrame:
    """Key and link, one row each."""
    return docs.select(key, F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))).alias("link"))


def link_state(found: DataFrame, known: DataFrame, link: str, path: str, soon: Column) -> DataFrame:
    """Ok / broken / expected-missing / marked-but-there by existence and the "coming soon" mark."""
    there = known.select(F.col(path).alias(link), F.lit(True).alias("__there")).distinct()
    out = found.withColumn("__soon", soon).join(there, link, "left")
    has = F.col("__there").isNotNull()
    state = F.when(has & ~F.col("__soon"), "ok").when(has, "marked-but-there").when(F.col("__soon"), "expected-missing").otherwise("broken")
    return out.withColumn("state", state).drop("__there", "__soon")


def parse_flat_yaml(text: str) -> dict | None:
    """``key: value`` and ``- item`` lists as a dict; null if the text is anything else. Nested texts: ``yamls.yaml_paths``."""
    out: dict = {}
    current: str | None = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line.lstrip().startswith("- ") and current is not None:
            if not isinstance(out[current], list):
                out[current] = []
            out[current].append(line.lstrip()[2:].strip().strip("'\""))
        elif ":" in line and not line[0].isspace():
            current, _, value = line.partition(":")
            current = current.strip()
            out[current] = value.strip().strip("'\"") or None
        else:
            return None
    return out


def _table_text(names: list[str], rows: list[dict]) -> str:
    widths = [max([len(c), *(len(str(r[c])) for r in rows)]) for c in names]
    line = lambda cells: "  ".join(str(x).ljust(w) for x, w in zip(cells, widths, strict=True)).rstrip()
    return "\n".join([line(names), *(line(r.values()) for r in rows)])


def _tree_text(names: list[str], rows: list[dict]) -> str:
    """One level of indent per column; what a row shares with the one before is not said again."""
    out, before = [], [None] * len(names)
    for r in rows:
        cells = [str(r[c]) for c in names]
        same = next((i for i, (x, y) in enumerate(zip(cells, before, strict=True)) if x != y), len(cells))
        out += [f"{'  ' * i}{cells[i]}" for i in range(same, len(cells))]
        before = cells
    return "\n".join(out)


#: K4: how a result is printed, by name; callers add their own.
REPORTERS = {
    "table": _table_text,
    "tree": _tree_text,
    "json": lambda names, rows: json.dumps(rows, default=str, indent=2),
    "yaml": lambda names, rows: to_yaml(rows),
}


def formatted(rows: DataFrame, kind: str, most_rows: int = 1000) -> str:
    """A small result by one of ``REPORTERS``, or its ``count``; raises beyond ``most_rows``."""
    if kind == "count":
        return str(rows.count())
    if kind not in REPORTERS:
        raise ValueError(f"unknown format {kind!r}")
    got = [r.asDict(recursive=True) for r in rows.limit(most_rows + 1).collect()]
    if len(got) > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    return REPORTERS[kind](rows.columns, got)
