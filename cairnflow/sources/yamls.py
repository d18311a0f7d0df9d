"""YAML as rows (inventory A4, A5, A10, A19), without a YAML library.

Block mappings and block lists of any depth, plain and quoted scalars, block scalars (``|`` and ``>``), flow lists and
flow mappings of scalars on one line, comments. Anchors, tags and nested flow collections are left as text.
"""

from __future__ import annotations

import json

from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _starts(text: Column, with_one_of: str, pattern: str) -> Column:
    """Whether a pattern that starts with one of these characters fits; tried only where the text starts so."""
    return F.substr(text, F.lit(1), F.lit(1)).isin(*with_one_of) & text.rlike(pattern)


def scalar(text: Column) -> Column:
    """The value of a scalar as written: quotes and trailing comment taken off; empty, ``null`` and ``~`` are null."""
    t = F.trim(text)
    double = F.regexp_extract(t, r'^"((?:[^"\\]|\\.)*)"\s*(?:#.*)?$', 1)
    single = F.regexp_replace(F.regexp_extract(t, r"^'((?:[^']|'')*)'\s*(?:#.*)?$", 1), "''", "'")
    plain = F.when(t.contains("#"), F.trim(F.regexp_replace(t, r"(^|\s)#.*$", ""))).otherwise(t)
    told = F.regexp_replace(F.regexp_replace(double, r"\\n", "\n"), r'\\(["\\/])', "$1")
    return F.when(t.startswith('"'), told).when(t.startswith("'"), single).otherwise(F.when(plain.isin("", "null", "~"), F.lit(None)).otherwise(plain))


def _flow_items(rest: Column) -> Column:
    """The items of a flow list of scalars, as written."""
    inner = F.regexp_extract(F.trim(rest), r"^\[(.*)\]\s*(?:#.*)?$", 1)
    found = F.regexp_extract_all(inner, F.lit(r"""\s*("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^,]+)"""), F.lit(1))
    return F.filter(found, lambda x: F.trim(x) != "")


def _flow_pairs(rest: Column) -> Column:
    """The pairs of a flow mapping of scalars, as written."""
    inner = F.regexp_extract(F.trim(rest), r"^\{(.*)\}\s*(?:#.*)?$", 1)
    pair = r"""\s*([^,:"']+?|"[^"]*"|'[^']*')\s*:(\s+(?:"(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^,]*)|)(?:,|$)"""
    each = F.regexp_extract_all(inner, F.lit(pair), F.lit(0))
    part = lambda x, k: F.regexp_extract(x, pair, k)
    return F.transform(each, lambda x: F.struct(F.regexp_replace(part(x, 1), r"^[\"']|[\"']$", "").alias("name"), part(x, 2).alias("value")))


def _block_text(lines: Column, style: Column) -> Column:
    """The value of a block scalar: the first line's indent taken off, folded for ``>``, trailing line ends by its mark."""
    deep = F.length(F.regexp_extract(F.coalesce(F.get(F.filter(lines, lambda x: F.trim(x) != ""), F.lit(0)), F.lit("")), r"^( *)", 1))
    plain = F.array_join(F.transform(lines, lambda x: F.substr(x, deep + 1)), "\n")
    ends = F.regexp_extract(plain, r"(\n*)$", 1)
    body = F.regexp_replace(plain, r"\n+$", "")
    folded = F.regexp_replace(F.regexp_replace(body, r"(?<!\n)\n(?!\n)", " "), r"\n(\n+)", "$1")
    body = F.when(style.startswith(">"), folded).otherwise(body)
    last = F.when(style.contains("-") | (body == ""), "").when(style.contains("+"), F.concat(F.lit("\n"), ends)).otherwise("\n")
    return F.concat(body, last)


#: What a line is to the fold: nothing, a line with a value, one that only opens, the head of a block scalar, no YAML of this kind.
_SKIP, _VALUE, _OPEN, _BLOCK, _BAD = range(5)
#: What the fold gives beside the key.
_FOUND = {"line_no": pa.int32(), "path": pa.string(), "rest": pa.string(), "lines": pa.list_(pa.string())}


def _told_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, line and what a line says by itself: indent, own (that of its key), is_item, name (null: no key), rest, kind."""
    pair = r"^(?:\"([^\"]*)\"|'([^']*)'|([^\s#\"'\[{\-][^:#]*?|-[^\s:][^:]*?)):(?:\s+(.*))?$"
    split = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?", "\n"), "\n")
    lines = docs.select(key, F.posexplode(split).alias("at", "line")).select(key, (F.col("at") + 1).alias("line_no"), "line")
    line = F.col("line")
    # Patterns cost most here: each is tried only on lines whose first character lets it fit, that of a pair once.
    lines = lines.withColumn("from", F.ltrim(line))
    dash = F.col("from").startswith("-")
    indent, gap = F.length(line) - F.length("from"), F.when(dash, F.length(F.regexp_extract("from", r"^(-\s*)", 1))).otherwise(0)
    lines = lines.withColumns({"indent": indent, "is_item": dash & F.col("from").rlike(r"^-(\s|$)"), "gap": gap})
    body = F.when(F.col("is_item"), F.substr("from", F.col("gap") + 1)).otherwise(F.rtrim("from"))
    # A body starts with no space and no line holds a line end, so these tell a pair and its halves.
    lines = lines.withColumn("body", body).withColumn("halves", F.regexp_replace("body", f"{pair}(?s:.*)", " $1$2$3\n$4"))
    is_pair = F.col("halves").startswith(" ")
    name, rest = F.when(is_pair, F.trim(F.substring_index("halves", "\n", 1))), F.trim(F.substring_index("halves", "\n", -1))
    lines = lines.withColumns({"own": F.col("indent") + F.col("gap"), "name": name, "rest": rest})
    rest = F.col("rest")
    cut = _starts(rest, "[{", r"^[\[{][^\]}]*$") | _starts(rest, '"', r'^"(?:[^"\\]|\\.)*$') | _starts(rest, "'", r"^'(?:[^']|'')*$")
    no_skip = F.ascii("from").between(48, 122) | (dash & ~F.col("from").startswith("---"))  # from 0 to z
    kind = (
        F.when(~no_skip & line.rlike(r"^\s*(#.*|---|\.\.\.)?\s*$"), _SKIP)
        .when(_starts(rest, "|>", r"^[|>][+-]?\s*(#.*)?$"), _BLOCK)
        .when((F.col("name").isNull() & ~F.col("is_item")) | cut, _BAD)
        .when((rest == "") | rest.startswith("#"), _OPEN)
        .otherwise(_VALUE)
    )
    return lines.select(key, "line_no", "line", "indent", "own", "is_item", "name", "rest", kind.alias("kind"))


class _Paths:
    """The fold over the lines of one document: open keys with their indents, and the block scalar that is open."""

    def __init__(self):
        self.stack: list[tuple[int, int, str]] = []  # (indent, number of the item or -1, name)
        self.head, self.deep, self.lines = None, 0, []

    def closed(self):
        """The block scalar that was open, as a row."""
        head, self.head = self.head, None
        return [(*head, self.lines)] if head else []

    def rows(self, no, line, indent, own, is_item, name, rest, kind):
        """(line_no, path, rest, lines of a block scalar) of what this line ends or holds."""
        if self.head and (indent > self.deep or not line.strip(" ")):
            self.lines.append(line)
            return []
        out, stack = self.closed(), self.stack
        if kind == _SKIP:
            return out
        # What stays open: shallower keys; for an item also the key it belongs to at the same indent.
        last = -1
        while stack and stack[-1][0] >= indent and not (is_item and stack[-1][0] == indent and stack[-1][1] < 0):
            closing = stack.pop()
            if closing[0] == indent and last < 0:
                last = closing[1]
        if is_item:
            stack.append((indent, last + 1, str(last + 1)))
        if name is not None:
            stack.append((own, -1, name))
        if kind in (_VALUE, _BLOCK):
            row = (no, ".".join(s[2] for s in stack), rest)
            if kind == _VALUE:
                out.append((*row, None))
            else:
                self.head, self.deep, self.lines = row, own if name is not None else indent, []
        return out


def _folded(key: str, corrupt: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines of documents, each in order and one after the other, to rows; those of a document go out when it has ended well."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, held, rows, bad, name = _Paths(), [], [], False, None

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _FOUND.values())]
            return pa.RecordBatch.from_arrays([name.take(pa.array([0] * len(rows))), *columns], names=[key, *_FOUND])

        def ended() -> list[pa.RecordBatch]:
            rows.extend(doc.closed())
            return [] if bad else [*held, *([packed()] if rows else [])]

        for batch in batches:
            # By way of NumPy, since to_pylist makes an object of Arrow per value; only names are ever null.
            for i, told in enumerate(zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns[1:]))):
                if told[0] == 1:
                    yield from ended()
                    doc, held, rows, bad, name = _Paths(), [], [], False, batch.column(0).slice(i, 1)
                if bad:
                    continue
                found = doc.rows(*told)
                if told[-1] == _BAD and not doc.head:
                    if corrupt == "raise":
                        raise ValueError(f"Failed to parse registry: {name[0].as_py()}, line {told[0]}")
                    bad, held, rows = True, [], []
                rows.extend(found)
            if rows and not bad:
                held.append(packed())
                rows = []
        yield from ended()

    return fold


def yaml_paths(docs: DataFrame, key: str, text: str, corrupt: str = "drop") -> DataFrame:
    """A4: key, line_no, path, value: a row per scalar of each document, list items by their number.

    What a line says by itself is told by Spark, a row per line; one fold over the lines of a document where they are, in
    time that grows with their number, adds the open keys. A line that is no YAML of this kind (no key, item, comment or
    blank; an open bracket or quote) makes a text corrupt: it gives no rows or, for ``corrupt`` of ``raise``, fails what
    reads the rows with its key and line. A null or blank text gives no rows.
    """
    lines = _told_lines(docs, key, text)
    kinds = T.StructType([docs.schema[key]]).add("line_no", "integer").add("path", "string").add("rest", "string").add("lines", T.ArrayType(T.StringType()))
    rows = lines.mapInArrow(_folded(key, corrupt), kinds)
    rest = F.col("rest")
    is_list, is_map = _starts(rest, "[", r"^\[[^\[\]{}]*\]\s*(#.*)?$"), _starts(rest, "{", r"^\{[^\[\]{}]*\}\s*(#.*)?$")
    at = lambda path, value: F.struct(path.alias("path"), value.alias("value"))
    under = lambda n: F.concat_ws(".", F.nullif(F.col("path"), F.lit("")), n)
    found = (
        F.when(F.col("lines").isNotNull(), F.array(at(F.col("path"), _block_text(F.col("lines"), rest))))
        .when(is_list, F.transform(_flow_items(rest), lambda x, i: at(under(i.cast("string")), scalar(x))))
        .when(is_map, F.transform(_flow_pairs(rest), lambda x: at(under(F.trim(x["name"])), scalar(x["value"]))))
        .otherwise(F.array(at(F.col("path"), scalar(rest))))
    )
    return rows.select(key, "line_no", F.inline(found))


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """A4, A5: file, line_no, path, value of all YAML files that ``path`` (a file, folder or pattern) names, a file a row.

    Missing files and empty ones give no rows; a corrupt file fails what reads the rows ("Failed to parse registry"). Read by
    Spark, so it reaches any store that Spark does; a file is one row while it is parsed.
    """
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, line_no int, path string, value string")
    return yaml_paths(texts.select(F.input_file_name().alias("file"), "value"), "file", "value", corrupt="raise")


def read_yaml_registry(spark: SparkSession, path: str) -> DataFrame:
    """A5: the entities of YAML registries: category, id, path, type, purpose, keywords, used_by."""
    return registry_rows(read_yaml(spark, path), "file")


def yaml_items(paths: DataFrame, key: str, under: str, fields: list[str]) -> DataFrame:
    """A4: of ``yaml_paths``, the list of mappings at ``under`` as rows: key, item, one string column per field."""
    rows = paths.filter(F.col("path").startswith(f"{under}."))
    rest = F.split(F.substring(F.col("path"), len(under) + 2, 1 << 20), r"\.", 2)
    rows = rows.select(key, rest[0].try_cast("int").alias("item"), F.get(rest, F.lit(1)).alias("__field"), "value").filter("item IS NOT NULL")
    return rows.groupBy(key, "item").agg(*(F.max(F.when(F.col("__field") == f, F.col("value"))).alias(f) for f in fields))


def registry_rows(paths: DataFrame, key: str, under: str = "entities") -> DataFrame:
    """A5: of ``yaml_paths``, entities at ``under.<category>.<id>``: category, id, path, type, purpose, keywords, used_by."""
    parts = F.split("path", r"\.")
    rows = paths.filter(F.col("path").startswith(f"{under}.")).select(F.get(parts, F.lit(1)).alias("category"), F.get(parts, F.lit(2)).alias("id"), F.get(parts, F.lit(3)).alias("__f"), F.get(parts, F.lit(4)).try_cast("int").alias("__i"), "value", key)
    one = lambda f: F.max(F.when((F.col("__f") == f) & F.col("__i").isNull(), F.col("value"))).alias(f)
    many = lambda f: F.transform(F.sort_array(F.collect_list(F.when((F.col("__f") == f) & F.col("__i").isNotNull(), F.struct("__i", "value")))), lambda x: x["value"]).alias(f)
    return rows.groupBy("category", "id").agg(*map(one, ("path", "type", "purpose")), *map(many, ("keywords", "used_by")))


def yaml_block(text: Column) -> Column:
    """The first yaml code block, else the front matter, else null."""
    block = F.regexp_extract(text, r"(?s)```ya?ml\s*\n(.*?)```", 1)
    front = F.regexp_extract(text, r"(?s)^---\s*\n(.*?)\n---", 1)
    return F.coalesce(F.nullif(block, F.lit("")), F.nullif(front, F.lit("")))


def yaml_text(rows: DataFrame, key: str, order: str, fields: list[str], under: str, header: str = "") -> DataFrame:
    """A10: key, text: the rows of a key as a YAML list of mappings below ``under``, with a header comment.

    Arrays are flow lists, structs one level of mapping, all else quoted scalars; nulls are ``null``. A document gathers the
    rows of its key, so a key is one file's worth; ``order`` sorts its items.
    """
    kinds = {f.name: f.dataType for f in rows.select(*fields).schema}
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c.cast("string"), r'(["\\])', r"\\$1"), "\n", r"\\n"), F.lit('"')), F.lit("null"))

    def written_as(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.ArrayType):
            return F.coalesce(F.concat(F.lit("["), F.array_join(F.transform(column, quoted), ", "), F.lit("]")), F.lit("null"))
        if isinstance(kind, T.StructType):
            inner = F.concat(*(F.concat(F.lit(f"\n      {f.name}: "), quoted(column[f.name])) for f in kind))
            return F.when(column.isNull(), "null").otherwise(inner)
        return quoted(column)

    item = F.concat(*(F.concat(F.lit("  - " if i == 0 else "    "), F.lit(f"{f}: "), written_as(F.col(f), kinds[f]), F.lit("\n")) for i, f in enumerate(fields)))
    top = "".join(f"# {x}\n" for x in header.splitlines()) + f"{under}:\n"
    items = F.transform(F.sort_array(F.collect_list(F.struct(order, item.alias("t")))), lambda x: x["t"])
    return rows.groupBy(key).agg(F.concat(F.lit(top), F.array_join(items, "")).alias("text"))


def to_yaml(rows: list[dict], header: str = "") -> str:
    """A10: a short list of flat mappings as YAML with a header comment."""
    text = "".join(f"# {x}\n" for x in header.splitlines())
    for r in rows:
        for i, (k, v) in enumerate(r.items()):
            text += f"{'- ' if i == 0 else '  '}{k}: {'null' if v is None else json.dumps(v, default=str, ensure_ascii=False)}\n"
    return text or "[]\n"
