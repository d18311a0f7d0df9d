"""Line dedup: lines that many documents share are dropped from all of them. Built-in functions only.

Normalised lines are exploded and hashed, the documents of every hash are counted, and lines whose hash is
found in too many documents are dropped; what is left of a document is put together by position. Only hashes
and positions travel: the text itself is shuffled once, when a document meets the positions that it loses.
A hash has 128 bits (two seeds of xxhash64), so two different lines are not taken for one.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, require, weighted_join, written
from .quality import let

#: The six ASCII white-space characters.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), ascii_uppercase, ascii_lowercase)


def _digest(*values: Column) -> Column:
    """128 bits of some columns."""
    return F.struct(F.xxhash64(*values), F.xxhash64(F.lit(1), *values))


def shared_lines(rows: DataFrame, least_docs: int, least_chars: int) -> DataFrame:
    """(line, docs): digests of normalised lines found in ``least_docs`` rows of ``text`` or more."""
    keys = F.array_distinct(F.transform(F.split("text", "\n"), line_key))
    lines = rows.select(F.explode(keys).alias("key")).filter(F.char_length("key") >= least_chars)
    return lines.groupBy(_digest(F.col("key")).alias("line")).agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs)


def dedup(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, text (what is kept of it), n_lines, n_dropped for every document.

    docs: doc_id, text; other columns are left aside. A line is what lies between two line feeds; lines whose
    key has ``least_chars`` code points and is in ``least_docs`` documents go, each time they occur; the others
    stay as they are, joined by line feeds. A null or empty text is one empty line, which is never dropped for
    ``least_chars`` of 1 or more. Every row counts as a document, repeated rows and rows without doc_id too, and
    returns once. An empty table gives no rows.
    """
    rows = require(docs, ["doc_id", "text"], "dedup").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", _digest(F.col("doc_id"), F.col("text")))
    shared = written(shared_lines(rows, least_docs, least_chars), "shared_lines")
    lines = rows.select("row", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line", line_key(F.col("line")))
    lines = lines.filter(F.char_length("line") >= least_chars).withColumn("line", _digest(F.col("line")))
    gone = weighted_join(lines, shared, "line", "docs", "inner").groupBy("row").agg(F.collect_set("at").alias("gone"))
    gone = written(gone, "dropped_lines")
    discard(shared)
    n = F.size(F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    joined = let(F.split("text", "\n"), lambda lines: F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(joined)
    n_dropped = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return rows.join(gone, "row", "left").select("doc_id", text.alias("text"), n.cast("long").alias("n_lines"), n_dropped.alias("n_dropped"))
