"""Source divergence audit: how far the word use of a language's sources lies apart, and by which words.

Within a language, the terms that enough of its documents have get a smoothed integer share in every source and in the
language. Two sources are as far apart as the sum of (p - q)^2 / (p + q) over these terms; a source is marked by the
terms whose share in it is above that in the language, by the same figure. The steps:

1. A task counts the terms of its documents by language and source and sends its counts, which are then added up.
2. Terms in too few documents of a language go. The rest is laid out in blocks of terms; a block of terms by a block of
   sources is one dense int64 matrix.
3. A task takes the matrices of one block of terms and two blocks of sources. It computes the figure of all their pairs
   at once by broadcasting, and sends a partial sum for each pair, and the best terms of each source.
4. Partial sums are added up, and the best terms of a source over all blocks are merged.

A matrix has about ``TERMS`` columns and ``SOURCES`` rows, however many of both there are. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, require, short_batches, weighted_join, written

#: Shares are in parts of UNIT, and a term is counted EXTRA times more than it occurs.
UNIT = 1_000_000_000
EXTRA = 2
#: Terms of a block, sources of a block, about.
TERMS = 2048
SOURCES = 64
#: Pairs by terms that are compared at a time.
CELLS = 1 << 19
#: Different terms that a task holds before it sends its counts.
HELD = 400_000

#: a-z and all bytes of other characters stay, A-Z are lowered, anything else separates terms.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + EXTRA) / total), by long division: exact for totals up to 9 * 10^15."""
    whole, rest = np.divmod(counts + EXTRA, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)), element by element."""
    return (p - q) ** 2 // (p + q)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term; lang, source and text are not null."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        tables = []
        for (lang, source), (n, found) in held.items():
            constant = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
            counts = [pa.array(x, pa.int64()) for x in (n.values(), map(found.__getitem__, n))]
            tables.append(pa.table([*constant, pa.array(n, pa.binary()).cast(pa.string()), *counts], names=["lang", "source", "term", "n", "docs"]))
        if tables:
            yield from pa.concat_tables(tables).combine_chunks().to_batches(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                n, found = held.setdefault((lang, source), (Counter(), Counter()))
                terms, before = text.as_py().translate(_LETTERS).split(), len(n)
                n.update(terms)
                found.update(set(terms))
                size += len(n) - before
                if size >= HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    parts = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _kept(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, total, lead) of the terms that ``least_docs`` documents of their language have.

    total: occurrences in the language; lead: 1 on one row of each term of a language.
    """
    w = W.partitionBy("lang", "term")  # a row for each source
    found = term_counts(docs).withColumns({"lang_docs": F.sum("docs").over(w), "total": F.sum("n").over(w), "lead": (F.min("source").over(w) == F.col("source")).cast("int")})
    return found.filter(F.col("lang_docs") >= least_docs).drop("lang_docs", "docs")


def _tiles(rows: DataFrame, term: bool) -> DataFrame:
    """Rows with lang, g (block of its source) and groups (how many there are), once for each pair of blocks with g in it."""
    both = F.transform(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1), lambda x: F.struct(F.least("g", x).alias("low"), F.greatest("g", x).alias("high")))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")) if term else F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return rows.withColumn("block", block).withColumn("pair", F.explode(both)).withColumns({"low": F.col("pair.low"), "high": F.col("pair.high")}).drop("pair", "groups", "blocks")


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("covered", pa.int64()), ("absent", pa.int64())])


def _audited(most: int) -> Callable[..., pa.Table]:
    def run(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
        """Of one block of terms and two blocks of sources: sums of all pairs of a source of one and a source of the other,
        and if the two are one block, the ``most`` best terms of each source."""
        lang, _, low, high = (k.as_py() for k in key)
        groups = groups.sort_by("source")
        sources, g = groups.column("source").to_pylist(), groups.column("g").to_numpy()
        whole, kept, all_of = (groups.column(c).to_numpy() for c in ("words", "kept", "lang_words"))
        place = {s: i for i, s in enumerate(sources)}
        named = counts.column("term").combine_chunks().dictionary_encode()
        terms, at = named.dictionary.to_pylist(), named.indices.to_numpy()
        n, total = np.zeros((len(sources), len(terms)), np.int64), np.zeros(len(terms), np.int64)
        n[[place[s] for s in counts.column("source").to_pylist()], at] = counts.column("n").to_numpy()
        total[at] = counts.column("total").to_numpy()
        sums = np.maximum(whole + EXTRA * kept, 1)  # without a kept term there is nothing to divide
        p, none = shares(n, sums[:, None]), shares(np.zeros(len(sources), np.int64), sums)
        out = []
        rows, others = np.flatnonzero(g == low), np.flatnonzero(g == high)
        value = np.zeros((len(rows), len(others)), np.int64)
        width = max(1, CELLS // max(value.size, 1))
        for c in range(0, len(terms), width):
            value += distances(p[rows, None, c : c + width], p[None, others, c : c + width]).sum(axis=2)
        absent = distances(none[rows, None], none[None, others])
        out += [(lang, sources[i], "pair", sources[j], int(value[x, y]), len(terms), int(absent[x, y])) for x, i in enumerate(rows) for y, j in enumerate(others) if low != high or i < j]
        if low == high and terms:
            q = shares(total, np.maximum(all_of[0] + EXTRA * kept[0], 1))
            value = np.where((n > 0) & (p > q), distances(p, q), -1)
            order = np.argsort(np.array(terms, object))
            for i, s in enumerate(sources):
                best = order[np.argsort(-value[i][order], kind="stable")[:most]]
                out += [(lang, s, "term", terms[t], int(value[i, t]), 0, 0) for t in best if value[i, t] >= 0]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT) if out else _OUT.empty_table()

    return run


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def audit(docs: DataFrame, least_docs: int = 10, most: int = 10, terms: int = TERMS, sources: int = SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank) of every occurring language and source.

    docs: text, lang, source; other columns are left aside, and nulls are read as ''. Part ``pair``: the other sources of
    the language by distance, all of them. Part ``term``: the ``most`` terms that mark the source. Ranks go from 1 by value,
    highest first, then by the bytes of the item. A source without terms takes part with its smoothed shares; in a
    language of which no term is kept, all distances are 0. Repeated rows are documents of their own. An empty table
    gives no rows, and so does a language of one source that no term marks.
    """
    docs = require(docs, ["text", "lang", "source"], "audit").select(_text("text"), _text("lang"), _text("source"))
    with short_batches(docs.sparkSession):
        kept = written(_kept(docs, least_docs), "kept_terms")
    words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.sum("lead").alias("leads"), F.count("*").alias("rows"))
    groups = docs.select("lang", "source").distinct().join(words, ["lang", "source"], "left").fillna(0, ["words", "leads", "rows"])
    groups = written(groups, "groups")
    ceil = lambda x, size: F.greatest(F.lit(1), F.ceil(x / F.lit(size))).cast("long")
    langs = groups.groupBy("lang").agg(F.sum("words").alias("lang_words"), F.sum("leads").alias("kept"), F.sum("rows").alias("rows"), F.count("*").alias("n_sources"))
    langs = written(langs.select("lang", "lang_words", "kept", (F.col("rows") + F.col("n_sources")).alias("rows"), ceil(F.col("kept"), terms).alias("blocks"), ceil(F.col("n_sources"), sources).alias("groups")), "langs")
    g = F.pmod(F.xxhash64("source"), F.col("groups"))
    counts = weighted_join(kept.drop("lead"), langs.select("lang", "blocks", "groups", "rows"), "lang", "rows").withColumn("g", g).drop("rows")
    listed = weighted_join(groups.select("lang", "source", "words"), langs, "lang", "rows").withColumn("g", g).drop("rows")
    key = ["lang", "block", "low", "high"]
    tiles = _tiles(counts, True).groupBy(*key).cogroup(_tiles(listed, False).groupBy(*key))
    found = written(tiles.applyInArrow(_audited(most), ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _OUT)), "audited")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"), F.max("absent").alias("absent"))
    # A term that neither block of sources has was in no matrix of the two.
    sums = weighted_join(sums, langs.select("lang", "kept", (F.col("groups") * F.col("rows")).alias("rows")), "lang", "rows")
    sums = sums.withColumn("value", F.col("value") + (F.col("kept") - F.col("covered")) * F.col("absent"))
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = sums.select("lang", F.explode(ways).alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = found.filter("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    discard(kept, groups)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
