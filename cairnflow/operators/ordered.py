"""Window-like, sorting and top-k operators (inventory E1-E10, F1-F11, H23)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranks import numbered, running


def _micros(at: Column) -> Column:
    """Microseconds since the epoch, of a time with or without zone."""
    return F.unix_micros(at.cast("timestamp"))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows per key in the given order."""
    return rows.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("__rn") <= n).drop("__rn")


def ngrams(rows: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, sizes: Sequence[int] = (3, 4), key_items: Sequence[str] = ()) -> DataFrame:
    """Sequences of consecutive items with count; only those with a key item if any is named.

    Built from ``lead``, so a long history is never gathered in one row.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    rows = rows.select(*keys, *[o for o in order if o not in keys], item)
    wide = rows.select(F.col(item).alias("__0"), *(F.lead(item, k).over(w).alias(f"__{k}") for k in range(1, max(sizes))))
    each = F.array(*(F.when(F.col(f"__{n - 1}").isNotNull(), F.array(*(F.col(f"__{k}") for k in range(n)))) for n in sizes))
    out = wide.select(F.explode(F.array_compact(each)).alias("sequence"))
    if key_items:
        out = out.filter(F.arrays_overlap("sequence", F.array(*map(F.lit, key_items))))
    return out.groupBy("sequence").agg(F.count("*").alias("occurrences"))


def within_budget(rows: DataFrame, keys: Sequence[str], drop_order: Sequence[Column], cost: Column, budget: float, protected: Column | None = None) -> DataFrame:
    """Rows kept while the running cost, protected rows first, stays within the budget; 0 means no limit.

    A key may have all rows: they are summed range by range. Costs are 0 or more; null costs nothing.
    """
    if budget <= 0:
        return rows
    if protected is None:
        return running(rows, keys, drop_order, cost, "__sum", budget).drop("__sum")
    safe = F.coalesce(protected, F.lit(False))
    marked = rows.withColumns({"__safe": safe})
    summed = running(marked, keys, [F.desc("__safe"), *drop_order], cost, "__sum")
    return summed.filter(F.col("__safe") | (F.col("__sum") <= budget)).select(*rows.columns)


def gaps(rows: DataFrame, keys: Sequence[str], at: str, tie: str, seconds: float, action: Column | None = None, pause: str = "PAUSE") -> DataFrame:
    """Rows that follow the previous one by more than ``seconds``, unless that one was a pause."""
    w = W.partitionBy(*keys).orderBy(at, tie)
    gap = (_micros(F.col(at)) - _micros(F.lag(at).over(w))) / 1e6
    rows = rows.withColumn("gap_seconds", gap)
    if action is not None:
        rows = rows.withColumn("__was", F.lag(action).over(w)).filter(F.coalesce(F.col("__was") != pause, F.lit(True))).drop("__was")
    return rows.filter(F.col("gap_seconds") > seconds)


def repeats(rows: DataFrame, keys: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """E5: rows whose item equals the previous one."""
    was = F.lag(item).over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__was", was).filter(F.col(item) == F.col("__was")).drop("__was")


def previous_other(rows: DataFrame, keys: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """With ``previous_other``, the last earlier item that differs from this row's."""
    w = W.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("__was", F.lag(item).over(w))
    # At a change the item before is another one; between changes the last change's stays.
    changed = F.when(F.col(item) != F.col("__was"), F.col("__was"))
    return rows.withColumn("previous_other", F.last(changed, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__was")


def top(rows: DataFrame, score: Column, tie: Sequence[Column], n: int = 20, least: float | None = 0.4) -> DataFrame:
    """the n best rows with at least ``least``: a top-k heap per task, no full sort."""
    rows = rows.withColumn("score", score)
    if least is not None:
        rows = rows.filter(F.col("score") >= least)
    return rows.orderBy(F.col("score").desc(), *tie).limit(n)


#: Pages that end within so many rows are drawn from a heap per task, later ones from places over the whole table.
HEAP = 10_000


def page(rows: DataFrame, order: Sequence[Column], number: int, size: int, heap: int = HEAP) -> tuple[DataFrame, dict]:
    """the rows of a page (from 1) and its facts; an empty table has 0 pages. ``order`` ends with a unique column."""
    n = rows.count()
    pages = -(-n // size)
    start = (number - 1) * size
    facts = {"total": n, "total_pages": pages, "start": min(start + 1, n), "end": min(start + size, n), "has_next": number < pages, "has_prev": number > 1}
    if start + size <= heap:
        return rows.orderBy(*order).offset(start).limit(size), facts
    return numbered(rows, order, "__place").filter(F.col("__place").between(start + 1, start + size)).drop("__place"), facts


def pages(rows: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """every row with its page (from 1) and its place on it (from 1), all pages at once."""
    at = numbered(rows, order, "__place")
    return at.withColumns({"page": F.floor((F.col("__place") - 1) / size) + 1, "place": F.pmod(F.col("__place") - 1, F.lit(size)) + 1}).drop("__place")


def by_locale(text: Column, collation: str = "UNICODE") -> Column:
    """to sort as a locale does (root order by default; ``de_CI`` and the like for others), not by bytes."""
    return F.collate(text, collation)


def prune(rows: DataFrame, keep: int, order: Sequence[Column], protected: Column) -> DataFrame:
    """protected rows, and of the others the first in order until ``keep`` rows stay."""
    safe = rows.filter(F.coalesce(protected, F.lit(False)))
    others = rows.filter(~F.coalesce(protected, F.lit(False))).orderBy(*order)
    return safe.unionByName(others.limit(max(0, keep - safe.count())))


def severity_order(severity: Column, order: Sequence[str] = ("critical", "high", "medium", "low")) -> Column:
    """ordinal to sort by, unknown last."""
    at = F.array_position(F.array(*map(F.lit, order)), severity)
    return F.when(at > 0, at).otherwise(len(order) + 1).cast("int")


def top_words(words: DataFrame, word: str, position: Sequence[str], n: int = 10) -> DataFrame:
    """most frequent words, ties by first place."""
    per = words.groupBy(word).agg(F.count("*").alias("n"), F.min(F.struct(*position)).alias("__at"))
    return per.orderBy(F.col("n").desc(), "__at").limit(n).drop("__at")


def field_score(query: str, fields: dict[str, float], row: dict[str, Column]) -> Column:
    """weights of the fields that contain the query, case-insensitive."""
    q = query.lower()
    return sum((F.when(F.lower(F.coalesce(row[f], F.lit(""))).contains(q), w).otherwise(0.0) for f, w in fields.items()), F.lit(0.0))


def ranked_areas(rows: DataFrame, keys: Sequence[str], priority: Sequence[Column], primary: int = 3, secondary: int = 2) -> DataFrame:
    """F8: rank per key; the first ``primary`` and next ``secondary`` rows with their tier."""
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*priority)))
    return rows.filter(F.col("rank") <= primary + secondary).withColumn("tier", F.when(F.col("rank") <= primary, "primary").otherwise("secondary"))


def chunks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Batch number (from 0) of fixed size within each key, which may have all rows."""
    at = running(rows, keys, order, F.lit(1), "__upto")
    return at.withColumn("chunk", F.floor((F.col("__upto") - 1) / size).cast("long")).drop("__upto")


def distinct_items(rows: DataFrame, items: str, name: str = "item") -> DataFrame:
    """The distinct items of an array column."""
    return rows.select(F.explode(items).alias(name)).filter(F.col(name).isNotNull()).distinct()
