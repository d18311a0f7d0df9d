"""Places, running sums and ranks over a whole table or a hot key (inventory D4, E3, E9, F5, H23).

Rows are laid out in range partitions of (key, order), each range has a figure per key, and what lies before a range is
told by the figures of the ranges before it: a few rows per key. No task gets more than a range, however many of the
rows one key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

#: Bits of a generated id that number the rows of one partition.
ROW_BITS = 33


def _ranged(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` in range partitions of ``order``, written with the partition (__part) and the place in it (__at, from 0).

    Bounds come from a sample, so the table is written: whatever is lost later, places stay what they were.
    """
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    part, at = F.shiftright("__id", ROW_BITS), F.col("__id").bitwiseAND((1 << ROW_BITS) - 1)
    return written(laid.withColumns({"__part": part, "__at": at}).drop("__id"), name)


def _key(keys: Sequence[str]) -> Column:
    """A key of several columns as one, in which nulls are equal; the whole table without any."""
    return F.struct(*keys) if keys else F.lit(0)


def _offsets(laid: DataFrame, value: str) -> DataFrame:
    """(__key, __part, __sum, __before, __all): of ``value`` in the range, in the key's ranges before, in the key."""
    sums = laid.groupBy("__key", "__part").agg(F.sum(value).alias("__sum"))
    key = W.partitionBy("__key")
    before = F.sum("__sum").over(key.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    return sums.select("__key", "__part", "__sum", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__sum").over(key).alias("__all"))


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """every row with its place (long, from 1) in ``order`` over the whole table.

    Rows that are equal in ``order`` get any order among themselves, and a value that fills a range makes that range
    long: end ``order`` with a unique column.
    """
    laid = _ranged(df, order, "numbered")
    sizes = laid.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__before"))  # a row for each range
    out = laid.join(F.broadcast(offsets), "__part")
    return out.withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], amount: Column, name: str = "upto", most: float | None = None) -> DataFrame:
    """Every row with the sum of ``amount`` over its key's rows up to it in ``order``; nulls count 0.

    With ``most`` only rows whose sum is at most that come back, amounts being 0 or more: ranges before which a key has
    spent it already are left out unsorted. Rows equal in ``order`` are summed in any order among themselves.
    """
    spent = rows.withColumns({"__key": _key(keys), "__v": F.coalesce(amount, F.lit(0))})
    laid = _ranged(spent, ["__key", *order], "running")
    offsets = _offsets(laid, "__v")
    if most is not None:
        offsets = offsets.filter(F.col("__before") <= most)
    own = F.sum("__v").over(W.partitionBy("__key", "__part").orderBy("__at").rowsBetween(W.unboundedPreceding, 0))
    out = laid.join(offsets, ["__key", "__part"]).withColumn(name, own + F.col("__before"))
    if most is not None:
        out = out.filter(F.col(name) <= most)
    return out.select(*rows.columns, name)


def nearest_ranks(rows: DataFrame, value: str, percents: Sequence[int], keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """D4 for groups of any size: keys, p<percent>, the smallest value that so many percent of the values do not exceed.

    Equal values are counted before they meet (``weight``: rows are such counts already). A rank lies in one range of
    its key, told by the ranges' counts; only such ranges are read again. Nulls are left out; keys may be null.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("__n"))
    laid = _ranged(counts.select(_key(keys).alias("__key"), F.col(value).alias("__value"), "__n"), ["__key", "__value"], "counts")
    ranks = F.array(*(F.struct(F.lit(p).alias("p"), F.ceil(F.col("__all") * p / 100).alias("rank")) for p in percents))
    hit = _offsets(laid, "__n").select("*", F.explode(ranks).alias("x")).filter("x.rank > __before AND x.rank <= __before + __sum")
    # A range that has several of the ranks is read once: what it must find travels as one row.
    hit = hit.groupBy("__key", "__part").agg(F.collect_list(F.struct("x.p", (F.col("x.rank") - F.col("__before")).alias("rank"))).alias("ranks"))
    own = F.sum("__n").over(W.partitionBy("__key", "__part").orderBy("__at").rowsBetween(W.unboundedPreceding, 0))
    found = laid.join(hit, ["__key", "__part"]).withColumn("__upto", own)
    found = found.select("__key", "__value", F.explode(F.filter("ranks", lambda r: (r["rank"] <= F.col("__upto")) & (r["rank"] > F.col("__upto") - F.col("__n")))).alias("x"))
    out = found.groupBy("__key").agg(*(F.max(F.when(F.col("x.p") == p, F.col("__value"))).alias(f"p{p}") for p in percents))
    return out.select(*(F.col(f"__key.{k}").alias(k) for k in keys), *(f"p{p}" for p in percents))
