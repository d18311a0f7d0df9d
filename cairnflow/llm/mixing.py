"""Mixing sources to target weights by iterative proportional fitting. Built-in functions only.

Token counts are summed into cells (source, language, topic). The cells are raked: scaled in turn to the
target share of every source, language and topic until all margins fit. A document is then drawn with a
probability in proportion to its cell's scale, by a hash of its id, so a rerun draws the same.
No probability exceeds 1, and that bound is part of the raking: see ``rake``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_CLASS, discard, written

DIMENSIONS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A coarse topic from form: lines that are licence notes, long texts, short texts."""
    t = F.coalesce(text, F.lit(""))
    notice = t.rlike(r"(?i)(all rights reserved|licen[cs]e|copyright)")
    return F.when(notice, "notice").when(F.length(t) >= 4000, "long").when(F.length(t) >= 1000, "medium").otherwise("short")


def tokens_of(text: Column) -> Column:
    """Words of a text, the unit in which weights are counted."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"{WORD_CLASS}+")).cast("long")


def tempered(cells: DataFrame, dim: str, alpha: float) -> DataFrame:
    """Target shares of one dimension: observed shares to the power ``alpha``, made to add up to 1."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(alpha)).alias("__t"))
    whole = sums.agg(F.sum("__t").alias("__all"))  # one row
    return sums.join(F.broadcast(whole)).select(dim, (F.col("__t") / F.col("__all")).alias("target"))


def present(cells: DataFrame, targets: DataFrame, dim: str) -> DataFrame:
    """Targets of the values that occur in ``cells`` (as ``__value``, ``__goal``), made to add up to 1."""
    seen = cells.select(F.col(dim).alias("__value")).distinct()
    found = seen.join(targets, F.col("__value").eqNullSafe(F.col(dim))).select("__value", "target")
    whole = found.agg(F.sum("target").alias("__sum"))  # one row
    return found.join(F.broadcast(whole)).select("__value", (F.col("target") / F.col("__sum")).alias("__goal"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float = 1.0, rounds: int = 8, per_write: int = 2, scales: int = 16, slack: float = 0.01) -> DataFrame:
    """cells: the dimensions and tokens > 0 -> the same with probability <= 1, whose expected draw has the margins of ``targets``.

    targets: by dimension, a frame (dimension, target share); values without a target get probability 0, and targets
    of absent values are shared among those present. A draw without repeats cannot give a value more than all its
    tokens, so the share of tokens kept is at most ``keep`` and what uses up the scarcest value. That share and
    ``scales`` - 1 smaller ones, each 0.8 of the one before, are raked at once, and the largest is taken whose worst
    margin is off by at most ``slack`` (of its target) more than the best.

    A step solves sum(min(tokens, a x tokens x multiplier)) = target for each value's factor a: in the order of
    multipliers the full cells come last, so running sums tell which are full and what the others share. Where no
    cell is full this is plain proportional fitting. Margins are sums over windows of the cell table, which has as
    many rows as combinations occur; its lineage is cut every ``per_write`` rounds. All margins fit where the cells
    allow it at some share; otherwise they come as near as the last round left them. An empty table stays empty.
    """
    dims = list(targets)
    live, every = cells, None
    for d in dims:
        goals = written(present(cells, targets[d], d), "goals")
        live = live.join(goals.withColumnsRenamed({"__value": f"__v{d}", "__goal": f"__{d}"}), F.col(f"__v{d}").eqNullSafe(F.col(d))).drop(f"__v{d}")
    live = written(live.filter(" AND ".join(f"`__{d}` > 0" for d in dims)), "live")
    every = live.agg(F.sum("tokens")).first()[0]
    if every is None:
        return cells.withColumn("probability", F.lit(0.0))
    high = keep
    for d in dims:
        room = live.groupBy(d).agg((F.sum("tokens") / F.lit(every) / F.first(f"__{d}")).alias("room")).agg(F.min("room")).first()[0]
        high = min(high, room)
    work = live.withColumn("__scale", F.explode(F.array(*(F.lit(high * 0.8**k) for k in range(scales))))).withColumn("__m", F.col("__scale"))
    for k in range(rounds):
        for d in dims:
            # One sort serves all sums of a step.
            ordered = W.partitionBy("__scale", d).orderBy("__m")
            upto, group = ordered.rowsBetween(W.unboundedPreceding, W.currentRow), ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
            full = F.sum("tokens").over(group) - F.sum("tokens").over(upto)  # tokens of cells with a greater multiplier
            work = work.withColumn("__a", (F.col("__scale") * every * F.col(f"__{d}") - full) / F.sum(F.col("tokens") * F.col("__m")).over(upto))
            own = F.max(F.when(F.col("__a") * F.col("__m") < 1, F.col("__a"))).over(group)
            work = work.withColumn("__m", F.col("__m") * F.coalesce(own, 1 / F.min("__m").over(group))).drop("__a")
        if (k + 1) % per_write == 0 or k + 1 == rounds:
            last, work = work, written(work, "rake")
            discard(last)
    work = work.withColumn("probability", F.least(F.lit(1.0), "__m"))
    drawn = F.sum(F.col("tokens") * F.col("probability"))
    whole = work.groupBy("__scale").agg(drawn.alias("__whole"))
    off = None
    for d in dims:
        have = work.groupBy("__scale", d).agg(drawn.alias("__have"), F.first(f"__{d}").alias("__goal"))
        one = have.join(F.broadcast(whole), "__scale").select("__scale", F.abs(F.col("__have") / F.col("__whole") / F.col("__goal") - 1).alias("off"))
        off = one if off is None else off.unionByName(one)
    worst = {r["__scale"]: r["off"] for r in off.groupBy("__scale").agg(F.max("off").alias("off")).collect()}  # as many rows as scales
    best = max(s for s, e in worst.items() if e <= min(worst.values()) + slack)
    kept = work.filter(F.col("__scale") == best).select(*cells.columns, "probability")
    same = [F.col(f"__k{d}").eqNullSafe(F.col(d)) for d in dims]
    rest = cells.join(kept.select(*(F.col(d).alias(f"__k{d}") for d in dims)), same, "left_anti")
    return kept.unionByName(rest.withColumn("probability", F.lit(0.0)))


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from the md5 of the columns, the same in every run and engine."""
    head = F.substring(F.md5(F.concat_ws("\x1f", *columns)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, alpha: float = 0.7, keep: float = 0.8, rounds: int = 8, text: str = "text", dims: Sequence[str] = DIMENSIONS, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every document with tokens, topic, probability and kept; other columns of ``docs`` stay in front.

    Targets default to tempered shares (``alpha`` < 1 lifts what is rare). The expected draw has their margins and
    the largest share of all tokens, up to ``keep``, that allows it (``rake``); a value that is to be lifted
    far costs tokens of the others. A column ``topic`` of ``docs`` is taken as the topic; columns named tokens,
    probability or kept are replaced. Null source or language form values of their own; a text without words has
    no weight to give and is kept. Repeated rows each count with their tokens; they draw the same number and stand
    or fall together. An empty table gives no rows. Cells grow with combinations, not rows: they are summed before
    any shuffle.
    """
    docs = docs.drop("tokens", "probability", "kept")
    own = docs.columns
    rich = docs.withColumn("tokens", tokens_of(F.col(text)))
    if "topic" not in own:
        rich = rich.withColumn("topic", topic_of(F.col(text)))
    cells = written(rich.filter("tokens > 0").groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "cells")
    goals = targets or {d: tempered(cells, d, alpha) for d in dims}
    chances = rake(cells, goals, keep, rounds)
    drawn = chances.select(*(F.col(d).alias(f"__{d}") for d in dims), "probability")
    on = [F.col(f"__{d}").eqNullSafe(F.col(d)) for d in dims]
    out = _spread(rich, written(drawn, "drawn"), on).drop(*(f"__{d}" for d in dims))
    out = out.withColumn("probability", F.when(F.col("tokens") == 0, 1.0).otherwise(F.coalesce("probability", F.lit(0.0))))
    return out.withColumn("kept", uniform(F.col("doc_id").cast("string"), F.lit("mix")) < F.col("probability"))


def _spread(rich: DataFrame, drawn: DataFrame, on: list[Column], salts: int = 32, most: int = 50_000) -> DataFrame:
    """Join the cell table to all documents although one cell may hold a third of them.

    At most ``most`` cells (some MB) are broadcast; more are joined by sorting, each repeated per salt.
    """
    if drawn.count() <= most:
        return rich.join(F.broadcast(drawn), on, "left")
    left = rich.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    right = drawn.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, F.col("__salt") == F.col("__part")], "left").drop("__salt", "__part")
