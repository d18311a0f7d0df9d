"""Graph operators (inventory I1, I2)."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written


#: Levels that are held as tables of their own.
LEVELS = 6


def impact(edges: DataFrame, start: DataFrame, most_depth: int | None = None) -> DataFrame:
    """Edges (src uses dst), start (id) -> (origin, id, depth) of all that depend on a start vertex.

    A frontier loop: each round joins only what was new, so cycles end and nothing is collected. It goes on until
    nothing is new, unless ``most_depth`` asks for so many levels only.
    """
    # Written once: each round reads it instead of planning the edges anew.
    used_by = written(edges.select(F.col("dst").alias("at"), F.col("src").alias("next")).distinct(), "used_by")
    front = start.select(F.col("id").alias("origin"), "id").distinct().withColumn("depth", F.lit(0))
    seen, stale = [front], []
    for depth in count(1) if most_depth is None else range(1, most_depth + 1):
        new = front.join(used_by, front["id"] == used_by["at"]).select("origin", F.col("next").alias("id")).distinct()
        new = new.join(reduce(DataFrame.unionByName, seen).select("origin", "id"), ["origin", "id"], "left_anti").withColumn("depth", F.lit(depth))
        new = written(new, "front")
        if new.isEmpty():
            discard(new)
            break
        front = new
        seen.append(front)
        if len(seen) > LEVELS:
            # Levels become one table, so that plans stay short; the last is still the front.
            whole = written(reduce(DataFrame.unionByName, seen), "seen")
            discard(*stale, *seen[:-1])
            seen, stale = [whole], [front]
    return reduce(DataFrame.unionByName, seen).filter("depth > 0")


def impact_summary(found: DataFrame, total: int) -> DataFrame:
    """Direct, indirect and share of ``total`` per origin."""
    return found.groupBy("origin").agg(F.count_if(F.col("depth") == 1).alias("direct"), F.count_if(F.col("depth") > 1).alias("indirect"), (F.count("*") / F.lit(float(total))).alias("share"))


def _spread(start: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(id, color): every vertex with the greatest color that reaches it along ``edges`` (at, next) from ``start``.

    Only vertices that changed pass their color on; each round is written, so a lost executor costs one.
    """
    rows = written(start.withColumn("new", F.lit(True)), name)
    while True:
        passed = edges.join(rows.filter("new"), edges["at"] == rows["id"]).select(F.col("next").alias("id"), "color")
        both = rows.select("id", "color", F.col("color").alias("was")).unionByName(passed.withColumn("was", F.lit(None).cast(rows.schema["color"].dataType)))
        best = both.groupBy("id").agg(F.max("color").alias("color"), F.max("was").alias("was"))
        last, rows = rows, written(best.select("id", "color", (F.col("color") > F.col("was")).alias("new")), name)
        discard(last)
        if rows.filter("new").isEmpty():
            return rows.select("id", "color")


def strong_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex on a cycle of two or more: component is the greatest vertex of its cycle group.

    edges (src, dst). Vertices without a way in or out are on no cycle and are peeled off, round by round. Of the rest,
    every vertex takes the greatest vertex that leads to it as its color; those that lead back to the vertex of their
    color, within the color, form a component. What is left goes round again.
    """
    left = written(edges.filter("src <> dst").select("src", "dst").distinct(), "edges")
    found = []
    size = left.count()
    while size:
        while True:  # peel
            ins, outs = left.select(F.col("dst").alias("src")).distinct(), left.select(F.col("src").alias("dst")).distinct()
            last, left = left, written(left.join(ins, "src", "left_semi").join(outs, "dst", "left_semi").select("src", "dst"), "edges")
            discard(last)
            if (now := left.count()) == size:
                break
            size = now
        if not size:
            break
        own = left.select(F.col("src").alias("id")).distinct().withColumn("color", F.col("id"))
        colors = _spread(own, left.toDF("at", "next"), "colors")
        tail, head = colors.toDF("src", "__s"), colors.toDF("dst", "__d")
        same = written(left.join(tail, "src").join(head, "dst").filter("__s = __d").select(F.col("dst").alias("at"), F.col("src").alias("next")), "same_color")
        back = _spread(colors.withColumn("color", (F.col("id") == F.col("color")).cast("int")), same, "returned").filter("color = 1")
        found.append(written(colors.join(back.select("id"), "id").select("id", F.col("color").alias("component")), "components"))
        for end in ("src", "dst"):
            left = left.join(found[-1].select(F.col("id").alias(end)), end, "left_anti")
        left = written(left.select("src", "dst"), "edges")
        size = left.count()
    kind = edges.schema["src"].dataType.simpleString()
    out = edges.sparkSession.createDataFrame([], f"id {kind}, component {kind}")
    for part in found:
        out = out.unionByName(part)
    return out


def impact_of_all(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Id, direct, indirect, affected, share of every node: how many depend on it, and their share of all nodes.

    nodes (id), edges (src uses dst) among them; a node is not counted as its own dependant. Cycles are condensed first,
    so a cycle group of k vertices is one vertex of weight k and not k x k pairs; then reached groups spread along the
    graph without cycles, level by level. ``share`` is rounded to three digits, as it is shown.
    """
    edges = written(edges.filter("src <> dst").select("src", "dst").distinct(), "edges")
    cycles = strong_components(edges)
    placed = written(nodes.select("id").distinct().join(cycles, "id", "left").select("id", F.coalesce("component", "id").alias("component")), "placed")
    weights = placed.groupBy("component").agg(F.count("*").alias("weight"))
    tail, head = placed.toDF("src", "__s"), placed.toDF("dst", "__d")
    between = edges.join(tail, "src").join(head, "dst").filter("__s <> __d").select(F.col("__s").alias("src"), F.col("__d").alias("dst")).distinct()
    reached = impact(between, weights.select(F.col("component").alias("id")))
    above = reached.join(weights.withColumnRenamed("component", "id"), "id").groupBy(F.col("origin").alias("component")).agg(F.sum("weight").alias("above"))
    direct = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("direct"))
    out = placed.join(weights, "component").join(above, "component", "left").join(direct, "id", "left")
    affected, one = F.col("weight") - 1 + F.coalesce("above", F.lit(0)), F.coalesce("direct", F.lit(0))
    size = nodes.select("id").distinct().count()
    return out.select("id", one.alias("direct"), (affected - one).alias("indirect"), affected.alias("affected"), F.round(affected / F.lit(float(max(size, 1))), 3).alias("share"))


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    known = nodes.select("id").distinct()
    no_src = edges.join(known, edges["src"] == known["id"], "left_anti").select("src", "dst", F.lit("src").alias("missing"))
    no_dst = edges.join(known, edges["dst"] == known["id"], "left_anti").select("src", "dst", F.lit("dst").alias("missing"))
    return no_src.unionByName(no_dst)
