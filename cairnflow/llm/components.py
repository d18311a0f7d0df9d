"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


#: Neighbours from which a vertex counts as hot, and parts that a hot vertex is split into.
HOT, PARTS = 100_000, 64
#: Up to so many edges the minima of all neighbourhoods are broadcast.
FEW = 50_000
#: Edges of one file, about.
FILE_EDGES = 20_000


def _step(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """One star step on ``n`` edges (a, b): neighbours are tied to the smallest of the neighbourhood.

    The minimum is aggregated before the shuffle and joined back, so no neighbourhood is gathered in one row. With
    more than ``FEW`` edges, hot vertices are split by neighbour in that join. The result may repeat an edge.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
    if n <= FEW:
        joined = both.join(F.broadcast(least.drop("degree")), "u")  # two rows an edge at most
    else:
        # A step makes no more edges than it is given, so at most 50,000 vertices are hot.
        is_hot = F.col("degree") > max(HOT, n // 25_000)
        split = F.broadcast(least.filter(is_hot).select("u", F.lit(PARTS).alias("parts")))
        parted = both.join(split, "u", "left").withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("v"), "parts")).otherwise(0).cast("int"))
        ends = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.when(is_hot, PARTS - 1).otherwise(0))))
        joined = parted.join(ends, ["u", "part"])
    if large:
        out = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a <> b")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) -> (id, component): every vertex with the smallest vertex it is connected to.

    Self loops and repeated edges are fine; an edge with a null end is ignored. After each round the edges
    are written, so a lost executor costs one round. Stops when a round changes nothing.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, mark = written(edges.distinct(), "stars"), None
    for _ in range(most_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            stars = edges.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "id")
            out = written(stars.unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()), "components")
            discard(edges)
            return out
        mark, last = now, edges
        step = _step(_step(edges, True, now[0]), False, now[0]).distinct()
        edges = written(step.coalesce(1 + now[0] // FILE_EDGES), "stars")
        discard(last)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
