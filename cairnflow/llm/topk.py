"""Exact top-k inner products over shards by MaxScore.

A shard has postings: for every dimension and sign the rows whose component has that sign. A query's terms are
its dimensions; a row of a term's postings of the query's sign gains at most the term's bound (query weight times
the largest such component of the shard), every other row gains nothing. Terms are taken in the order of their
bounds. As long as the bounds of the terms left add up to the threshold (the k-th best score known) or more, a
row could reach it by them alone, so the next terms are essential and their postings are traversed; the threshold
rises meanwhile with the true scores of the best rows. The terms left over are non-essential: rows that
only they hold are never looked at. Rows still competitive are then probed: what they lose in essential
dimensions, then the non-essential dimensions, block by block, until the best possible score falls short.

A shard whose bounds all together miss the threshold is skipped. A task carries each query's k best from shard to
shard; the lists of all tasks are merged by rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, require, shared_dir, written

SCALE = 256
#: Components that a shard holds at most, unless one vector has more.
SHARD_CELLS = 1 << 21


class Shard:
    """Some vectors with their postings. Whole numbers are held as doubles, in which sums below 2**53 are exact."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.postings = {}
        for d in range(x.shape[1]):
            for sign in (1, -1):
                rows = np.flatnonzero(x[:, d] * sign > 0)
                self.postings[d, sign] = rows, np.abs(x[rows, d])
        most = lambda sign: np.array([self.postings[d, sign][1].max(initial=0.0) for d in range(x.shape[1])])
        self.high, self.low = most(1), most(-1)


def max_score(query: np.ndarray, own: int | None, shard: Shard, k: int, best: tuple[np.ndarray, np.ndarray] | None = None, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of ``best`` and the rows of ``shard``, ties to smaller ids, ``own`` left out.

    query and shard may differ in width: what one lacks is zero.
    """
    ids, scores = best if best is not None else (np.empty(0, np.int64), np.empty(0))
    x, n = shard.x, len(shard.ids)
    q = np.zeros(x.shape[1])
    q[: min(len(q), len(query))] = query[: len(q)]
    weight, sign = np.abs(q), np.where(q > 0, 1, -1)
    bound = weight * np.where(q > 0, shard.high, shard.low)
    order = np.argsort(-bound, kind="stable")
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)  # the most that the terms from here on add
    theta = scores[k - 1] if len(scores) >= k else -np.inf
    if rest[0] < theta or not n:
        return ids, scores
    gain, done = np.zeros(n), 0
    while done < len(order) and rest[done] >= theta:
        for d in order[done : done + step]:
            rows, values = shard.postings[d, sign[d]]
            gain[rows] += weight[d] * values
        done = min(done + step, len(order))
        if n > k:
            front = np.argpartition(gain, n - k - 1)[n - k - 1 :]
            true = np.sort((x[front] @ q)[shard.ids[front] != own] if own is not None else x[front] @ q)
            if len(true) >= k:
                theta = max(theta, true[-k])
    alive = np.flatnonzero(gain + rest[done] >= theta)
    essential, others = order[:done], order[done:]
    score = gain[alive] + np.minimum(x[np.ix_(alive, essential)] * q[essential], 0.0).sum(axis=1)
    for at in range(0, len(others), step):
        keep = score + rest[done + at] >= theta
        alive, score = alive[keep], score[keep]
        part = others[at : at + step]
        score = score + x[np.ix_(alive, part)] @ q[part]
    found = shard.ids[alive]
    if own is not None:
        found, score = found[found != own], score[found != own]
    ids, scores = np.append(ids, found), np.append(scores, score)
    first = np.lexsort((ids, -scores))[:k]
    return ids[first], scores[first]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of an array column as rows, shorter ones filled with zeros."""
    lengths = np.array([len(v) for v in column], np.int64)
    out = np.zeros((len(column), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _shards(batches: Iterable[pa.RecordBatch], shard_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of bounded size from batches of vec_id, x."""
    ids, parts, cells = [], [], 0

    def out() -> tuple[np.ndarray, np.ndarray]:
        width = max(p.shape[1] for p in parts)
        return np.concatenate(ids), np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            width = max(1, len(batch.column(1)[at]))
            have = sum(map(len, ids))
            room = max(1, min(shard_rows - have, (SHARD_CELLS - cells) // width))
            part = batch.slice(at, room)
            ids.append(part.column(0).to_numpy(zero_copy_only=False))
            parts.append(_matrix(part.column(1)))
            cells, at = cells + parts[-1].size, at + room
            if have + room >= shard_rows or cells >= SHARD_CELLS - width:
                yield out()
                ids, parts, cells = [], [], 0
    if ids:
        yield out()


def _search(shards: Iterable[tuple[np.ndarray, np.ndarray]], own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score: of every query the k best in all ``shards``."""
    best: list = [None] * len(own)
    for ids, x in shards:
        shard = Shard(ids, x)
        for i, q in enumerate(queries):
            best[i] = max_score(q, own[i], shard, k, best[i])
    for at in range(0, len(own), 2048):
        some = [(o, *b) for o, b in zip(own[at : at + 2048], best[at : at + 2048], strict=True) if b is not None]
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([o for o, _, _ in some], [len(i) for _, i, _ in some])), pa.array(np.concatenate([i for _, i, _ in some])), pa.array(np.concatenate([s for _, _, s in some]).astype(np.int64))],
                ["query_id", "vec_id", "score"],
            )


def integer_vector(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as double; null if the vector or a component is null or not finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale).cast("double")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, block_rows: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best vectors other than itself.

    vectors, queries: vec_id (not null), x (array<double> of whole numbers without nulls); other columns are left
    aside. A shorter vector counts as zero in the dimensions it lacks; null vectors take no part; fewer than ``k``
    candidates give all of them. Repeated rows of a vec_id are candidates each and one query (of different vectors
    the smallest); a query's candidates are all rows of other ids. An empty table gives no rows.

    Vectors are shuffled once, into shards of bounded size. Queries go to the shards in waves of about
    ``block_rows``, which bounds what is broadcast; with more than one wave the shards are written as a table that
    each wave reads, one after the other, and so are a wave's results. A task sends on k rows per query at most.
    """
    spark = vectors.sparkSession
    vectors = require(vectors, ["vec_id", "x"], "top_k").filter("vec_id IS NOT NULL AND x IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    queries = require(queries, ["vec_id", "x"], "top_k").filter("vec_id IS NOT NULL AND x IS NOT NULL")
    queries = queries.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("x").alias("x"))
    total, waves = vectors.count(), max(1, -(-queries.count() // block_rows))
    # Small tables are cut finer, for as many tasks as there are cores.
    shards = max(1, -(-total // shard_rows), min(spark.sparkContext.defaultParallelism, total // 1024))
    dealt = vectors.repartition(shards)
    if waves > 1:
        queries = written(queries, "queries")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, x in _shards(batches, shard_rows):
                yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<i8").tobytes()]), pa.array([x.astype("<f8").tobytes()])], ["ids", "x"])

        dealt = written(dealt.mapInArrow(pack, "ids binary, x binary"), "shards")

    def searched(wave: int) -> tuple[DataFrame, Broadcast]:
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave) if waves > 1 else queries
        rows = own.toArrow().combine_chunks()
        ids = rows.column("vec_id").to_numpy()
        sent = spark.sparkContext.broadcast((ids, _matrix(rows.column("x").chunk(0)) if len(ids) else np.zeros((0, 0))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if waves == 1:
                yield from _search(_shards(batches, shard_rows), *sent.value, k)
            else:
                rows = ((np.frombuffer(i.as_buffer(), "<i8"), np.frombuffer(x.as_buffer(), "<f8")) for b in batches for i, x in zip(b.column(0), b.column(1), strict=True))
                yield from _search(((i, x.reshape(len(i), -1)) for i, x in rows), *sent.value, k)

        found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), sent

    if waves == 1:
        return searched(0)[0]
    # One wave after the other: searched, written, and its queries released before the next is read.
    path = f"{shared_dir(spark)}/tables/top_k-{uuid.uuid4().hex}"
    for wave in range(waves):
        found, sent = searched(wave)
        found.write.mode("overwrite").parquet(f"{path}/wave={wave}")
        sent.destroy()
    discard(queries, dealt)
    return spark.read.schema(found.schema).parquet(path).drop("wave")
