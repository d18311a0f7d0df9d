"""All pairs of keys that share items, sent as packed differences (inventory C16, B25)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .joins import posting_blocks, sharing
from .ranks import running

#: Points per tile by which the bounds of tiles are told.
_POINTS = 64
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def all_sharing(edges: DataFrame, item: str, key: str, size: int = 1024, tile: int = 1 << 21) -> DataFrame:
    """Key, id, shared: all pairs of different keys that list a common item, with the number of items they share.

    Rows are sorted by item over ranges and cut into lists of ``size`` keys at most, which are written once. A tile is a
    range of keys whose lists hold about ``tile`` pairs (smaller key first). Tasks count the pairs of as many lists as make
    ``tile`` pairs, sort them and send each tile its pairs as compressed differences, about two bytes for a pair seen
    once; a tile adds them up, and each pair is told in both directions only there. A key with more pairs than a tile has
    several, dealt by the other key. Lists of one item meet by joins, so one that all keys list is no task's work alone.
    Keys that are no integers, and items that are neither integers nor text, go by :func:`sharing`.
    """
    rows = edges.select(F.col(item).alias("item"), F.col(key).alias("key")).filter("item IS NOT NULL AND key IS NOT NULL")
    kinds = dict(rows.dtypes)
    if kinds["key"] not in _INTEGERS or kinds["item"] not in _INTEGERS | {"string"}:
        known = edges.filter(F.col(key).isNotNull())
        return sharing(posting_blocks(known, item, key), known, item, key)
    rows = rows.withColumn("key", F.col("key").cast("long"))
    laid = rows.repartitionByRange("item", "key").sortWithinPartitions("item", "key")
    lists = written(laid.mapInArrow(partial(_lists, size=size), f"item {kinds['item']}, keys array<bigint>"), "sharing_lists")
    meet = _meetings(lists)
    points = running(meet.mapInArrow(partial(_points, step=max(1, tile // _POINTS)), "key bigint"), [], ["key"], F.lit(1), "upto")
    bounds = np.array(sorted(r.key for r in points.filter(F.col("upto") % _POINTS == 0).collect()), np.int64)
    sent = meet.mapInArrow(partial(_dealt, bounds=bounds, limit=tile), "tile int, m int, raw int, packed binary")
    tiles = sent.repartition(len(bounds) + 1, "tile").sortWithinPartitions("tile")
    met = tiles.mapInArrow(partial(_counted, limit=tile), "a bigint, b bigint, n bigint")
    told = lambda x, y: F.struct(F.col(x).cast(kinds["key"]).alias(key), F.col(y).cast(kinds["key"]).alias("id"), F.col("n").alias("shared"))
    return met.select(F.inline(F.array(told("a", "b"), told("b", "a"))))


def _meetings(lists: DataFrame) -> DataFrame:
    """keys, others: a list whose keys meet among themselves (others null), or two lists of one item, smaller keys first.

    Only lists that may not be all of their item name it.
    """
    none = F.lit(None).cast("array<bigint>").alias("others")
    parts = lists.filter("item IS NOT NULL").withColumn("at", F.element_at("keys", 1))
    heads = parts.select("item", "at")
    met = heads.join(heads.withColumnRenamed("at", "to"), "item").filter("at < to")
    cross = met.join(parts, ["item", "at"]).join(parts.select("item", F.col("at").alias("to"), F.col("keys").alias("others")), ["item", "to"])
    return lists.select("keys", none).unionByName(cross.select("keys", "others"))


def _lists(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """item, keys of sorted rows: distinct keys in lists of ``size`` at most; item is null where the list is all of it.

    The first and the last item of a partition may go on in another. An item's rows wait until the next one begins.
    """
    items = keys = None
    first, going = True, False  # the item that waits is the partition's first; it has sent lists already
    for batch in batches:
        if not batch.num_rows:
            continue
        items, keys = (batch.column(0), batch.column(1).to_numpy()) if items is None else (pa.concat_arrays([items, batch.column(0)]), np.concatenate([keys, batch.column(1).to_numpy()]))
        of = items.dictionary_encode().indices.to_numpy()
        new = np.r_[True, of[1:] != of[:-1]]
        kept = np.flatnonzero(new | np.r_[True, keys[1:] != keys[:-1]])
        items, keys, starts = items.take(pa.array(kept)), keys[kept], np.flatnonzero(new[kept])
        lengths = np.diff(np.r_[starts, len(keys)])
        waits = starts[-1] + (lengths[-1] - 1) // size * size
        partial_item = lengths > size
        partial_item[0] |= first or going
        yield _cut(items, keys, starts, lengths, partial_item, waits, size)
        first, going = first and len(starts) == 1, waits > starts[-1] or (going and len(starts) == 1)
        items, keys = items.slice(waits), keys[waits:]
    if items is not None:
        yield _cut(items, keys, np.array([0]), np.array([len(keys)]), np.array([True]), len(keys), size)


def _cut(items: pa.Array, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, partial_item: np.ndarray, upto: int, size: int) -> pa.RecordBatch:
    """The lists of the rows before ``upto``; a key that is alone with its item meets nobody."""
    run = np.repeat(np.arange(len(starts)), lengths)[:upto]
    at = np.flatnonzero((np.arange(upto) - starts[run]) % size == 0)
    n, named = np.diff(np.r_[at, upto]), partial_item[run[at]]
    use = np.flatnonzero(named | (n > 1))
    values = keys[:upto][np.repeat(named | (n > 1), n)]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n[use])].astype(np.int32)), pa.array(values))
    return pa.RecordBatch.from_arrays([items.take(pa.array(at[use], mask=~named[use])), lists], names=["item", "keys"])


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """key, start, n, pool: each key of a batch meets pool[start : start + n]."""
    for batch in batches:
        keys, others = batch.column(0), batch.column(1)
        ends, flat = keys.offsets.to_numpy(), keys.values.to_numpy()
        other_ends, n_others = others.offsets.to_numpy(), np.diff(others.offsets.to_numpy())
        at = np.arange(ends[0], ends[-1])
        of = np.repeat(np.arange(len(keys)), np.diff(ends))
        cross = n_others[of] > 0
        start = np.where(cross, len(flat) + other_ends[:-1][of], at + 1)
        n = np.where(cross, n_others[of], ends[1:][of] - at - 1)
        yield flat[at], start.astype(np.int64), n.astype(np.int64), np.concatenate([flat, others.values.to_numpy()])


def _points(batches: Iterator[pa.RecordBatch], step: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Of all pairs sorted by their smaller key, the key of every ``step``-th, ``most`` keys at a time."""
    keys, weights = [], []

    def points() -> pa.RecordBatch:
        key, weight = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(key)
        upto = np.cumsum(weight[order])
        found = key[order][np.searchsorted(upto, np.arange(step // 2, upto[-1], step), "right")]
        return pa.RecordBatch.from_arrays([pa.array(found)], names=["key"])

    for key, _, n, _ in _partners(batches):
        keys.append(key)
        weights.append(n)
        if sum(map(len, keys)) >= most:
            yield points()
            keys, weights = [], []
    if sum(map(len, keys)):
        yield points()


def _dealt(batches: Iterator[pa.RecordBatch], bounds: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """tile, m, raw, packed: the pairs of about ``limit`` meetings at a time, counted, by the tile of the smaller key."""
    a, b, held = [], [], 0
    for key, start, n, pool in _partners(batches):
        upto = np.cumsum(n)
        lo = 0
        while lo < len(key):
            before = upto[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, before + limit - held, "right")))
            count = n[lo:hi]
            a.append(np.repeat(key[lo:hi], count))
            b.append(pool[np.arange(upto[hi - 1] - before) + np.repeat(start[lo:hi] - (upto[lo:hi] - count - before), count)])
            held, lo = held + len(a[-1]), hi
            if held >= limit or lo < len(key):
                yield from _sent(a, b, bounds)
                a, b, held = [], [], 0
    yield from _sent(a, b, bounds)


def _sent(a: list[np.ndarray], b: list[np.ndarray], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not sum(map(len, a)):
        return
    x, y, n = _summed(_joined(a), _joined(b))
    tile = np.searchsorted(bounds, x, "right")
    several = tile - np.searchsorted(bounds, x, "left")
    if (several > 1).any():  # a key that is the bound of several tiles: the other key tells which
        mixed = (y.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        tile = np.where(several > 1, tile - mixed % np.maximum(several, 1), tile)
        order = np.argsort(tile, kind="stable")
        tile, x, y, n = tile[order], x[order], y[order], n[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]), len(tile)]
    for k in range(0, len(cuts) - 1, 256):
        ends = cuts[k : k + 257]
        packed = [_packed(x[i:j], y[i:j], n[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
        columns = [tile[ends[:-1]].astype(np.int32), np.diff(ends).astype(np.int32), np.array([p[0] for p in packed], np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([p[1] for p in packed], pa.binary())], names=["tile", "m", "raw", "packed"])


def _counted(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """a, b, n of rows sorted by tile: pairs with their counts, added up whenever they have doubled beyond ``limit``."""
    now, held, room, parts = None, 0, 2 * limit, ([], [], [])

    def told() -> Iterator[pa.RecordBatch]:
        found = _summed(*map(_joined, parts))
        for i in range(0, len(found[0]), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 17)]) for c in found], schema=_SCHEMA)

    for batch in batches:
        for tile, m, raw, packed in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
            if tile != now and held:
                yield from told()
                held, room = 0, 2 * limit
            now = tile
            for column, more in zip(parts, _unpacked(m, raw, packed.as_buffer()), strict=True):
                column.append(more)
            held += m
            if held > room:
                found = _summed(*map(_joined, parts))
                for column, more in zip(parts, found, strict=True):
                    column.append(more)
                held = len(found[0])
                room = max(room, 2 * held)
    if held:
        yield from told()


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """All parts in a new array; the list is emptied."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def _summed(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sums of their counts (each 1 by default); ``a`` and ``b`` are overwritten."""
    low, base = int(a.min()), int(b.min())
    span = int(b.max()) - base + 1
    ranks = None
    if (int(a.max()) - low + 1) * span >= 1 << 62:  # keys too far apart for one number of a pair: their places instead
        ranks = np.unique(np.concatenate([a, b]))
        a, b, low, base, span = np.searchsorted(ranks, a), np.searchsorted(ranks, b), 0, 0, len(ranks)
    a -= low
    a *= span
    b -= base
    a += b
    if n is None or n.max() == 1:
        a.sort()
        n = None
    else:
        order = np.argsort(a)
        a, n = a[order], n[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    n = np.diff(first, append=len(a)) if n is None else np.add.reduceat(n, first)
    a, b = np.divmod(a[first], span)
    a += low
    b += base
    return (a, b, n) if ranks is None else (ranks[a], ranks[b], n)


def _packed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[int, bytes]:
    """Sorted pairs as differences, byte by byte of all, compressed; with the length before."""
    step = np.diff(a, prepend=0)
    gap = np.diff(b, prepend=0)
    new = np.r_[True, step[1:] != 0]
    gap[new] = b[new] - a[new]
    raw = b"".join(map(_bytes, (step, gap, n)))
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _bytes(x: np.ndarray) -> bytes:
    x = x.view(np.uint64)
    most = int(x.max())
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _unpacked(m: int, raw: int, packed: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, at, found = np.frombuffer(pa.decompress(packed, raw, codec="zstd"), np.uint8), 0, []
    for _ in range(3):
        width = int(data[at])
        planes = data[at + 1 : at + 1 + m * width].reshape(width, m)
        found.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))
        at += 1 + m * width
    step, gap, n = found
    a, upto = np.cumsum(step), np.cumsum(gap)
    new = np.r_[True, step[1:] != 0]
    return a, upto + (a - upto + gap)[new][np.cumsum(new) - 1], n
