"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents are encoded once in Arrow batches; only (document, piece, length) triples are shuffled. Pieces
of full length need no packing. The others are dealt into shards of about ``shard_pieces`` pieces by a
hash, and each shard is packed alone: each piece is put where the sum over all gaps g of (open bins with
gap g) squared becomes smallest (Csirik et al., "On the sum-of-squares algorithm for bin packing"). A
shard holds a bounded number of pieces whatever the input; it leaves some tens of bins partly filled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import public_encoder
from .common import require, written

CAPACITY = 2048
END = 0


def sum_of_squares(lengths: np.ndarray, capacity: int, any_fit: bool = False) -> np.ndarray:
    """Bin number of each item. Items are placed in the order given; 0 < length <= capacity.

    Moving one bin from gap g to g - s changes the sum of squares by 2 (N[g - s] - N[g] + 1); opening one
    adds 2 N[capacity - s] + 1; closing one (g = s) leaves 1 - 2 N[g]. Ties go to the smallest gap, a new
    bin last. Within a gap the bin last put there is taken. With ``any_fit`` a new bin is opened only where no
    open one has room, so that the rule chooses among open bins.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(lengths), np.int64)
    bins = 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            out[i], bins = bins, bins + 1
            continue
        now = count[s:capacity]
        change = 2 * (count[: capacity - s] - now + 1)
        change[0] = 1 - 2 * now[0]
        change[now == 0] = np.iinfo(np.int64).max
        k = int(change.argmin())
        if now[k] and (any_fit or change[k] <= 2 * count[capacity - s] + 1):
            gap, where = s + k, stacks[s + k].pop()
            count[gap] -= 1
        else:
            gap, where, bins = capacity, bins, bins + 1
        out[i] = where
        if gap > s:
            count[gap - s] += 1
            stacks[gap - s].append(where)
    return out


def encode_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, encoder=public_encoder) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids as little-endian uint32 bytes.

    Null text counts as empty: the end token alone. Only documents of more than ``capacity`` tokens are
    cut; of those the first piece takes the remainder, so that every other piece is full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows: list[tuple] = []
                part = batch.slice(at, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(enc.encode(text or ""), np.array([end], "<u4"))
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        raw = ids[a:b].astype("<u4").tobytes()
                        rows.append((doc, piece, a, b - a, zlib.crc32(raw), raw))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def fewest_bins(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sum-of-squares packing, the best of some: longest first with any fit, and, unless that leaves no bin to
    spare, with the plain rule as given, long items first, longest first."""
    given, longest = np.arange(len(lengths)), np.argsort(-lengths, kind="stable")
    least, best = -(-int(lengths.sum()) // capacity), None
    for order, any_fit in ((longest, True), (given, False), (np.argsort(lengths <= capacity // 4, kind="stable"), False), (longest, False)):
        bins = sum_of_squares(lengths[order], capacity, any_fit)
        if best is None or bins.max() < best.max():
            best = np.empty_like(bins)
            best[order] = bins
        if best.max() < least:
            break
    return best


def _pack_shard(pdf):
    pdf = pdf.sort_values(["__order", "item"], ignore_index=True)
    lengths = pdf["length"].to_numpy()
    bins = fewest_bins(lengths, int(pdf["capacity"].iloc[0]))
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    out = pdf.iloc[order][["item", "length"]]
    return out.assign(bin=bins[order] + (pdf["__shard"].iloc[0] << 32), offset=before - (np.cumsum(fill) - fill)[bins[order]])


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = 200_000) -> DataFrame:
    """item long, length long -> item, length, bin, offset, by sum of squares in shards of bounded size.

    Items come in the order of a hash of their number, so a rerun packs alike.
    """
    shards = max(1, -(-items.count() // shard_pieces))
    return (
        items.select(
            "item", "length", F.lit(capacity).alias("capacity"), F.xxhash64("item").alias("__order"),
            F.pmod(F.xxhash64(F.lit("shard"), "item"), F.lit(shards)).alias("__shard"),
        )
        .groupBy("__shard")
        .applyInPandas(_pack_shard, "item long, length long, bin long, offset long")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, shard_pieces: int = 200_000, with_ids: bool = True) -> DataFrame:
    """Pack every document: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    docs: doc_id, text; other columns are left aside. A null or empty text is the end token alone; a
    repeated row is packed as often as it occurs; a null doc_id is carried along; an empty table gives no
    rows. Full pieces stand alone in negative sequence_ids, the rest is packed by :func:`pack_lengths`.
    """
    docs = require(docs, ["doc_id", "text"], "pack")
    pieces = encode_pieces(docs, capacity, end)
    pieces = pieces if with_ids else pieces.drop("ids")
    pieces = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == capacity)
    full = full.select("*", (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.filter(F.col("length") < capacity)
    bins = pack_lengths(part.select(F.col("__row").alias("item"), "length"), capacity, shard_pieces)
    placed = part.join(bins.select(F.col("item").alias("__row"), F.col("bin").alias("sequence_id"), "offset"), "__row")
    return full.unionByName(placed).drop("__row")
