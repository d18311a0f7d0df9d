"""Target-distribution importance resampling over hashed word n-grams.

A document's features are its runs of one to three words. Each falls into one of a fixed number of buckets by the
CRC-32 of its UTF-8 bytes. Buckets are counted over all documents and over the target texts, a bucket's gain is the
scaled logarithm of the ratio of its shares, a document's weight is the sum of its features' gains, and Gumbel noise
from the document's id turns the highest scores into a draw without replacement in proportion to exp(weight).

No n-gram is ever spelled out. CRC-32 is linear over GF(2): crc(a + b) = shift(crc(a), len(b)) ^ crc(b), where shift by
n bytes is a 32 x 32 bit matrix. A word's CRC is computed once, and those of its n-grams are composed from it with the
matrices, for all positions of a text at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import numbered
from .common import discard, require, short_batches, written

#: The reflected CRC-32 polynomial; the number of buckets; words of a run at most; parts of a unit of gain.
POLYNOMIAL = 0xEDB88320
BUCKETS = 10_000
WIDTH = 3
SCALE = 1000
#: Lengths below two to the power of this have a table of their own; what is above is shifted by powers of two.
SHORT_BITS = 6
#: Bytes of a text that are split into words at a time, about.
SLICE = 1 << 20

#: 0-9, a-z and all bytes of other characters stay, A-Z are lowered, anything else separates words.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def _tables(columns: np.ndarray) -> np.ndarray:
    """A bit matrix (the images of the 32 unit vectors) as four tables, by byte of the argument."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.stack([np.bitwise_xor.reduce(np.where(bits, columns[8 * j : 8 * j + 8], 0), axis=1) for j in range(4)]).astype(np.uint32)


def _times(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The matrix of ``tables`` applied to every element."""
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


@cache
def _short() -> np.ndarray:
    """Tables of the shifts by 0, 1, 2, ... bytes."""
    one = np.array([1 << i for i in range(32)], np.uint32)
    step = one
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
    by_one, columns, out = _tables(step), one, []
    for _ in range(1 << SHORT_BITS):
        out.append(_tables(columns))
        columns = _times(by_one, columns)
    return np.stack(out)


@cache
def _power(k: int) -> np.ndarray:
    """Tables of the shift by two to the power of ``k`` bytes."""
    if k < SHORT_BITS:
        return _short()[1 << k]
    half = _power(k - 1)
    return _tables(_times(half, _times(half, np.array([1 << i for i in range(32)], np.uint32))))


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What becomes of each CRC in a text that goes on for ``n`` more bytes, before those are added."""
    tables, low = _short(), n & ((1 << SHORT_BITS) - 1)
    out = tables[low, 0, crc & 255] ^ tables[low, 1, (crc >> 8) & 255] ^ tables[low, 2, (crc >> 16) & 255] ^ tables[low, 3, crc >> 24]
    high, k = n >> SHORT_BITS, SHORT_BITS
    while high.any():
        odd = (high & 1).astype(bool)
        out[odd] = _times(_power(k), out[odd])
        high, k = high >> 1, k + 1
    return out


class WordCrcs(dict):
    """CRC-32 of a word in the high half, its length in the low half; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = zlib.crc32(word) << 32 | len(word)
        if len(word) <= 64:
            self[word] = value
        return value


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in slices that end between words."""
    at = 0
    while len(text) - at > SLICE:
        end = text.find(b" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def buckets_of(text: bytes | None, crcs: WordCrcs, buckets: int = BUCKETS, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them) of every slice of a text."""
    space = np.array([zlib.crc32(b" ")], np.uint32)
    last = np.empty(0, np.uint64)
    for piece in _slices((text or b"").translate(_LETTERS)):
        words = piece.split()
        if not words:
            continue
        packed = np.concatenate([last, np.fromiter(map(crcs.__getitem__, words), np.uint64, len(words))])
        crc, n = (packed >> np.uint64(32)).astype(np.uint32), (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
        spaced = shifted(np.broadcast_to(space, crc.shape), n) ^ crc
        run, found = crc, [crc[len(last) :]]
        for k in range(1, min(width, len(crc))):
            run = shifted(run[:-1], n[k:] + 1) ^ spaced[k:]
            # Runs that end in a word of the slice before were counted there.
            found.append(run[max(0, len(last) - k) :])
        yield len(words), np.concatenate(found) % np.uint32(buckets)
        last = packed[len(packed) - min(width - 1, len(packed)) :]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """(bucket, n): features of all texts by bucket. A task sends one row for each bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs, total = WordCrcs(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for _, found in buckets_of(text.as_py(), crcs, buckets, width):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # a row for each bucket
        out[r.bucket] = r.n
    return out


def gains(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """Of every bucket the logarithm of its share among target features by its share among documents' features."""
    with short_batches(docs.sparkSession):
        s, t = (_vector(bucket_counts(x, buckets, width), buckets).astype(np.float64) for x in (docs, targets))
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    gain = np.asarray(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs = WordCrcs()
        for batch in batches:
            out = np.zeros((3, len(batch)), np.int64)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                for words, found in buckets_of(text.as_py(), crcs, len(gain), width):
                    out[:, i] += (words, len(found), gain[found].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id, in parts of ``SCALE``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(u))).cast("long")


def resample(docs: DataFrame, targets: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; rank is null where it is not drawn.

    docs: doc_id, text; targets: text; other columns are left aside. Of the documents with ``least_words`` words,
    floor(percent / 100) of their number are drawn: those of the highest scores, ties to the smaller doc_id, ranked from
    1. Null, empty and wordless texts have no features, weight 0, and are not drawn. A null doc_id counts as an empty
    one and comes last among ties; repeated rows are documents of their own, in any order among themselves. Empty
    targets leave the background alone to decide; an empty table gives no rows.
    """
    docs = require(docs, ["doc_id", "text"], "resample").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(docs, require(targets, ["text"], "resample"), buckets, width)
    found = weights(docs, gain, width)
    scored = written(found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("able", F.col("n_words") >= least_words), "scored")
    most = scored.filter("able").count() * percent // 100
    placed = numbered(scored, [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id")])
    discard(scored)
    drawn = F.col("able") & (F.col("place") <= most)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))
