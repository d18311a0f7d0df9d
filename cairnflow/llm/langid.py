"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and n-grams of 1 to 3 characters are
hashed. A feature's value is its share of the text's n-grams times its inverse document frequency. The
weights are fitted by follow-the-regularised-leader (FTRL-Proximal), whose L1 term leaves most at zero,
and probabilities are calibrated by one temperature on rows held out of the fit. Document frequencies are
counted over all documents of the learning folds; the fit runs on a bounded sample of distinct texts, drawn
per language; prediction reads whole texts in Arrow batches and shuffles nothing.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import require, short_batches

BITS = 18
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_SPACE = 32


@functools.lru_cache(maxsize=1)
def letters() -> Letters:
    return Letters()


class Letters:
    """Maps code points to lower-case letters, others to a space; the table is made once per worker."""

    def __init__(self):
        self.table = np.full(0x110000, _SPACE, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                self.table[c] = ord(low) if len(low) == 1 else c

    def __call__(self, text: str) -> np.ndarray:
        """The letters of a text with single spaces between and around words; empty without letters."""
        code = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        space = code == _SPACE
        keep = ~(space & np.append(True, space[:-1]))
        code = code[keep]
        if len(code) == 0:
            return code
        code = np.append(np.uint32(_SPACE), code)
        return code if code[-1] == _SPACE else np.append(code, np.uint32(_SPACE))


def grams(code: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hashed n-grams of all orders; the single space is none."""
    out = []
    acc = np.zeros(len(code), np.uint64)
    for n in ORDERS:
        if len(code) < n:
            break
        acc = (acc[: len(code) - n + 1] + code[n - 1 :].astype(np.uint64) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
        slot = ((acc * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)
        out.append(slot[code != _SPACE] if n == 1 else slot)
    return np.concatenate(out) if out else np.empty(0, np.int64)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # slot x language: inverse document frequency times weight
    bias: np.ndarray
    temperature: float = 1.0
    facts: dict = field(default_factory=dict)

    def logits(self, slots: np.ndarray) -> np.ndarray:
        """Sum over distinct n-grams of share x idf x weight, taken as the mean over all occurrences."""
        return self.table[slots].mean(axis=0) + self.bias

    def predict(self, slots: np.ndarray) -> tuple[str, float]:
        if not self.languages or not len(slots):
            return UNKNOWN, 0.0
        z = self.logits(slots).astype(np.float64) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def sparse_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, slots array<int>, counts array<int>: bounded by the hash space whatever the text's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_code = letters()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, found = batch.slice(at, 128), []
                for text in part.column(1):
                    found.append(np.unique(grams(to_code(text.as_py() or "")), return_counts=True))
                cuts = pa.array(np.append(0, np.cumsum([len(s) for s, _ in found])), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x), pa.int32())) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(2).cast(pa.string()), *lists], ["doc_id", "lang", "slots", "counts"])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, lang string, slots array<int>, counts array<int>")


def document_frequencies(docs: DataFrame, bits: int = BITS) -> tuple[int, np.ndarray]:
    """Number of texts with letters, and of those that hold each slot; a task sends one counter per slot at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_code, seen, n = letters(), np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                slots = grams(to_code(text.as_py() or ""), bits)
                if len(slots):
                    n += 1
                    seen[np.unique(slots)] += 1
        at = np.flatnonzero(seen)
        for k in range(0, len(at), 1 << 16):
            part = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], ["slot", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([n], pa.int64())], ["slot", "n"])

    with short_batches(docs.sparkSession):
        sums = docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # 2**bits + 1 rows at most
    out = np.zeros((1 << bits) + 1, np.int64)
    out[sums.column("slot").to_numpy()] = sums.column("n").to_numpy()  # slot -1 is the last
    return int(out[-1]), out[:-1]


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], frequencies: tuple[int, np.ndarray] | None = None, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-5, epochs: int = 4, bits: int = BITS) -> Model:
    """rows: (language, slots, counts), in the order of training; every fifth calibrates. No rows: a model of ``und``.

    frequencies: those of ``document_frequencies``; without them, the rows are counted.
    """
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    size = 1 << bits
    if not languages:
        return Model([], np.zeros((size, 1), np.float32), np.zeros(1, np.float32))
    if frequencies is None:
        seen = np.zeros(size)
        for _, slots, _ in rows:
            seen[slots] += 1
        frequencies = len(rows), seen
    idf = np.log((1 + frequencies[0]) / (1 + frequencies[1])) + 1
    k = len(languages)
    # The last slot is the bias: a feature of value 1 in every text.
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))
    index = {x: i for i, x in enumerate(languages)}
    train = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 50]
    held = [r for i, r in enumerate(rows) if i % 5 == 0] if len(rows) >= 50 else train

    def weights(slots: np.ndarray) -> np.ndarray:
        zs, ns = z[slots], n[slots]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    # Values are small shares; one factor brings them to the order of 1 for the fit.
    gain = 30.0
    for _ in range(epochs):
        for lang, slots, counts in train:
            x = np.append(gain * idf[slots] * counts / counts.sum(), 1.0)
            slots = np.append(slots, size)
            w = weights(slots)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[index[lang]] -= 1.0
            g = x[:, None] * p
            before = n[slots]
            n[slots] = before + g * g
            z[slots] += g - (np.sqrt(n[slots]) - np.sqrt(before)) / alpha * w
    w = weights(np.arange(size + 1))
    w, bias = w[:size], w[size]
    table = (gain * idf[:, None] * w).astype(np.float32)
    model = Model(languages, table, bias.astype(np.float32))
    scores = np.array([table[s].T @ (c / c.sum()) + bias for _, s, c in held])
    truth = np.array([index[lang] for lang, _, _ in held])

    # Targets are smoothed as if one held row in each class were wrong, else separable data give certainty.
    smooth = 1 / (len(held) + 2)

    def loss(t: float) -> float:
        q = scores / t
        q = q - q.max(axis=1, keepdims=True)
        norm = np.log(np.exp(q).sum(axis=1))
        return float((norm - (1 - smooth) * q[np.arange(len(q)), truth] - smooth * q.mean(axis=1)).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    model.temperature = float(min(grid, key=loss))
    model.facts = {"documents": frequencies[0], "rows": len(train), "held": len(held), "loss": loss(model.temperature), "nonzero": int((w != 0).any(axis=1).sum())}
    return model


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves remainder 0 by 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def quotas(texts: dict[str, int], sample_rows: int) -> dict[str, int]:
    """Rows of each language: equal shares of ``sample_rows``, where what a language lacks goes to the others."""
    out, left = {}, sample_rows
    for i, (lang, n) in enumerate(sorted(texts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, left // (len(texts) - i))
        left -= out[lang]
    return out


def sample(usable: DataFrame, sample_rows: int) -> DataFrame:
    """doc_id, lang, text of at most ``sample_rows`` distinct texts, by ``quotas``, with the smallest text hashes.

    Hashes above what twice a language's quota needs are dropped where they lie; copies have one hash and are
    combined before any shuffle.
    """
    keys = usable.select("doc_id", "lang", F.xxhash64("text").alias("__h"))
    texts = {r.lang: r.n for r in keys.groupBy("lang").agg(F.approx_count_distinct("__h", 0.02).alias("n")).collect()}  # a row per language
    # The counts are estimates, so small languages are asked for a little more than counted.
    quota = quotas({lang: n + n // 10 + 1 for lang, n in texts.items()}, sample_rows)
    bound = [(lang, quota[lang], min(1.0, (2 * quota[lang] + 50) / max(n, 1))) for lang, n in texts.items()]
    spark = usable.sparkSession
    bounds = F.broadcast(spark.createDataFrame(bound, "lang string, __quota int, __rate double"))
    near = keys.join(bounds, "lang").filter(F.col("__h").cast("double") / F.lit(2.0**64) + 0.5 <= F.col("__rate"))
    near = near.groupBy("lang", "__quota", "__h").agg(F.min("doc_id").alias("doc_id"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("__h"))
    chosen = near.withColumn("__rank", rank).filter("__rank <= __quota").select("doc_id", "lang", "__h")
    found = usable.withColumn("__h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "lang", "__h"], "left_semi")  # bounded by sample_rows
    return found.select("doc_id", "lang", "text").dropDuplicates(["doc_id", "lang"])


def train(docs: DataFrame, sample_rows: int = 3000) -> Model:
    """Fit on a ``sample`` of labelled documents outside the held-out fold, whose document frequencies are of all of them."""
    docs = require(docs, ["doc_id", "text", "lang"], "train").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    usable = docs.filter(~held_out(F.col("doc_id")))
    rows = sparse_features(sample(usable, sample_rows)).orderBy(F.xxhash64("doc_id"), "lang").limit(sample_rows).toArrow()
    lists = [[x.values.to_numpy() for c in rows.column(name).chunks for x in c] for name in ("slots", "counts")]
    langs = rows.column("lang").to_pylist()
    return fit(list(zip(langs, *lists, strict=True)), document_frequencies(usable))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred and score of every row's whole text.

    A null text or one without letters is ``und`` with score 0, as is every text under an empty model. The
    model is a table of fixed size (2**18 slots), sent once to each executor.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [*keep, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, to_code = sent.value, letters()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = [m.predict(grams(to_code(t))) if t else (UNKNOWN, 0.0) for t in map(lambda t: t.as_py(), part.column(len(keep)))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], names)

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "lang_pred string", "score double"])
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def crc_fold(doc_id: int) -> int:
    """The fold of an id, outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 5
