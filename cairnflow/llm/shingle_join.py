"""N-gram Jaccard join with several global token orders.

A document is the set of its distinct word n-grams (shingles); two documents link when their Jaccard
similarity reaches a threshold t. If they do, then under *any* global order of shingles they share one
within the first p = n - ceil(t n) + 1 of each. Candidates must pass that test under three orders: by
document frequency (rarest first), and by two hash orders within frequency classes. What passes is
verified by counting. The steps:

1. Texts are read once. Some documents at a time form a pack, which sends each of its distinct shingles once
   to a bucket of the hash space: one that only one of its documents has, with that document's place in the
   pack; one that several have, with their number, while their places stay in the pack's own row. A bucket
   adds up document frequencies, and what it holds of one shingle grows with packs, not with documents.
   Shingles that occur once are not sent back: they take part in no pair and stand first in every order, so a
   document whose prefix holds none but such shingles has no links.
2. The packs meet their frequencies again; a document's prefixes under the three orders are made there.
   Documents with equal sets form a class; its smallest doc_id stands for it from here on.
3. Prefixes meet by shingle. Candidates are first drawn only between each document and a hub of the shingle, a
   few rounds; documents found connected need no further comparison, which spares a large group of near
   copies its square of pairs. Then all pairs of a shingle that are still in different components are
   candidates: none is left out. A frequent shingle is split by its documents in both kinds of join.

Shingles are compared by 64-bit hashes: two different ones of a pair of documents are taken for equal with a
chance of 1.4e-14 for texts of 500 words and 2.2e-11 for texts of 20,000, which matters only if the pair is
within one shingle of the threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, require, weighted_join, written
from .components import FEW, connected_components

WIDTH = 5
NUMERATOR, DENOMINATOR = 75, 100
#: Shingles of all packs that fall on one bucket of the frequency count, about.
BUCKET_TOKENS = 1_500_000
#: The least number of buckets is two to the power of this, so that they lie evenly on tasks.
LEAST_BITS = 8
#: A pack ends with so many documents or shingles.
PACK_ROWS = 1500
PACK_SHINGLES = 400_000
#: Documents of one shingle that a task compares at a time.
SPLIT = 4096


class WordHashes(dict):
    """64-bit hashes of words; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. With fewer than ``width`` words: the whole sequence as one.

    ``bytes`` methods do what the contract of words asks for: ``lower`` changes A-Z only, ``split`` cuts at
    the six ASCII white-space characters.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(w))
    acc = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - size + 1 + k])
    return np.unique(acc)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column whose cells are the bytes of ``values`` between neighbouring cuts."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(cuts) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _flat(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all cells of a binary column, one after the other, and where each cell begins."""
    cells = [np.frombuffer(x.as_buffer(), kind) for x in column]
    lengths = [len(x) for x in cells]
    return np.concatenate(cells) if cells else np.empty(0, kind), np.append(0, np.cumsum(lengths, dtype=np.int64))


#: docs, tokens: shingles of one document of the pack; several, counts: those of more. The other columns are the pack's own row.
_PACKED = ("docs", "tokens", "several", "counts", "ids", "sizes", "digests", "places", "owners")
_PACKED_SCHEMA = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), *((c, pa.binary()) for c in _PACKED)])


def _own_row(pack: int, cells: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A pack's own row, under a negative bucket of its own: documents, and who holds what several hold."""
    columns = {c: _binary(cells[c], np.array([0, len(cells[c])])) if c in cells else pa.array([b""], pa.binary()) for c in _PACKED}
    return pa.RecordBatch.from_arrays([pa.array([-1 - pack]), pa.array([pack]), *columns.values()], schema=_PACKED_SCHEMA)


def _pack(pack: int, ids: list[int], sets: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """The rows of one pack: its own, and one per bucket."""
    import xxhash

    digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
    # Equal sets within a pack count once; the smallest doc_id stands for them.
    chosen: dict[bytes, int] = {}
    for i in sorted(range(len(ids)), key=ids.__getitem__):
        if len(sets[i]):
            chosen.setdefault(digests[i], i)
    at = sorted(chosen.values())
    own = {"ids": np.array(ids, np.int64), "sizes": np.array([len(s) for s in sets], np.uint32), "digests": np.frombuffer(b"".join(digests), np.uint8)}
    if not at:
        yield _own_row(pack, own)
        return
    doc = np.repeat(np.array(at, np.uint16), [len(sets[i]) for i in at])
    token = np.concatenate([sets[i] for i in at])
    order = np.argsort(token)
    new = np.append(True, token[order[1:]] != token[order[:-1]])
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(token)))
    kind = np.empty(len(token), np.int64)
    kind[order] = np.cumsum(new) - 1
    repeated = count > 1
    mine = repeated[kind]
    several, counts = token[order[starts[repeated]]], count[repeated].astype(np.uint32)
    yield _own_row(pack, own | {"several": several, "owners": doc[mine], "places": (np.cumsum(repeated) - 1)[kind[mine]].astype(np.uint32)})
    doc, token = doc[~mine], token[~mine]
    shift = np.uint64(64 - bits)
    bucket = token >> shift
    by = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
    doc, token, bucket, other = doc[by], token[by], bucket[by], several >> shift
    buckets = np.union1d(bucket, other)
    cuts, others = np.append(np.searchsorted(bucket, buckets), len(bucket)), np.append(np.searchsorted(other, buckets), len(other))
    none = pa.array([b""] * len(buckets), pa.binary())
    columns = {"docs": _binary(doc, cuts), "tokens": _binary(token, cuts), "several": _binary(several, others), "counts": _binary(counts, others)}
    yield pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int64)), pa.array([pack] * len(buckets)), *(columns.get(c, none) for c in _PACKED)], schema=_PACKED_SCHEMA)


def _packed(docs: DataFrame, bits: int, width: int) -> DataFrame:
    """Rows of all packs of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, pack = WordHashes(), TaskContext.get().partitionId() << 24
        ids, sets, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                sets.append(shingles(text.as_py(), hashes, width))
                held += len(sets[-1])
                if len(ids) >= PACK_ROWS or held >= PACK_SHINGLES:
                    yield from _pack(pack, ids, sets, bits)
                    ids, sets, held, pack = [], [], 0, pack + 1
        if ids:
            yield from _pack(pack, ids, sets, bits)

    return docs.mapInArrow(run, "bucket long, pack long, " + ", ".join(f"{c} binary" for c in _PACKED))


_COUNTED_SCHEMA = pa.schema([*_PACKED_SCHEMA, ("df", pa.binary()), ("several_df", pa.binary())])


def _count(table: pa.Table) -> pa.Table:
    """Of one bucket, per pack: docs, tokens and df of shingles found twice or more, and df of those several have."""
    if table.column("bucket")[0].as_py() < 0:
        none = pa.array([b""] * len(table), pa.binary())
        return table.append_column("df", none).append_column("several_df", none)
    (token, cuts), (doc, _) = _flat(table.column("tokens"), "<u8"), _flat(table.column("docs"), "<u2")
    (several, others), (counts, _) = _flat(table.column("several"), "<u8"), _flat(table.column("counts"), "<u4")
    every = np.concatenate([token, several])
    weight = np.append(np.ones(len(token), np.int64), counts)
    order = np.argsort(every)
    starts = np.flatnonzero(np.append(True, every[order[1:]] != every[order[:-1]]))
    df = np.empty(len(every), np.uint32)
    df[order] = np.repeat(np.minimum(np.add.reduceat(weight[order], starts), (1 << 32) - 1), np.diff(np.append(starts, len(every))))
    keep = df[: len(token)] > 1
    left = np.append(0, np.cumsum(keep))[cuts]
    none = pa.array([b""] * len(table), pa.binary())
    columns = {
        "docs": _binary(doc[keep], left), "tokens": _binary(token[keep], left), "df": _binary(df[: len(token)][keep], left), "several_df": _binary(df[len(token) :], others),
    }
    return pa.table([table.column("bucket"), table.column("pack"), *(columns.get(c, none) for c in (*_PACKED, "df", "several_df"))], schema=_COUNTED_SCHEMA)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values, kind))


_SETS = "doc_id long, n_shingles long, digest binary, r int, tokens array<long>, df array<long>, second array<long>, third array<long>, bits2 long, bits3 long"


def _prefixes_of(numerator: int, denominator: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Of one pack, every document: its set's size and digest, and if it may have links (r > 0) the shingles
        it shares in order 1 (tokens; df of the first r), the first r hashes of orders 2 and 3, and their bits."""
        table = table.take(np.argsort(table.column("bucket").to_numpy(), kind="stable"))  # the own row is first
        flat = lambda c, kind: _flat(table.column(c), kind)[0]
        ids, n, digests = flat("ids", "<i8"), flat("sizes", "<u4").astype(np.int64), _flat(table.column("digests"), "u1")[0].tobytes()
        # Cells of ``several`` in bucket rows are empty now: the own row has them in the order of buckets.
        places, owners = flat("places", "<u4"), flat("owners", "<u2")
        doc = np.concatenate([flat("docs", "<u2"), owners]).astype(np.int64)
        token = np.concatenate([flat("tokens", "<u8"), flat("several", "<u8")[places]])
        df = np.concatenate([flat("df", "<u4"), flat("several_df", "<u4")[places]])
        shared = np.bincount(doc, minlength=len(ids))
        prefix = n - (numerator * n + denominator - 1) // denominator + 1
        # Shingles seen once lead every order and meet nobody: they use up the prefix first.
        r = np.where(n > 0, np.maximum(prefix - (n - shared), 0), 0)
        live = r[doc] > 0
        doc, token, df = doc[live], token[live], df[live]
        held = np.bincount(doc, minlength=len(ids))
        # Rows of a document lie together in every order, so its first r are told by their place in it.
        head = np.arange(len(doc)) - np.repeat(np.cumsum(held) - held, held) < np.repeat(r, held)

        def other(seed: int) -> tuple[np.ndarray, np.ndarray]:
            h = _mix(token ^ np.uint64(seed))
            first = h[np.lexsort((h, np.frexp(df.astype(np.float64))[1], doc))][head]
            bits = np.zeros(len(ids), np.uint64)
            np.bitwise_or.at(bits, np.repeat(np.arange(len(ids)), r), np.uint64(1) << (first & np.uint64(63)))
            return first, bits

        (second, bits2), (third, bits3) = other(0x6A09E667F3BCC909), other(0xBB67AE8584CAA73B)
        order = np.lexsort((token, df, doc))
        token, df = token[order], df[order]
        long = lambda x: x.view(np.int64)
        return pa.table({
            "doc_id": pa.array(ids), "n_shingles": pa.array(n), "digest": pa.array([digests[16 * i : 16 * i + 16] if k else None for i, k in enumerate(n)], pa.binary()),
            "r": pa.array(r, pa.int32()), "tokens": _lists(long(token), held, pa.int64()), "df": _lists(df[head].astype(np.int64), r, pa.int64()),
            "second": _lists(long(second), r, pa.int64()), "third": _lists(long(third), r, pa.int64()), "bits2": pa.array(long(bits2)), "bits3": pa.array(long(bits3)),
        })

    return run


def shingle_sets(docs: DataFrame, width: int = WIDTH, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """A row per document: doc_id, n_shingles, digest (null for an empty set), and what ``_prefixes_of`` says.

    Of equal sets in a pack only the smallest doc_id has r > 0.
    """
    words = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] / 6
    bits = max(LEAST_BITS, int(np.ceil(np.log2(words / BUCKET_TOKENS + 1))))
    counted = _packed(docs, bits, width).groupBy("bucket").applyInArrow(_count, "bucket long, pack long, " + ", ".join(f"{c} binary" for c in (*_PACKED, "df", "several_df")))
    return written(counted.groupBy("pack").applyInArrow(_prefixes_of(numerator, denominator), _SETS), "shingle_sets")


def _prefixes(sets: DataFrame) -> DataFrame:
    """A row per prefix shingle of order 1: id, n, c, left (shingles from here on), token, df, and bits of orders 2 and 3."""
    head = F.arrays_zip(F.slice("tokens", F.lit(1), F.col("r")).alias("token"), "df")
    rows = sets.select("id", "n", "c", F.size("tokens").alias("known"), "bits2", "bits3", F.posexplode(head).alias("at", "x"))
    return rows.select("id", "n", "c", (F.col("known") - F.col("at")).cast("long").alias("left"), "bits2", "bits3", F.col("x.token").alias("token"), F.col("x.df").alias("df"))


def _passes(numerator: int, denominator: int) -> Column:
    """What a pair must meet at its first shared prefix shingle: lengths, shingles left, and a bit of each other order."""
    n, m = F.col("a.n"), F.col("b.n")
    lengths = (m * denominator >= n * numerator) & (n * denominator >= m * numerator)
    # |A and B| >= t / (1 + t) (|A| + |B|), and nothing was shared before the first shared shingle.
    enough = F.least("a.left", "b.left") * (numerator + denominator) >= numerator * (n + m)
    others = (F.col("a.bits2").bitwiseAND(F.col("b.bits2")) != 0) & (F.col("a.bits3").bitwiseAND(F.col("b.bits3")) != 0)
    return lengths & enough & others


def _verified(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) that pass orders 2 and 3 and have the similarity."""
    side = lambda x: sets.select(*(F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "tokens", "second", "third")))
    both = pairs.join(side("a"), pairs["a"] == F.col("a_id")).join(side("b"), pairs["b"] == F.col("b_id"))
    both = both.filter(F.arrays_overlap("a_second", "b_second")).filter(F.arrays_overlap("a_third", "b_third"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    both = both.withColumn("common", common)
    union = F.col("a_n") + F.col("b_n") - F.col("common")
    return both.filter(denominator * F.col("common") >= numerator * union).select("a", "b")


def join(docs: DataFrame, width: int = WIDTH, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, hub_rounds: int = 3) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id for every document.

    docs: doc_id (unique, not null), text; other columns are left aside. Documents link when
    denominator x |intersection| >= numerator x |union|; component_id is the smallest doc_id reachable by
    links. Null, empty and blank texts have an empty set, link with nothing and are components of their
    own. Equal sets share class_id (their smallest doc_id). Rows with a null doc_id are left out; repeated
    rows of one doc_id with one text return as often. An empty table gives no rows.
    """
    docs = require(docs, ["doc_id", "text"], "join").select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    known = shingle_sets(docs, width, numerator, denominator)
    classes = known.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    classes = written(classes, "shingle_classes")
    sets = known.filter("r > 0").join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    sets = written(sets.withColumnsRenamed({"doc_id": "id", "n_shingles": "n"}).drop("digest"), "shingle_prefixes")
    found = _components(sets, numerator, denominator, hub_rounds)
    linked = classes.join(found, classes["first"] == found["id"], "left").select("digest", F.col("first").alias("class_id"), F.coalesce("component", "first").alias("component_id"), "copies")
    linked = written(linked.filter("copies > 1 OR component_id <> class_id"), "linked")
    out = weighted_join(known.select("doc_id", "n_shingles", "digest"), linked, "digest", "copies")
    return out.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _components(sets: DataFrame, numerator: int, denominator: int, hub_rounds: int) -> DataFrame:
    """(id, component) of every class that is in a component of two or more."""
    spark = sets.sparkSession
    found = spark.createDataFrame([], "id long, component long")
    passes = _passes(numerator, denominator)
    parts = (F.col("df") / SPLIT).cast("int")  # of a shingle, besides the first: the same for all its rows
    able = F.col("left") * (numerator + denominator) >= 2 * numerator * F.col("n")
    for k in range(hub_rounds + 1):
        known = F.broadcast(found) if found.count() <= FEW else found
        placed = _prefixes(sets.join(known, "id", "left").withColumn("c", F.coalesce("component", "id")))
        placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), parts + 1).cast("int"))
        hub = F.min_by(F.struct("id", "n", "left", "bits2", "bits3", "c"), F.xxhash64("id", F.lit(k)) if k else F.col("id"))
        buckets = placed.groupBy("token", "df").agg(F.min("c").alias("low"), F.max("c").alias("high"), hub.alias("hub"), F.count("*").alias("rows"), F.max(able).alias("able")).filter("low < high")
        if k < hub_rounds:
            hubs = buckets.select("token", F.explode(F.sequence(F.lit(0), parts)).alias("part"), "hub.*")
            pairs = placed.alias("a").join(hubs.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.c") != F.col("b.c")) & passes)
        else:
            # The smaller of a pair must have enough shingles left for a set of its own size: tokens without such a row have no
            # pair. Both of a pair of one size must, so each pair is met once, from its smaller (n, id).
            meet = buckets.filter("able").select("token", (F.col("rows") / SPLIT).cast("int").alias("parts"))
            mixed = written(placed.drop("part").join(meet, "token"), "mixed")
            # A row meets every part of the other side: what meets under a pair of parts is twice SPLIT rows, about.
            part = F.pmod(F.xxhash64("id"), F.col("parts") + 1).cast("int")
            every = F.explode(F.sequence(F.lit(0), "parts"))
            small = mixed.filter(able).select("*", part.alias("of_a"), every.alias("of_b"))
            large = mixed.select("*", part.alias("of_b"), every.alias("of_a"))
            first = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.id") < F.col("b.id")))
            met = (F.col("a.token") == F.col("b.token")) & (F.col("a.of_a") == F.col("b.of_a")) & (F.col("a.of_b") == F.col("b.of_b"))
            pairs = small.alias("a").join(large.alias("b"), met & (F.col("a.c") != F.col("b.c")) & first & passes)
        pairs = pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()
        links = written(_verified(pairs, sets, numerator, denominator), "links")
        if links.isEmpty():
            continue
        # Components found before come in as links to their smallest member.
        known = found.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        last, found = found, connected_components(links.unionByName(known))
        discard(links, last)
    return found
