"""Structured Streaming operators (inventory J1-J8, A8)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, remove, written


def json_feed(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """JSON lines files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def parquet_feed(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def latest_changes(changes: DataFrame, key: str, at: str) -> DataFrame:
    """The last change of each key in a batch, which is what a debounced feed would act on."""
    last = changes.groupBy(key).agg(F.max_by(F.struct(*[c for c in changes.columns if c != key]), at).alias("r"))
    return last.select(key, "r.*")


def apply_changes(state: DataFrame, changes: DataFrame, key: str, at: str, action: str = "action") -> DataFrame:
    """State after add / change / unlink of the latest change per key; deleted keys leave reference arrays too.

    ``used_by``, where the state has it, loses the deleted keys.
    """
    last = latest_changes(changes, key, at)
    values = [c for c in state.columns if c != key]
    kept = state.join(last.select(key), key, "left_anti")
    put = last.filter(F.col(action) != "unlink").select(key, *(F.col(c) if c in last.columns else F.lit(None).cast(state.schema[c].dataType).alias(c) for c in values))
    out = kept.unionByName(put)
    if "used_by" not in values:
        return out
    gone = last.filter(F.col(action) == "unlink").select(F.col(key).alias("__ref"))
    refs = out.select(key, F.explode("used_by").alias("__ref")).join(gone, "__ref", "left_anti").groupBy(key).agg(F.sort_array(F.collect_set("__ref")).alias("used_by"))
    return out.drop("used_by").join(refs, key, "left").withColumn("used_by", F.coalesce("used_by", F.array().cast("array<string>")))


#: Buckets of a state unless the sink is told otherwise; a state keeps the number it began with.
BUCKETS = 64


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert_sink(state_path: str, key: str, at: str, buckets: int = BUCKETS):
    """A foreachBatch function that keeps a state as Parquet in ``buckets`` buckets by key.

    A batch reads and writes only the buckets that it touches, below ``state_path/v=<batch>/bucket=<n>``, and then a
    manifest ``state_path/m=<batch>`` that names the version in force of every bucket, a row each. Readers follow the
    highest whole manifest, so a batch that failed half-way has changed nothing, and its rerun starts from the manifest
    below it. A removed key also leaves the ``used_by`` lists of others: only for that are other buckets looked through,
    and only those that name it are written. Versions that the last two manifests do not name are deleted.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in whole_versions(spark, state_path) if v < batch_id]
        known, schema = _manifest(spark, state_path, before[-1]) if before else ({}, batch.drop("action").schema)
        n = len(known) or buckets
        changes = written(latest_changes(batch, key, at).withColumn("bucket", _bucket(F.col(key), n)), "changes")  # one row a key
        touched = {r.bucket for r in changes.select("bucket").distinct().collect()}
        if "used_by" in schema.fieldNames() and known:
            gone = changes.filter("action = 'unlink'").select(F.col(key).alias("__ref"))
            if not gone.isEmpty():
                named = _read_buckets(spark, state_path, known, schema).select("bucket", F.explode("used_by").alias("__ref")).join(gone, "__ref", "left_semi")
                touched |= {r.bucket for r in named.select("bucket").distinct().collect()}
        old = _read_buckets(spark, state_path, {b: v for b, v in known.items() if b in touched}, schema).drop("bucket")
        new = apply_changes(old, changes.drop("bucket"), key, at).withColumn("bucket", _bucket(F.col(key), n))
        new.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{state_path}/v={batch_id:09d}")
        discard(changes)
        held = {b: batch_id if b in touched else known.get(b, -1) for b in range(n)}
        rows = spark.createDataFrame([(b, v, schema.json()) for b, v in sorted(held.items())], "bucket int, version long, state string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{state_path}/m={batch_id:09d}")
        if len(before) > 1:
            _clean(spark, state_path, {*held.values(), *known.values()}, before[:-1])

    return run


def _clean(spark: SparkSession, state_path: str, in_force: set[int], manifests: list[int]) -> None:
    """Delete manifests that are superseded, and versions that none of those left names."""
    for version in manifests:
        remove(spark, f"{state_path}/m={version:09d}")
    for version in versions(spark, state_path, "v="):
        if version not in in_force:
            remove(spark, f"{state_path}/v={version:09d}")


def versions(spark: SparkSession, state_path: str, mark: str) -> list[int]:
    """Numbers of the whole folders ``<mark><number>`` of a state, ascending."""
    top = spark._jvm.org.apache.hadoop.fs.Path(state_path)
    system = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(top):
        return []
    named = [s.getPath() for s in system.listStatus(top) if s.getPath().getName().startswith(mark)]
    return sorted(int(p.getName()[len(mark) :]) for p in named if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def whole_versions(spark: SparkSession, state_path: str) -> list[int]:
    """Batches whose state was finished, ascending."""
    return versions(spark, state_path, "m=")


def _manifest(spark: SparkSession, state_path: str, version: int) -> tuple[dict[int, int], T.StructType]:
    """The version in force of every bucket, -1 for none, and the columns of the state."""
    rows = spark.read.parquet(f"{state_path}/m={version:09d}").collect()  # a row for each bucket
    return {r.bucket: r.version for r in rows}, T.StructType.fromJson(json.loads(rows[0].state))


def _read_buckets(spark: SparkSession, state_path: str, held: dict[int, int], schema: T.StructType) -> DataFrame:
    """The rows of some buckets, each from its version, with the bucket as last column."""
    schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    whole = spark.createDataFrame([], schema)
    for version in sorted({v for v in held.values() if v >= 0}):
        mine = [b for b, v in held.items() if v == version]
        whole = whole.unionByName(spark.read.schema(schema).parquet(f"{state_path}/v={version:09d}").filter(F.col("bucket").isin(mine)))
    return whole


def read_state(spark: SparkSession, state_path: str, version: int | None = None) -> DataFrame | None:
    """The state after a batch, by default the last whole one; None if there is none."""
    if version is None:
        version = max(whole_versions(spark, state_path), default=-1)
    return _read_buckets(spark, state_path, *_manifest(spark, state_path, version)).drop("bucket") if version >= 0 else None


def changed_since(rows: DataFrame, synced: DataFrame, key: str, modified: str, at: str, full: bool = False) -> DataFrame:
    """Rows that are new or modified after their last sync; all if ``full``."""
    if full:
        return rows
    last = synced.groupBy(key).agg(F.max(at).alias("__last"))
    return rows.join(last, key, "left").filter(F.col("__last").isNull() | (F.col(modified) > F.col("__last"))).drop("__last")


def retained(rows: DataFrame, at: str, as_of, days: int) -> DataFrame:
    """Rows not older than ``days`` before ``as_of`` (a column or value)."""
    limit = F.lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return rows.filter(F.col(at) >= limit)


def windowed_counts(events: DataFrame, at: str, key: str, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Tumbling or sliding counts with a watermark (an extension; works on streams and tables)."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return rows.groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def _admit(times: list[float], now: float, window: float, most: int) -> tuple[bool, int, list[float]]:
    """Whether a request is let through, how many were left before it, and the times still in the window."""
    held = [t for t in times if t > now - window]
    left = most - len(held)
    return (True, left, [*held, now]) if left > 0 else (False, 0, held)


def rate_limited(events: DataFrame, key: str, at: str, order: str, seconds: float, most: int) -> DataFrame:
    """J8 on a table: key, order, allowed, remaining (before the request) by exact replay per key.

    Whether a request passes depends on earlier rejections, so keys are folded in order, row by row: a hot key is
    one task's work. The fold holds one Arrow batch of a key at a time and at most ``most`` times, whatever its size.
    """
    schema = T.StructType([events.schema[key], events.schema[order], T.StructField("allowed", T.BooleanType()), T.StructField("remaining", T.IntegerType())])

    def run(batches):
        now_key, times = None, []
        for pdf in batches:
            out = []
            for k, o, t in zip(pdf[key], pdf[order], pdf["__t"], strict=True):
                if k != now_key:
                    now_key, times = k, []
                ok, left, times = _admit(times, t, seconds, most)
                out.append((k, o, ok, left))
            yield pd.DataFrame(out, columns=[key, order, "allowed", "remaining"])

    rows = events.select(key, order, (F.unix_micros(F.col(at).cast("timestamp")) / 1e6).alias("__t"))
    return rows.repartition(key).sortWithinPartitions(key, "__t", order).mapInPandas(run, schema)


def rate_limited_stream(events: DataFrame, key: str, at: str, order: str, seconds: float, most: int, late: str = "10 minutes") -> DataFrame:
    """J8, J6 on a stream: the same fold with the times held as state, dropped once the watermark has passed the window.

    ``late`` is how far behind the newest event one may come; events later than that are not judged.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(k, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        times = list(state.get[0]) if state.exists else []
        out = []
        for pdf in frames:
            for o, t in sorted(zip(pdf[order], pdf["__t"], strict=True), key=lambda x: (x[1], x[0])):
                ok, left, times = _admit(times, t, seconds, most)
                out.append((k[0], o, ok, left))
        state.update((times,))
        ends = int((max(times, default=0.0) + seconds) * 1000) + 1
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[key, order, "allowed", "remaining"])

    schema = T.StructType([events.schema[key], events.schema[order], T.StructField("allowed", T.BooleanType()), T.StructField("remaining", T.IntegerType())])
    rows = events.select(key, order, F.col(at).cast("timestamp").alias("__at")).withWatermark("__at", late)
    rows = rows.withColumn("__t", F.unix_micros("__at") / 1e6)
    return rows.groupBy(key).applyInPandasWithState(fold, schema, "times array<double>", "append", GroupStateTimeout.EventTimeTimeout)


def breaker_states(events: DataFrame, key: str, at: str, order: str, failed: str, failures: int = 5, reset_seconds: float = 60) -> DataFrame:
    """Circuit state after each call: CLOSED, OPEN after ``failures`` in a row, HALF_OPEN after a rest.

    Folded per key in order, row by row, with three values as state: a hot key is one task's work.
    """
    schema = T.StructType([events.schema[key], events.schema[order], T.StructField("state", T.StringType())])

    def run(batches):
        now_key, state, bad, since = None, "CLOSED", 0, 0.0
        for pdf in batches:
            out = []
            for k, o, t, f in zip(pdf[key], pdf[order], pdf["__t"], pdf["__f"], strict=True):
                if k != now_key:
                    now_key, state, bad = k, "CLOSED", 0
                if state == "OPEN" and t - since >= reset_seconds:
                    state = "HALF_OPEN"
                if state != "OPEN":
                    bad = bad + 1 if f else 0
                    if f and (state == "HALF_OPEN" or bad >= failures):
                        state, since = "OPEN", t
                    elif not f:
                        state = "CLOSED"
                out.append((k, o, state))
            yield pd.DataFrame(out, columns=[key, order, "state"])

    rows = events.select(key, order, (F.unix_micros(F.col(at).cast("timestamp")) / 1e6).alias("__t"), F.expr(failed).alias("__f"))
    return rows.repartition(key).sortWithinPartitions(key, "__t", order).mapInPandas(run, schema)
