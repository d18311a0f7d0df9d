"""Streams that act on silence (inventory J2, J6): bursts that have gone quiet, leases that nobody renewed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State with timers is kept by this provider.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def debounced(changes: DataFrame, key: str, at: str, value: Column, quiet: str, late: str = "10 minutes") -> DataFrame:
    """Key, first, last, n, value: a row for each burst of changes of a key, with its last value.

    A burst ends when nothing has come for ``quiet``. On a stream its row is sent once the watermark, ``late`` behind the
    newest change, has passed that moment, and changes that come later than that are left out; on a table every burst
    has its row. Bursts are merged before the shuffle, so a busy key sends one row a task and burst. Rows without
    key or time take no part. Of changes at one time the greatest value is the last.
    """
    rows = changes.select(key, F.col(at).cast("timestamp").alias("__at"), value.alias("__v")).filter(F.col(key).isNotNull() & F.col("__at").isNotNull())
    rows = rows.withWatermark("__at", late) if rows.isStreaming else rows
    bursts = rows.groupBy(key, F.session_window("__at", quiet)).agg(F.min("__at").alias("first"), F.max(F.struct("__at", "__v")).alias("__l"), F.count("*").alias("n"))
    return bursts.select(key, "first", F.col("__l.__at").alias("last"), "n", F.col("__l.__v").alias("value"))


class Leases(StatefulProcessor):
    """Open leases of a key as (first, last, n) in microseconds, and a timer at the end of the earliest."""

    def __init__(self, key: str, ttl_us: int):
        self.key, self.ttl = key, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first array<bigint>, last array<bigint>, n array<bigint>")

    def _held(self) -> np.ndarray:
        return np.array(self.open.get(), np.int64).reshape(3, -1) if self.open.exists() else np.empty((3, 0), np.int64)

    def _keep(self, held: np.ndarray) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held.shape[1]:
            self.open.update(tuple(row.tolist() for row in held))
            self.handle.registerTimer(int(held[1].min() + self.ttl) // 1000 + 1)
        else:
            self.open.clear()

    def _merged(self, held: np.ndarray) -> np.ndarray:
        """Leases that touch, as one: in order of their begin, a lease goes on until the latest touch so far is out."""
        held = held[:, np.lexsort((held[1], held[0]))]
        upto = np.maximum.accumulate(held[1])
        new = np.flatnonzero(np.append(True, held[0][1:] - upto[:-1] > self.ttl))
        return np.stack([held[0][new], np.maximum.reduceat(held[1], new), np.add.reduceat(held[2], new)])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = self._held()
        for frame in rows:
            t = frame["touched_us"].to_numpy(np.int64)
            held = self._merged(np.concatenate([held, np.stack([t, t, np.ones_like(t)])], axis=1))
        self._keep(held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        held, now = self._held(), timerValues.getCurrentWatermarkInMs()
        over = (held[1] + self.ttl) // 1000 + 1 <= now
        self._keep(held[:, ~over])
        done = held[:, over]
        yield pd.DataFrame({self.key: [key[0]] * done.shape[1], "first": done[0], "last": done[1], "n": done[2]})

    def close(self) -> None:
        pass


def expired(touches: DataFrame, key: str, at: str, ttl_seconds: float, late: str = "10 minutes") -> DataFrame:
    """J6 on a stream: key, first, last, expired_at, n: a row for each lease that ran out, sent when it did.

    A touch opens a lease of ``ttl_seconds`` or renews the one that is open. A timer at the end of the lease sends the
    row once the watermark has passed it, whether or not the key is ever touched again; until then the state of a key
    is one triple for each lease that late touches may still change. Touches behind the watermark are left out. The
    session must keep its streaming state by :data:`PROVIDER`.
    """
    ttl = round(ttl_seconds * 1e6)
    rows = touches.select(key, F.col(at).cast("timestamp").alias("touched_at")).filter(F.col(key).isNotNull() & F.col("touched_at").isNotNull())
    rows = rows.withWatermark("touched_at", late).withColumn("touched_us", F.unix_micros("touched_at"))
    schema = T.StructType([touches.schema[key], *(T.StructField(c, T.LongType()) for c in ("first", "last", "n"))])
    out = rows.groupBy(key).transformWithStateInPandas(Leases(key, ttl), schema, "append", "eventTime")
    when = lambda c: F.timestamp_micros(F.col(c))
    return out.select(key, when("first").alias("first"), when("last").alias("last"), F.timestamp_micros(F.col("last") + ttl).alias("expired_at"), "n")


def leases(touches: DataFrame, key: str, at: str, ttl_seconds: float) -> DataFrame:
    """J6 on a table: the same rows for all leases, run out or not, by session windows."""
    rows = touches.select(key, F.col(at).cast("timestamp").alias("__at")).filter(F.col(key).isNotNull() & F.col("__at").isNotNull())
    # A window ends before the gap, a lease with it: one microsecond more.
    gap = F.session_window("__at", f"{round(ttl_seconds * 1e6) + 1} microseconds")
    out = rows.groupBy(key, gap).agg(F.min("__at").alias("first"), F.max("__at").alias("last"), F.count("*").alias("n"))
    return out.select(key, "first", "last", F.timestamp_micros(F.unix_micros("last") + round(ttl_seconds * 1e6)).alias("expired_at"), "n")
