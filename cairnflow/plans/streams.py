"""Queries that run as streams over the driver's tables until all of it is read, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from ..streaming import feeds as R
from ..streaming import timers as Ti
from .base import Tables, query


def _run(t: Tables, build) -> DataFrame:
    """The rows that a stream over ``events`` sends until all of them are read; its files and log are in the shared folder."""
    feed, out, log = (fresh_path(t.spark, n) for n in ("feed", "sent", "progress"))
    t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type").write.parquet(feed)
    stream = build(R.parquet_feed(t.spark, feed, t.spark.read.parquet(feed).schema, files_per_trigger=1_000_000))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key, None)
    t.spark.conf.set(key, Ti.PROVIDER)
    try:
        run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        if before is None:
            t.spark.conf.unset(key)
        else:
            t.spark.conf.set(key, before)
    return t.spark.read.schema(stream.schema).parquet(out)


def _sessions(gap: str, new: str, value: str) -> str:
    return f"""WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w {new} INTERVAL {gap} THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM e)
SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n, {value} FROM s GROUP BY user_id, s HAVING max(ts) + INTERVAL {gap} <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES"""


@query(_sessions("6 HOURS", ">=", "arg_max(event_id, (ts, event_id)) AS value"))
def ref_debounced_stream(t: Tables) -> DataFrame:
    """J2 as a stream: the last event of each burst of a user, once it has been quiet for six hours."""
    return _run(t, lambda s: Ti.debounced(s, "user_id", "ts", F.col("event_id"), "6 hours"))


@query(_sessions("6 HOURS", ">", "max(ts) + INTERVAL 6 HOURS AS expired_at"))
def ref_expired_stream(t: Tables) -> DataFrame:
    """J6 as a stream: a lease of six hours for each user that events renew; a row when it has run out."""
    return _run(t, lambda s: Ti.expired(s, "user_id", "ts", 6 * 3600))


@query(_sessions("6 HOURS", ">", "max(ts) + INTERVAL 6 HOURS AS expired_at").partition(" HAVING")[0])
def ref_leases(t: Tables) -> DataFrame:
    """J6 on a table: all leases."""
    return Ti.leases(t.events, "user_id", "ts", 6 * 3600)
