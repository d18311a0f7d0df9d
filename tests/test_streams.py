"""Bursts, leases and bucketed states as streams with late rows, idle keys and failed batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cairnflow.streaming import feeds as R
from cairnflow.streaming import timers as Ti

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def sessions(rows, gap):
    """(key, first, last, n) of rows (key, second) that are at most ``gap`` apart."""
    out = []
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key)
        begin = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > gap:
                out.append((key, at(times[begin]), at(times[i - 1]), i - begin))
                begin = i
    return sorted(out)


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", Ti.PROVIDER)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def fed(spark, tmp_path, batches, build, kind="k string, at timestamp, v long"):
    """What a stream returns that gets a file for each batch, one file a trigger."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
    stream = build(R.parquet_feed(spark, source, spark.read.parquet(source).schema, 1))
    run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).collect()


BATCHES = [
    [("a", at(0), 1), ("a", at(20), 2), ("b", at(5), 3), ("idle", at(1), 4), (None, at(2), 5), ("x", None, 6)],
    [("a", at(35), 7), ("a", at(10), 8), ("b", at(200), 9)],  # a's burst goes on, one change comes out of order
    [("b", at(400), 10)],
    [("a", at(30), 11), ("late", at(3), 12), ("b", at(405), 13)],  # behind the watermark of 400 - 60
    [("end", at(1000), 14)],
]
#: Of the rows above those in time, as (key, second).
IN_TIME = [("a", 0), ("a", 20), ("b", 5), ("idle", 1), ("a", 35), ("a", 10), ("b", 200), ("b", 400), ("b", 405), ("end", 1000)]


def test_bursts_of_a_stream(spark, tmp_path):
    got = fed(spark, tmp_path, BATCHES, lambda s: Ti.debounced(s, "k", "at", F.col("v"), "30 seconds", "60 seconds"))
    want = [x for x in sessions(IN_TIME, 29) if x[0] != "end"]  # the last burst is still open
    assert sorted((r.k, r["first"], r["last"], r.n) for r in got) == want
    assert {(r.k, r.value) for r in got} == {("a", 7), ("b", 3), ("idle", 4), ("b", 9), ("b", 13)}


def test_bursts_of_a_table(spark):
    rows = spark.createDataFrame([r for b in BATCHES for r in b], "k string, at timestamp, v long")
    got = Ti.debounced(rows, "k", "at", F.col("v"), "30 seconds").collect()
    assert sorted((r.k, r["first"], r["last"], r.n) for r in got) == sessions([*IN_TIME, ("a", 30), ("late", 3)], 29)


def test_leases_run_out_late_and_idle(spark, tmp_path, rocks):
    got = fed(spark, tmp_path, BATCHES, lambda s: Ti.expired(s, "k", "at", 30, "60 seconds"))
    want = [x for x in sessions(IN_TIME, 30) if x[0] != "end"]
    assert sorted((r.k, r["first"], r["last"], r.n) for r in got) == want
    assert all((r.expired_at - r["last"]).total_seconds() == 30 for r in got)


def test_leases_merge_whatever_the_order(spark, tmp_path, rocks):
    rng = random.Random(5)
    rows = [(f"k{rng.randint(0, 3)}", rng.randint(0, 900)) for _ in range(160)]
    shuffled = [rows[i::4] for i in range(4)]  # all batches span the same time: nothing is late
    got = fed(spark, tmp_path, [[(k, at(t), 0) for k, t in b] for b in shuffled] + [[("end", at(5000), 0)]], lambda s: Ti.expired(s, "k", "at", 25, "2000 seconds"))
    assert sorted((r.k, r["first"], r["last"], r.n) for r in got) == sessions(rows, 25)
    table = spark.createDataFrame([(k, at(t), 0) for k, t in rows], "k string, at timestamp, v long")
    same = Ti.leases(table, "k", "at", 25).collect()
    assert sorted((r.k, r["first"], r["last"], r.n) for r in same) == sessions(rows, 25)


KIND = "id string, action string, at int, used_by array<string>"


def files(path, mark):
    return {p.name for p in path.glob(f"{mark}=*")}


def test_a_small_batch_writes_few_buckets(spark, tmp_path):
    path = tmp_path / "state"
    step = R.upsert_sink(str(path), "id", "at", 32)
    step(spark.createDataFrame([(f"k{i}", "add", 0, []) for i in range(3000)], KIND), 0)
    step(spark.createDataFrame([(f"k{i}", "change", 1, ["k7"]) for i in range(10)], KIND), 1)
    assert len(list((path / "v=000000000").glob("bucket=*"))) == 32 and len(list((path / "v=000000001").glob("bucket=*"))) <= 10
    state = {r.id: r.at for r in R.read_state(spark, str(path)).collect()}
    assert state == {f"k{i}": int(i < 10) for i in range(3000)}
    # A removed key leaves the lists of keys in other buckets.
    step(spark.createDataFrame([("k7", "unlink", 2, [])], KIND), 2)
    state = {r.id: r.used_by for r in R.read_state(spark, str(path)).collect()}
    assert len(state) == 2999 and "k7" not in state and not any(state.values())


def test_a_failed_batch_changes_nothing_and_is_run_again(spark, tmp_path, monkeypatch):
    path = tmp_path / "state"
    step = R.upsert_sink(str(path), "id", "at", 8)
    step(spark.createDataFrame([(f"k{i}", "add", 0, []) for i in range(100)], KIND), 0)
    batch = spark.createDataFrame([("k1", "unlink", 1, []), ("k2", "change", 1, []), ("new", "add", 1, [])], KIND)

    def broken(*_):
        raise RuntimeError("lost")

    whole = R.discard
    monkeypatch.setattr(R, "discard", broken)  # after the buckets, before the manifest
    with pytest.raises(RuntimeError, match="lost"):
        step(batch, 1)
    assert files(path, "v") == {"v=000000000", "v=000000001"} and files(path, "m") == {"m=000000000"}
    before = {r.id: r.at for r in R.read_state(spark, str(path)).collect()}
    assert before == {f"k{i}": 0 for i in range(100)}
    monkeypatch.setattr(R, "discard", whole)
    for _ in range(2):  # a rerun, and a rerun of what was whole
        step(batch, 1)
        after = {r.id: r.at for r in R.read_state(spark, str(path)).collect()}
        assert after == {f"k{i}": int(i == 2) for i in range(100) if i != 1} | {"new": 1}


def test_a_state_that_was_emptied(spark, tmp_path):
    step = R.upsert_sink(str(tmp_path / "state"), "id", "at", 4)
    step(spark.createDataFrame([("a", "add", 0, [])], KIND), 0)
    step(spark.createDataFrame([("a", "unlink", 1, [])], KIND), 1)
    assert R.read_state(spark, str(tmp_path / "state")).count() == 0
    step(spark.createDataFrame([("a", "add", 2, ["x"])], KIND), 2)
    step(spark.createDataFrame([], KIND), 3)
    assert [(r.id, r.used_by) for r in R.read_state(spark, str(tmp_path / "state")).collect()] == [("a", ["x"])]
