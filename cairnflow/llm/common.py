"""Shared plumbing: written intermediates, joins that bear hot keys, column hygiene."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words everywhere in this subpackage.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent and driver and executors are one process (tests) a temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="cairnflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While a query over whole texts runs, Arrow batches of at most ``rows`` rows: a batch is held twice on either side."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, so a lost executor costs a re-read, not a rerun.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    with short_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing will read again; other frames are left alone."""
    for table in tables:
        if path := getattr(table, "_written_path", None):
            jvm, spark = table.sparkSession._jvm, table.sparkSession
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def require(df: DataFrame, columns: Sequence[str], who: str) -> DataFrame:
    """Project to the columns an operator reads: others, whatever their names, cannot clash."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{who}: missing columns {missing}")
    return df.select(*columns)


def weighted_join(big: DataFrame, small: DataFrame, on: str, weight: str, how: str = "left", most: int = 50_000, hot: int = 10_000) -> DataFrame:
    """Join ``small`` (one row per key) to ``big`` although one key may own much of ``big``.

    ``weight`` is a column of ``small``: how many rows of ``big`` have the key. Up to ``most`` rows of ``small`` are
    broadcast. Beyond that, keys of more than ``hot`` rows, or of more than all their number divided by ``most``,
    are hot; there are ``most`` of them at most, so they are broadcast and their rows of ``big`` are not shuffled,
    and all others are joined by sorting.
    """
    size, rows = small.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if size <= most:
        return big.join(F.broadcast(small), on, how)
    is_hot = F.col(weight) > max(hot, rows // most)
    few = F.broadcast(small.filter(is_hot))
    rest = big.filter(F.col(on).isNotNull()).join(F.broadcast(small.filter(is_hot).select(on)), on, "left_anti").join(small.filter(~is_hot), on, how)
    out = big.join(few, on).unionByName(rest)
    if how != "left":
        return out
    # Rows without a key meet nothing and would all be sent to one task.
    return out.unionByName(big.filter(F.col(on).isNull()), allowMissingColumns=True)
