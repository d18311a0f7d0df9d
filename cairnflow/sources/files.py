"""File sources and sinks (inventory A1-A3, A5, A8-A9, A11, A13-A14, A17-A18, A20)."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


REGISTRY = _struct(
    category=T.StringType(), id=T.StringType(), path=T.StringType(), type=T.StringType(), purpose=T.StringType(), keywords=_STRINGS, used_by=_STRINGS,
    dependencies=_STRINGS, adaptability=_struct(score=T.DoubleType(), constraints=_STRINGS, extension_points=_STRINGS), checksum=T.StringType(), last_verified=T.TimestampType(),
)
AUDIT = _struct(timestamp=T.TimestampType(), action=T.StringType(), path=T.StringType())
METRICS_HEADER = ("timestamp", "layer", "passed", "durationMs", "findingsCount")


def scan_files(spark: SparkSession, root: str, exclude: Sequence[str] = (), extensions: Sequence[str] = (), most_depth: int | None = None, most_files: int | None = None) -> DataFrame:
    """A1-A3: path, length, modificationTime and relative path of files below ``root``.

    Contents are not read: the binary column is pruned. ``most_files`` is the feature of a bounded scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    # The scheme and host of a path are written in more than one way.
    below = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", root).rstrip("/")
    files = files.withColumn("relative", F.regexp_replace("path", rf"^.*?{_quoted(below)}/", ""))
    for pattern in exclude:
        files = files.filter(~F.col("relative").rlike(pattern))
    if extensions:
        files = files.filter(F.col("relative").rlike(rf"(?i)\.({'|'.join(e.lstrip('.') for e in extensions)})$"))
    if most_depth is not None:
        files = files.filter(F.size(F.split("relative", "/")) <= most_depth)
    return files if most_files is None else files.orderBy("relative").limit(most_files)


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c not in "/_-" else c for c in text)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = AUDIT, missing_ok: bool = True) -> DataFrame:
    """JSON lines with a given schema; a missing path gives no rows if ``missing_ok``."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def query_audit(log: DataFrame, action: str | None = None, path: str | None = None) -> DataFrame:
    """Action equal, path containing."""
    if action is not None:
        log = log.filter(F.col("action") == action)
    return log if path is None else log.filter(F.col("path").contains(path))


class RegistryError(ValueError):
    """Failed to parse registry."""


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A5: entities from JSON lines; missing or empty gives no rows, a corrupt line raises whatever columns are read.

    Registries kept as YAML are read by ``yamls.registry_rows``.
    """
    schema = T.StructType([*REGISTRY.fields, T.StructField("_corrupt", T.StringType())])
    try:
        rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)
    bad = F.concat(F.lit("Failed to parse registry: "), F.substring("_corrupt", 1, 80))
    # A filter, unlike a column, is not pruned with the columns a reader leaves out; it reads one more, as the reader asks.
    whole = F.when(F.col("_corrupt").isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.coalesce(F.length("id") >= 0, F.lit(True)))
    return rows.filter(whole).select(*REGISTRY.fieldNames())


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Strings with quoted commas and doubled quotes; empty fields stay ''. Missing required columns raise."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    lacking = [c for c in required if c not in columns]
    if lacking:
        raise ValueError(f"missing columns {lacking}")
    rows = spark.read.option("header", "true").option("escape", '"').option("emptyValue", "").option("enforceSchema", "false").schema(schema).csv(path)
    return rows.na.fill("")


def write_csv(rows: DataFrame, path: str, columns: Sequence[str] = METRICS_HEADER) -> None:
    """Fixed column order with a header; Spark's commit keeps the old files until the new are whole."""
    rows.select(*columns).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """A9."""
    rows.write.mode("overwrite").json(path)


def write_dated(rows: DataFrame, path: str, at: str) -> None:
    """Append to a folder per day, in place of log rotation."""
    rows.withColumn("date", F.to_date(at)).write.mode("append").partitionBy("date").json(path)


def rotate(spark: SparkSession, path: str, backups: str, most_bytes: int = 5_000_000, keep: int | None = None) -> str | None:
    """Move a log (a file or a folder of files) of more than ``most_bytes`` to ``backups`` and return where to.

    Backups are numbered; a move is one rename, so readers see the whole log at one place or the other. With ``keep`` the
    oldest backups beyond that number are deleted. A log that is missing or small stays, and None is returned.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    log, top = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(backups)
    system = log.getFileSystem(conf)
    if not system.exists(log) or system.getContentSummary(log).getLength() <= most_bytes:
        return None
    system.mkdirs(top)
    named = {int(m[1]): s.getPath() for s in system.listStatus(top) if (m := re.fullmatch(r"(\d+)-.*", s.getPath().getName()))}
    target = jvm.org.apache.hadoop.fs.Path(top, f"{max(named, default=0) + 1:06d}-{log.getName()}")
    if not system.rename(log, target):
        raise OSError(f"could not move {path} to {backups}")
    if keep is not None:
        for number in sorted(named)[: max(0, len(named) + 1 - keep)]:
            system.delete(named[number], True)
    return target.toString()


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text to a temporary name in any store Spark reaches, then rename; a failure leaves the old file."""
    jvm = spark._jvm
    target, temporary = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = system.create(temporary, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(temporary, target, overwrite)


def porcelain(rows: DataFrame, text: str = "text") -> DataFrame:
    """Short status lines (``XY path`` or ``XY old -> new``) as staged, unstaged, path, old_path; others are left out.

    Starting the command is the caller's: a failed one has no lines. Count before any limit for the total.
    """
    part = lambda k: F.regexp_extract(text, r"^([ MADRCU?!])([ MADRCU?!]) (?:(.+) -> )?(.+)$", k)
    out = rows.select(F.trim(part(1)).alias("staged"), F.trim(part(2)).alias("unstaged"), part(4).alias("path"), F.nullif(part(3), F.lit("")).alias("old_path"))
    return out.filter("path <> ''")


def commits(rows: DataFrame, text: str = "text") -> DataFrame:
    """One-line log entries (``abc1234 kind(scope): message``) as id, kind, scope, breaking, message, subject; others are left out.

    Kind and scope are null where the subject has none. Count before any limit for the total.
    """
    line, kinds = r"^([0-9a-f]{7,40})\s+(.*\S)\s*$", r"^([a-z]+)(?:\(([^)]*)\))?(!)?:\s+(.*)$"
    subject = F.regexp_extract(text, line, 2)
    part = lambda k: F.nullif(F.regexp_extract(subject, kinds, k), F.lit(""))
    out = rows.select(F.regexp_extract(text, line, 1).alias("id"), part(1).alias("kind"), part(2).alias("scope"), part(3).isNotNull().alias("breaking"), F.coalesce(part(4), subject).alias("message"), subject.alias("subject"))
    return out.filter("id <> ''")


def report_pair(summary: DataFrame, stem: str, most_rows: int = 1000) -> tuple[str, str]:
    """A small summary as ``stem.json`` and ``stem.md``, each replaced at once.

    Raises if the summary has more than ``most_rows`` rows: reports are for people.
    """
    rows = [r.asDict(recursive=True) for r in summary.limit(most_rows + 1).collect()]
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows in a report")
    names = summary.columns
    table = [" | ".join(names), " | ".join("---" for _ in names), *(" | ".join(str(r[c]) for c in names) for r in rows)]
    for path, text in ((f"{stem}.json", json.dumps(rows, default=str, indent=2)), (f"{stem}.md", "\n".join(f"| {line} |" for line in table) + "\n")):
        replace_file(summary.sparkSession, path, text)
    return f"{stem}.json", f"{stem}.md"
