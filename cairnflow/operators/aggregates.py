"""Aggregations (inventory D1-D32). Partial aggregation happens before every shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .ranks import nearest_ranks


def run_stats(runs: DataFrame, keys: Sequence[str], passed: Column, duration: Column, at: Column) -> DataFrame:
    """total_runs, pass_rate (0 to 1), avg_duration, last_run."""
    return runs.groupBy(*keys).agg(
        F.count("*").alias("total_runs"),
        F.avg(passed.cast("double")).alias("pass_rate"),
        F.avg(duration).alias("avg_duration"),
        F.max(at).alias("last_run"),
    )


def severity_counts(rows: DataFrame, keys: Sequence[str], severity: Column, n: Column, kinds: Sequence[str]) -> DataFrame:
    """One summed column per kind."""
    return rows.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(severity == k, n)), F.lit(0)).alias(k) for k in kinds))


def daily(rows: DataFrame, at: Column, value: Column) -> DataFrame:
    """D3: date and mean value."""
    return rows.groupBy(F.to_date(at).alias("date")).agg(F.avg(value).alias("value"), F.count("*").alias("n"))


def nearest_rank(value: str, p: float) -> Column:
    """sorted[ceil(p n) - 1]; holds a group's distinct values in one map, so it is for small groups."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})")


def stats_report(rows: DataFrame, value: str, keys: Sequence[str] = (), pooled: bool = False) -> DataFrame:
    """Min, max, p50, p95, p99, mean, n of non-negative values; negative ones are errors, counted apart.

    ``pooled`` adds a row over all groups, with null keys. Groups without good values give zeros. Values are counted by
    group once; the groups' figures and the pooled ones come from these counts, and ranks are found range by range.
    """
    pooled = pooled and bool(keys)
    good = F.when(F.col(value) >= 0, F.col(value)).alias("__good")
    counts = rows.select(*keys, good, (F.col(value) < 0).alias("__bad")).groupBy(*keys, "__good", "__bad").agg(F.count("*").alias("__n"))
    if pooled:
        both = F.array(F.struct(F.lit(0).alias("__all"), *keys), F.struct(F.lit(1).alias("__all"), *(F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in keys)))
        counts = counts.select(F.explode(both).alias("__g"), "__good", "__bad", "__n").select("__g.*", "__good", "__bad", "__n")
    by = ["__all", *keys] if pooled else list(keys)
    percents, n = (50, 95, 99), F.when(F.col("__good").isNotNull(), F.col("__n"))
    counts = written(counts.groupBy(*by, "__good", "__bad").agg(F.sum("__n").alias("__n")), "value_counts")
    plain = counts.groupBy(*by).agg(
        F.min("__good").alias("min"), F.max("__good").alias("max"), F.try_divide(F.sum(F.col("__good") * F.col("__n")), F.sum(n)).alias("mean"),
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("__bad"), F.col("__n"))), F.lit(0)).alias("errors"),
    )
    ranks = nearest_ranks(counts, "__good", percents, by, "__n").select(*(F.col(k).alias(f"__{k}") for k in by), *(f"p{p}" for p in percents))
    out = plain.join(ranks, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by], "left") if by else plain.join(F.broadcast(ranks), how="left")  # one row each
    names = ["min", "max", *(f"p{p}" for p in percents), "mean"]
    return out.select(*keys, *(F.coalesce(x, F.lit(0.0)).alias(x) for x in names), "n", "errors")


def wave_metrics(tasks: DataFrame, wave: str, duration: str, success: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Wall time is the sum over waves of the longest task; success_rate in percent, 100 without tasks."""
    waves = tasks.groupBy(*keys, wave).agg(F.max(duration).alias("wall"), F.sum(duration).alias("work"), F.count("*").alias("n"), F.count_if(success).alias("ok"))
    out = waves.groupBy(*keys).agg(F.sum("work").alias("total_duration"), F.sum("wall").alias("wall_time"), F.sum("n").alias("n_tasks"), F.sum("ok").alias("n_ok"), F.count("*").alias("n_waves"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        *keys, zero("total_duration").alias("total_duration"), zero("wall_time").alias("wall_time"), zero("n_tasks").alias("n_tasks"), "n_waves",
        F.coalesce(F.try_divide("total_duration", "wall_time"), F.lit(1.0)).alias("parallel_efficiency"),
        F.coalesce(F.try_divide(100.0 * F.col("n_ok"), F.col("n_tasks")), F.lit(100.0)).alias("success_rate"),
    )


def file_edits(edits: DataFrame, file: str) -> DataFrame:
    """Distinct files and edits beyond the first of each (total minus distinct, our reading)."""
    per = edits.groupBy(file).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("distinct_files"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_edits"))


def _first_of(pairs: DataFrame, key: str, item: str, n: int, name: str) -> DataFrame:
    """key and its first ``n`` items in order: ranked before they are gathered, so a list is bounded."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(item))
    first = pairs.withColumn("__r", rank).filter(F.col("__r") <= n)
    return first.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias(name))


def conflict_rows(edits: DataFrame, file: str, task: str) -> DataFrame:
    """File, task for every task of every file that two or more tasks touched; nothing is gathered or cut."""
    per = edits.select(file, task).distinct()
    shared = per.groupBy(file).agg(F.count("*").alias("__n")).filter("__n >= 2").select(file)
    return per.join(shared, file, "left_semi")


def conflicts(edits: DataFrame, file: str, task: str, most_listed: int = 100) -> DataFrame:
    """Files that two or more tasks touched, with the full count and the first ``most_listed`` tasks in order.

    :func:`conflict_rows` has all of them.
    """
    per = edits.select(file, task).distinct()
    counts = per.groupBy(file).agg(F.count("*").alias("n_tasks")).filter("n_tasks >= 2")
    return counts.join(_first_of(per, file, task, most_listed, "tasks"), file)


def group_subgroup(rows: DataFrame, group: str, subgroup: str, missing: str = "general") -> DataFrame:
    """Counts per group and subgroup, per group (null subgroup) and in all (both null)."""
    rows = rows.select(F.col(group), F.coalesce(F.col(subgroup), F.lit(missing)).alias(subgroup))
    return rows.rollup(group, subgroup).agg(F.count("*").alias("n"))


def issue_report(rows: DataFrame, severity: Column, valid: Column) -> DataFrame:
    """Status failed > warning > info > success and integrity_score, rounded half up, 0 without rows."""
    has = lambda *k: F.coalesce(F.max(severity.isin(*k).cast("int")), F.lit(0)) == 1
    status = F.when(has("critical", "high"), "failed").when(has("medium"), "warning").when(has("low"), "info").otherwise("success")
    score = F.coalesce(F.floor(100 * F.try_divide(F.count_if(valid), F.count("*")) + 0.5), F.lit(0)).cast("long")
    return rows.agg(F.count("*").alias("n"), status.alias("status"), score.alias("integrity_score"))


def errors_by_code(rows: DataFrame, code: str, priority: Column, order: Sequence[str] = ("critical", "high", "medium", "low")) -> DataFrame:
    """Counts per code (UNKNOWN) and priority (low), with the rank to sort by."""
    p = F.coalesce(F.when(priority.isin(*order), priority), F.lit(order[-1]))
    rank = F.array_position(F.array(*map(F.lit, order)), p).cast("int")
    return rows.groupBy(F.coalesce(F.col(code), F.lit("UNKNOWN")).alias("code"), p.alias("priority"), rank.alias("priority_rank")).agg(F.count("*").alias("n"))


def links_report(links: DataFrame, source: str, target: str, most_listed: int = 100) -> DataFrame:
    """Per target the counts and the first ``most_listed`` sources in order; the rows of ``links`` have all."""
    per = links.groupBy(target, source).agg(F.count("*").alias("k"))
    counts = per.groupBy(target).agg(F.sum("k").alias("n_links"), F.count("*").alias("n_sources"))
    return counts.join(_first_of(per.select(target, source), target, source, most_listed, "sources"), target)


def rate_metrics(rows: DataFrame, wait: Column, retries: Column, hits: Column) -> DataFrame:
    """Average wait per retry (0 without) and success in percent (100 without requests)."""
    n = F.count("*")
    return rows.agg(
        n.alias("requests"), F.coalesce(F.try_divide(F.sum(wait), F.sum(retries)), F.lit(0.0)).alias("average_wait"),
        F.coalesce(100.0 * (1 - F.try_divide(F.sum(hits), n)), F.lit(100.0)).alias("success_rate"),
    )


def progress(rows: DataFrame, keys: Sequence[str], status: Column) -> DataFrame:
    """Counts per status, percent completed (0 without rows), and failed as soon as one failed."""
    is_ = lambda s: F.count_if(status == s)
    n = F.count("*")
    overall = F.when(is_("failed") > 0, "FAILED").when((n > 0) & (is_("completed") == n), "COMPLETED").when(is_("pending") == n, "PENDING").otherwise("IN_PROGRESS")
    return rows.groupBy(*keys).agg(
        n.alias("n"), is_("completed").alias("completed"), is_("failed").alias("failed"), is_("pending").alias("pending"),
        F.coalesce(F.try_divide(100.0 * is_("completed"), n), F.lit(0.0)).alias("percent_complete"), overall.alias("status"),
    )


def coverage(all_rows: DataFrame, covered: DataFrame, on: str) -> DataFrame:
    """Share of keys with at least one covered row."""
    hit = all_rows.select(on).distinct().join(covered.select(on).distinct().withColumn("__hit", F.lit(1)), on, "left")
    return hit.agg(F.count("*").alias("n"), F.count("__hit").alias("n_covered"), F.coalesce(F.try_divide(F.count("__hit"), F.count("*")), F.lit(0.0)).alias("coverage"))


def rubric_score(rubric: DataFrame, found: DataFrame) -> DataFrame:
    """rubric(name, weight, expected), found(name, status, stale): earned over expected in percent, with grade.

    Only expected names count; ok earns the weight, stale ok half of it; absent or other earns nothing. A is
    90 and up, B 75 and up, F below 45; the C / D bound 60 is ours.
    """
    joined = rubric.filter("expected").join(found, "name", "left")
    earned = F.when(F.col("status") == "ok", F.col("weight") * F.when(F.coalesce("stale", F.lit(False)), 0.5).otherwise(1.0)).otherwise(0.0)
    score = F.coalesce(F.try_divide(100.0 * F.sum(earned), F.sum("weight")), F.lit(0.0))
    out = joined.agg(score.alias("score"), F.count_if(F.col("status").isNull()).alias("missing"))
    s = F.col("score")
    return out.withColumn("grade", F.when(s >= 90, "A").when(s >= 75, "B").when(s >= 60, "C").when(s >= 45, "D").otherwise("F"))


def pooled_score(first: Column, second: Column, share: float = 0.4) -> Column:
    """0.4 first + 0.6 second, or the one that is there."""
    return F.coalesce(share * first + (1 - share) * second, first, second)


def health(rows: DataFrame, status: Column, ms: Column, size: Column, slow: float = 200) -> DataFrame:
    """Healthy, degraded (slow), bad and empty counts."""
    state = F.when(status != "ok", "bad").when(size == 0, "empty").when(ms > slow, "degraded").otherwise("healthy")
    return rows.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def arg_max_class(texts: DataFrame, key: str, text: Column, classes: dict[str, Sequence[str]], otherwise: str = "general") -> DataFrame:
    """Class with most keyword hits, case-insensitive; ties go to the first name. A projection: no shuffle."""
    t = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.struct(sum((t.contains(k.lower()).cast("int") for k in words), F.lit(0)).alias("hits"), F.lit(-i).alias("at"), F.lit(name).alias("name")) for i, (name, words) in enumerate(sorted(classes.items()))]
    best = F.greatest(*hits) if len(hits) > 1 else hits[0]
    return texts.select(key, F.when(best["hits"] > 0, best["name"]).otherwise(otherwise).alias("class"), best["hits"].alias("hits"))


def complexity(nodes: DataFrame, edges: DataFrame, graph: str, complex_node: Column) -> DataFrame:
    """Nodes + 0.5 connections + 2 complex nodes, rounded half up."""
    n = nodes.groupBy(graph).agg(F.count("*").alias("nodes"), F.count_if(complex_node).alias("hard"))
    e = edges.groupBy(graph).agg(F.count("*").alias("edges"))
    total = F.col("nodes") + 0.5 * F.coalesce("edges", F.lit(0)) + 2 * F.col("hard")
    return n.join(e, graph, "left").select(graph, F.floor(total + 0.5).cast("long").alias("complexity"))


def heal_summary(rows: DataFrame, severity: Column, healable: Column, kinds: Sequence[str] = ("critical", "high", "medium", "low")) -> DataFrame:
    """One row: total, a count per kind, auto_healable and its rate in percent (0 without rows)."""
    n = F.count("*")
    return rows.agg(n.alias("total"), *(F.count_if(severity == k).alias(k) for k in kinds), F.count_if(healable).alias("auto_healable"), F.coalesce(F.try_divide(100.0 * F.count_if(healable), n), F.lit(0.0)).alias("rate"))


def issues_by_severity(rows: DataFrame, status: Column, severity: Column, issues: Sequence[str] = ("fail", "warning", "error")) -> DataFrame:
    """Severity and count of rows whose status is an issue; passed and skipped ones are none."""
    return rows.filter(status.isin(*issues)).groupBy(severity.alias("severity")).agg(F.count("*").alias("n"))


def by_domain(rows: DataFrame, domain: Column, missing: str = "unknown") -> DataFrame:
    """Domain and count; a missing or empty domain is ``unknown``."""
    return rows.groupBy(F.coalesce(F.nullif(domain, F.lit("")), F.lit(missing)).alias("domain")).agg(F.count("*").alias("n"))


def delivery_confidence(rows: DataFrame, keys: Sequence[str], parts: dict[str, tuple[Column, Column, float]]) -> DataFrame:
    """Per key the share of each part (done of all rows that count, 1 without any) and the weighted mean in percent.

    parts: name -> (counts, done, weight). The weights of the overall figure are ours.
    """
    share = {n: F.coalesce(F.try_divide(F.count_if(counts & done).cast("double"), F.count_if(counts)), F.lit(1.0)) for n, (counts, done, _) in parts.items()}
    out = rows.groupBy(*keys).agg(*(c.alias(n) for n, c in share.items()))
    weight = sum(w for _, _, w in parts.values())
    return out.withColumn("overall", sum((F.col(n) * (100.0 * w / weight) for n, (_, _, w) in parts.items()), F.lit(0.0)))


def pattern_stats(rows: DataFrame, keys: Sequence[str], rate: Column, good: float = 0.8) -> DataFrame:
    """Number, mean rate, number and share of patterns with at least ``good``."""
    n = F.count("*")
    return rows.groupBy(*keys).agg(n.alias("n"), F.avg(rate).alias("mean_rate"), F.count_if(rate >= good).alias("good"), (F.count_if(rate >= good) / n).alias("share"))


def checkpoints(rows: DataFrame, keys: Sequence[str], item: str, at: str) -> DataFrame:
    """L3: every checkpoint counts (n), completed items count once (completed), and the last one is named (last)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(item).alias("completed"), F.max_by(item, at).alias("last"))
