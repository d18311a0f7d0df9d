"""Other scalar functions (inventory B14-B19, B23-B24, B26, H4-H6, H17-H18, H22-H25, H28, H33)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bins(value: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The first (least, label) with value >= least; NaN and null fall to ``otherwise``."""
    out = F.when(value.isNull() | F.isnan(value.cast("double")), otherwise)
    for least, label in sorted(bounds, reverse=True):
        out = out.when(value >= least, label)
    return out.otherwise(otherwise)


#: Remaining share of a context, in percent.
BRACKETS = ((60.0, "FRESH"), (40.0, "MODERATE"), (25.0, "DEPLETED"))


def bracket(percent: Column) -> Column:
    return bins(percent, BRACKETS, "CRITICAL")


def context_percent(prompts: Column, average: float = 1500, most: float = 200_000) -> Column:
    """100 - prompts x average / most x 100, at least 0; a bad count gives 100, a bad limit 0."""
    if most <= 0:
        return F.lit(0.0)
    bad = prompts.isNull() | F.isnan(prompts.cast("double")) | (prompts < 0)
    return F.when(bad, 100.0).otherwise(F.greatest(F.lit(0.0), 100 - prompts * average / most * 100))


def decision(relevance: Column, adaptability: Column, impact: Column) -> Column:
    """struct(action, confidence)."""
    pick = lambda a, c: F.struct(F.lit(a).alias("action"), F.lit(c).alias("confidence"))
    adapt = (relevance >= 0.6) & (adaptability >= 0.6) & (impact < 0.3)
    return (
        F.when(relevance >= 0.9, pick("REUSE", "high"))
        .when(adapt & (relevance >= 0.8), pick("ADAPT", "high"))
        .when(adapt, pick("ADAPT", "medium"))
        .when(relevance >= 0.6, pick("CREATE", "medium"))
        .otherwise(pick("CREATE", "low"))
    )


def promotion(n_users: Column, days_since: Column) -> Column:
    """B17."""
    return (
        F.when(n_users.isNull(), "unknown")
        .when(n_users >= 3, "promotion-candidate")
        .when(n_users >= 1, "monitoring")
        .when(days_since > 60, "deprecation-review")
        .otherwise("unknown")
    )


def risk(count: Column, low_most: float = 4, medium_most: float = 15) -> Column:
    """The bounds are ours, the order LOW <= MEDIUM < HIGH is given."""
    return F.when(count <= low_most, "LOW").when(count <= medium_most, "MEDIUM").otherwise("HIGH")


def impact_risk(share: Column) -> Column:
    """0 NONE, .05 LOW, .2 MEDIUM, .4 HIGH, .6 CRITICAL; cut points between are ours."""
    return bins(share, ((0.5, "CRITICAL"), (0.3, "HIGH"), (0.1, "MEDIUM"), (1e-12, "LOW")), "NONE")


def detail_level(distance: Column, related: Column) -> Column:
    """Full at distance 1-3, files at 4-6, metadata else; ``related`` lifts metadata to files, never to full."""
    return F.when(distance.between(1, 3), "full").when(distance.between(4, 6) | ((distance >= 7) & related), "files").otherwise("metadata")


def first_match(value: Column, rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first regular expression that is found; order matters."""
    out = F
    for pattern, label in rules:
        out = out.when(value.rlike(pattern), label)
    return F.lit(otherwise) if out is F else out.otherwise(otherwise)


# Path rules in order.
PATH_TYPES = (
    (r"(^|/)agents?/", "agent"), (r"(^|/)tasks?/", "task"), (r"(^|/)workflows?/", "workflow"), (r"(^|/)templates?/", "template"),
    (r"(^|/)checklists?/", "checklist"), (r"(^|/)scripts?/", "script"), (r"\.(ya?ml|json)$", "config"), (r"\.js$", "module"),
)
CONFLICT_SEVERITY = ((r"(^|/)package\.json$|^src/index\.ts$", "critical"), (r"\.config\.js$", "high"))
# What a tool does to files.
OPERATIONS = {"read": "read", "grep": "read", "glob": "read", "write": "write", "edit": "write", "bash": "execute", "task": "execute"}


def operation_class(tool: Column) -> Column:
    """Unknown tools count as execute."""
    table = F.create_map(*[F.lit(x) for kv in OPERATIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(tool)), F.lit("execute"))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """H4: 0 where a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """H5, H6: similarity of two arrays as sets (formula ours)."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def version_key(version: Column) -> Column:
    """Three numbers as an array that compares like the version."""
    parts = F.split(F.regexp_replace(F.coalesce(version, F.lit("")), "^v", ""), r"\.")
    return F.transform(F.array(*(F.lit(k) for k in range(3))), lambda k: F.coalesce(F.regexp_extract(F.coalesce(F.get(parts, k), F.lit("0")), r"^(\d*)", 1).try_cast("int"), F.lit(0)))


def version_compare(a: Column, b: Column) -> Column:
    return F.when(version_key(a) > version_key(b), 1).when(version_key(a) < version_key(b), -1).otherwise(0)


def is_breaking(installed: Column, latest: Column) -> Column:
    """H18."""
    return version_key(latest)[0] > version_key(installed)[0]


def days_since(text: Column, as_of: Column) -> Column:
    """Infinity if the time is missing or no time."""
    seconds = F.unix_seconds(as_of) - F.unix_seconds(F.try_to_timestamp(text))
    return F.coalesce(F.floor(seconds / 86400).cast("double"), F.lit(float("inf")))


def retry_delay(attempt: Column, retry_after: Column, base: float = 1000, most: float = 60_000) -> Column:
    """H24 without jitter: retry_after seconds win, else base x 2^(attempt - 1) up to ``most``."""
    return F.coalesce(retry_after * 1000.0, F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), attempt - 1)))


def attention(relevance: Column, days: Column, accesses: Column, confidence: Column, rate: float = 0.1) -> Column:
    """Relevance x recency x access x confidence; recency is exp(-rate x days), access 1 - 1 / (2 + n) (ours)."""
    return relevance * F.exp(-rate * days) * (1 - 1 / (2 + accesses)) * confidence


def attention_tier(score: Column) -> Column:
    return F.when(score > 0.7, "HOT").when(score >= 0.3, "WARM").otherwise("COLD")


def zoned(date: str, clock: Column, zone: str) -> Column:
    """Wall-clock time of a day in a zone as an instant."""
    return F.to_utc_timestamp(F.to_timestamp(F.concat(F.lit(f"{date} "), clock)), zone)


def payload(text: Column, paths: Sequence[str]) -> Column:
    """The first JSON path that is there."""
    return F.coalesce(*(F.get_json_object(text, p) for p in paths))


def half_up(x: Column) -> Column:
    """Rounds halves upwards, also below zero."""
    return F.floor(x + 0.5)
