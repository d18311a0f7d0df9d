"""Comparing and merging tables (inventory C1-C16, G1, G3-G6, L1, H29, K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .ranks import running


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, digest: str, ignore_case: bool = True) -> DataFrame:
    """Key and state new / removed / modified / unchanged; a null digest on either side differs."""
    fold = F.lower if ignore_case else (lambda c: c)
    o = old.select(key, fold(F.col(digest)).alias("__o"), F.lit(True).alias("__in_o"))
    n = new.select(key, fold(F.col(digest)).alias("__n"), F.lit(True).alias("__in_n"))
    same = F.coalesce(F.col("__o") == F.col("__n"), F.lit(False))
    state = F.when(F.col("__in_o").isNull(), "new").when(F.col("__in_n").isNull(), "removed").when(same, "unchanged").otherwise("modified")
    return o.join(n, key, "full_outer").select(key, state.alias("state"))


def upgrade_report(source: DataFrame, installed: DataFrame, on_disk: DataFrame, key: str, digest: str) -> DataFrame:
    """As :func:`snapshot_diff`, and user-modified where the file on disk is not what was installed."""
    d = on_disk.select(key, F.lower(digest).alias("__d"))
    i = installed.select(key, F.lower(digest).alias("__i"))
    touched = i.join(d, key).filter(F.col("__d").isNull() | F.col("__i").isNull() | (F.col("__d") != F.col("__i"))).select(key, F.lit(True).alias("__user"))
    out = snapshot_diff(installed, source, key, digest).join(touched, key, "left")
    mine = (F.col("state") == "modified") & F.col("__user").isNotNull()
    return out.select(key, F.when(mine, "user-modified").otherwise(F.col("state")).alias("state"))


def missing_from(rows: DataFrame, known: DataFrame, key: str, known_key: str | None = None) -> DataFrame:
    """Rows whose key is not known."""
    k = known.select(F.col(known_key or key).alias(key))
    return rows.join(k, key, "left_anti")


def orphan_references(rows: DataFrame, key: str, refs: str) -> DataFrame:
    """C4: key and the sorted references that no row has."""
    edges = rows.select(key, F.explode(refs).alias("__ref"))
    known = rows.select(F.col(key).alias("__ref"))
    return edges.join(known, "__ref", "left_anti").groupBy(key).agg(F.sort_array(F.collect_set("__ref")).alias("orphans"))


def inverse_edges(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Target with its distinct sources in order; done twice it gives the same edges."""
    return edges.filter(F.col(target).isNotNull()).groupBy(target).agg(F.sort_array(F.collect_set(source)).alias("used_by"))


def keyed_merge(existing: DataFrame, template: DataFrame, key: str, value: str) -> DataFrame:
    """Existing values win; outcome preserved / conflict / added, with the template's value as suggestion."""
    e = existing.select(key, F.col(value).alias("__e"), F.lit(True).alias("__has"))
    t = template.select(key, F.col(value).alias("__t"), F.lit(True).alias("__new"))
    outcome = F.when(F.col("__has").isNull(), "added").when(F.col("__new").isNotNull() & ~F.col("__e").eqNullSafe(F.col("__t")), "conflict").otherwise("preserved")
    value_now = F.when(F.col("__has"), F.col("__e")).otherwise(F.col("__t"))
    return e.join(t, key, "full_outer").select(key, value_now.alias(value), outcome.alias("outcome"), F.when(outcome == "conflict", F.col("__t")).alias("suggestion"))


def section_merge(existing: DataFrame, template: DataFrame, section: str, position: str, body: str, managed: str) -> DataFrame:
    """A managed section in the template replaces the existing one; others stay; new ones come after."""
    e = existing.select(section, F.col(position).alias("__pe"), F.col(body).alias("__e"))
    t = template.select(section, F.col(position).alias("__pt"), F.col(body).alias("__t"), F.col(managed).alias("__m"))
    both = e.join(t, section, "full_outer")
    take = F.col("__pe").isNull() | (F.coalesce("__m", F.lit(False)) & F.col("__t").isNotNull())
    return both.select(section, F.when(take, F.col("__t")).otherwise(F.col("__e")).alias(body), F.struct(F.col("__pe").isNull().alias("added"), F.coalesce("__pe", "__pt").alias("at")).alias("order"))


def path_sets(paths: DataFrame, path: str, required: Sequence[str], forbidden: Sequence[str]) -> DataFrame:
    """C11: required prefixes without a path and forbidden ones with one, in a single pass over the paths."""
    counts = paths.agg(*(F.count_if(F.col(path).startswith(p)).alias(f"n{i}") for i, p in enumerate([*required, *forbidden])))
    rows = F.array(*(F.struct(F.lit(p).alias("prefix"), F.lit("required" if i < len(required) else "forbidden").alias("rule"), F.col(f"n{i}").alias("n")) for i, p in enumerate([*required, *forbidden])))
    out = counts.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("ok", F.when(F.col("rule") == "required", F.col("n") > 0).otherwise(F.col("n") == 0))


def consistency(a: DataFrame, b: DataFrame, on: str, agent: str, at: str, most_seconds: float = 600) -> DataFrame:
    """Records of both sides by key: agent equal, times close; the number of checks passed."""
    x = a.select(on, F.col(agent).alias("__a1"), F.col(at).alias("__t1"))
    y = b.select(on, F.col(agent).alias("__a2"), F.col(at).alias("__t2"))
    near = F.abs(F.unix_micros(F.col("__t1").cast("timestamp")) - F.unix_micros(F.col("__t2").cast("timestamp"))) <= most_seconds * 1e6
    out = x.join(y, on).select(on, F.coalesce(F.col("__a1") == F.col("__a2"), F.lit(False)).alias("same_agent"), F.coalesce(near, F.lit(False)).alias("close"))
    return out.withColumn("score", F.col("same_agent").cast("int") + F.col("close").cast("int"))


def inverted_index(rows: DataFrame, key: str, items: str) -> DataFrame:
    """Item with the sorted distinct keys that list it; null lists are skipped."""
    return rows.select(key, F.explode(items).alias("item")).filter("item IS NOT NULL").groupBy("item").agg(F.sort_array(F.collect_set(key)).alias("keys"))


def posting_blocks(edges: DataFrame, item: str, key: str, size: int = 1024) -> DataFrame:
    """Item, block (from 0), n and the sorted distinct keys of the block, ``size`` of them at most.

    The keys of an item are dealt to blocks in their order, by places that are counted range by range: an item that all
    keys list is many rows, none of them long. Null items and keys are left out.
    """
    pairs = edges.select(item, key).filter(F.col(item).isNotNull() & F.col(key).isNotNull()).distinct()
    placed = running(pairs, [item], [key], F.lit(1), "__place")
    block = F.floor((F.col("__place") - 1) / size).cast("long")
    blocks = placed.groupBy(item, block.alias("block")).agg(F.sort_array(F.collect_list(key)).alias("keys"))
    return blocks.select(item, "block", F.size("keys").alias("n"), "keys")


def sharing(blocks: DataFrame, wanted: DataFrame, item: str, key: str, tile: int = 500_000) -> DataFrame:
    """Key, id, shared: of every wanted row (key, item) the ids in ``blocks`` that list one of its items, with
    the number of items they share; an id is not told about itself. Blocks are unpacked only where an item is wanted.

    Consecutive wanted keys make a tile of about ``tile`` rows. A block is sent once to each tile that wants its item and
    is unpacked and counted there, so what is shuffled are lists, not the pairs that meet. A key with more rows than that
    is no part of a tile: its pairs are dealt by id.
    """
    rows = wanted.select(key, item).filter(F.col(item).isNotNull())
    sizes = written(rows.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n")), "sharing_keys")
    upto = running(sizes.filter(F.col("__n") <= tile), [], ["__k"], F.col("__n"), "__upto")
    tiles = written(upto.select("__k", F.floor(F.col("__upto") / tile).cast("int").alias("__tile")), "sharing_tiles")
    n_tiles = (tiles.agg(F.max("__tile")).first()[0] or 0) + 1
    asked = rows.distinct().join(tiles, F.col(key).eqNullSafe(F.col("__k")), "left").select(key, item, "__tile")
    others = ~F.col(key).eqNullSafe(F.col("id"))
    lists = asked.filter("__tile IS NOT NULL").repartition(item).groupBy(item, "__tile").agg(F.collect_list(F.struct(key)).alias("__asked"))
    sent = lists.join(blocks, item).select("__tile", "__asked", "keys").repartition(n_tiles, "__tile")
    met = sent.select("__tile", "keys", F.inline("__asked")).select("__tile", key, F.explode("keys").alias("id")).filter(others)
    found = met.groupBy("__tile", key, "id").agg(F.count("*").alias("shared")).drop("__tile")
    if sizes.filter(F.col("__n") > tile).isEmpty():
        return found
    alone = asked.filter("__tile IS NULL").join(blocks, item).select(key, F.explode("keys").alias("id")).filter(others)
    return found.unionByName(alone.groupBy(key, "id").agg(F.count("*").alias("shared")))


def overlaps(a: Column, b: Column) -> Column:
    """Whether two arrays share an item; null or empty gives false."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def upsert_patterns(store: DataFrame, found: DataFrame) -> DataFrame:
    """L1: sequences of both with occurrences added up and success rates weighted by them."""
    both = store.select("sequence", "occurrences", "success_rate").unionByName(found.select("sequence", "occurrences", "success_rate"))
    return both.groupBy("sequence").agg(F.sum("occurrences").alias("occurrences"), (F.sum(F.col("success_rate") * F.col("occurrences")) / F.sum("occurrences")).alias("success_rate"))


def deep_merge(layers: DataFrame, layer: str = "layer", path: str = "path", value: str = "value", deleted: str = "is_delete", appended: str = "is_append") -> DataFrame:
    """Flattened settings (path, value) of stacked layers -> what holds at the end.

    Per path the highest layer wins. A delete at a path or above it removes what lower layers said there;
    a value at a parent path drops what lower layers said below it, and the other way round. Appends add
    their value, in layer order, to the last value that replaced. Null layers have no rows.
    """
    rows = layers.select(F.col(layer).alias("l"), F.col(path).alias("p"), F.col(value).alias("v"), F.coalesce(F.col(deleted), F.lit(False)).alias("d"), F.coalesce(F.col(appended), F.lit(False)).alias("a"))
    # What each row supersedes is keyed by its own path; what it is superseded by lies at its own or a parent path.
    parts = F.split("p", r"\.")
    above = rows.select("*", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "."))).alias("up"))
    cut = rows.filter("NOT a").groupBy(F.col("p").alias("up")).agg(F.max("l").alias("cut"))
    own = above.join(cut, "up", "left").groupBy("l", "p", "v", "d", "a").agg(F.max(F.when(F.col("up") != F.col("p"), F.col("cut"))).alias("parent"), F.max(F.when(F.col("up") == F.col("p"), F.col("cut"))).alias("same"))
    below = above.filter("up <> p AND NOT d").groupBy(F.col("up").alias("p")).agg(F.max("l").alias("child"))
    live = own.join(below, "p", "left").filter("NOT d AND l > coalesce(parent, l - 1) AND (l >= coalesce(same, l)) AND (child IS NULL OR l > child)")
    return live.groupBy(F.col("p").alias(path)).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l", "v"))), lambda x: x["v"]), ",").alias(value))


def concatenated(*scans: DataFrame) -> DataFrame:
    """The rows of all scans, by column name; what a scan lacks is null."""
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan, allowMissingColumns=True)
    return out


def ordered_union(*arrays: Column) -> Column:
    """Items of all arrays, each once, in the order first seen; a null array has none."""
    none = F.array()
    return F.array_distinct(F.concat(*(F.coalesce(a, none) for a in arrays)))


#: K3: merge strategies by file name, then by extension.
STRATEGIES = {".env": "keyed", ".env.example": "keyed", "md": "sections", "yaml": "deep", "yml": "deep", "json": "deep"}


def strategy_of(path: Column, strategies: dict[str, str] = STRATEGIES, otherwise: str = "replace") -> Column:
    """K3: the strategy named for the file name, else for its extension (case-insensitive), else ``replace``."""
    table = F.create_map(*[F.lit(x) for kv in strategies.items() for x in kv])
    name = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    extension = F.regexp_extract(name, r"^.+\.([^.]+)$", 1)
    return F.coalesce(F.try_element_at(table, name), F.try_element_at(table, extension), F.lit(otherwise))
