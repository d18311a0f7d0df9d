"""Text functions (inventory H1-H3, H7-H16, H19-H21, H26-H27, H30-H32, H34, B10, B22). All are built-in expressions.

Departures from a JavaScript engine, on purpose: lengths count code points, not UTF-16 units; white space
is ASCII; words are runs of a-z not touching letters, digits or underscores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English words that carry no topic.
STOP_WORDS = "a an and are as at be by for from has have in is it of on or that the this to was were will with you your".split()


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def fuzzy_score(value: Column, query: str) -> Column:
    """H2: 100 if equal, 85 to 99 if contained (by share of length), else edit similarity below 85, 0 under a half.

    Only "equal 100", "contained >= 85" and "unrelated 0" are given; the scale between them is ours.
    """
    v, q = F.lower(text_or_empty(value)), query.lower()
    longest = F.greatest(F.length(v), F.lit(len(q)), F.lit(1))
    near = 1 - F.levenshtein(v, F.lit(q)) / longest
    return (
        F.when(F.lit(q == ""), 0.0)
        .when(v == q, 100.0)
        .when(v.contains(q), F.floor(85 + 14 * F.lit(len(q)) / longest).cast("double"))
        .when(near >= 0.5, F.floor(84 * near).cast("double"))
        .otherwise(0.0)
    )


def terms(text: Column, least: int = 3, stop: Sequence[str] = STOP_WORDS) -> Column:
    """H7, H8: all lower-cased alphanumeric runs of ``least`` or more characters, without stop words."""
    parts = F.split(F.lower(text_or_empty(text)), "[^a-z0-9]+")
    return F.filter(parts, lambda w: (F.length(w) >= least) & ~w.isin(list(stop)))


def keywords(text: Column, least: int = 3, most: int = 15, stop: Sequence[str] = STOP_WORDS) -> Column:
    """H7: the first ``most`` distinct ones of ``terms``."""
    return F.slice(F.array_distinct(terms(text, least, stop)), 1, most)


def words(text: Column) -> Column:
    """Runs of a-z after lower-casing."""
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"(?<![A-Za-z0-9_])[a-z]+(?![A-Za-z0-9_])"), F.lit(0))


def text_stats(text: Column) -> dict[str, Column]:
    """Characters, characters without white space, words, sentences, paragraphs and averages."""
    t = text_or_empty(text)
    # Counts of where a piece with something in it begins: no arrays are built.
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    n, s = count(r"\S+"), count(r"(?:^|[.!?])\s*+[^.!?\s]")
    chars = F.length(F.regexp_replace(t, r"\s+", ""))
    return {
        "chars": F.length(t),
        "chars_no_space": chars,
        "n_words": n,
        "n_sentences": s,
        "n_paragraphs": count(r"(?:^|\n\n)\s*+\S"),
        "avg_word_length": F.coalesce(F.try_divide(chars, n), F.lit(0.0)),
        "avg_sentence_words": F.coalesce(F.try_divide(n, s), F.lit(0.0)),
    }


def token_estimate(text: Column, divisor: float = 4.0) -> Column:
    """ceil(length / divisor), null counts 0. Two divisors are in use: 4 and 3.5."""
    return F.ceil(F.length(text_or_empty(text)) / divisor).cast("long")


def truncate_tokens(text: Column, n: int, divisor: float = 3.5) -> Column:
    """At most floor(n x divisor) characters, ``...`` appended where something was cut."""
    size = int(n * divisor)
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text_or_empty(text))


def slugify(text: Column) -> Column:
    """H15."""
    t = F.regexp_replace(F.trim(F.lower(text_or_empty(text))), r"[^A-Za-z0-9_\s-]", "")
    return F.regexp_replace(F.regexp_replace(t, r"[\s_-]+", "-"), "^-+|-+$", "")


def ellipsis(text: Column, n: int) -> Column:
    """At most n characters, the last one an ellipsis where something was cut; null gives ''."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 1), F.lit("…"))).otherwise(text_or_empty(text))


def checksum(text: Column) -> Column:
    """sha256 of the text without byte-order mark and with \\n line ends."""
    t = F.regexp_replace(F.regexp_replace(text_or_empty(text), "^﻿", ""), r"\r\n?", "\n")
    return F.concat(F.lit("sha256:"), F.sha2(t, 256))


def title(text: Column, n: int = 50) -> Column:
    """Up to n characters, cut at a word; null for commands (``*...``) and single words."""
    t = F.trim(text_or_empty(text))
    head = F.regexp_extract(t, rf"(?s)^(.{{1,{n}}})(\s|$)", 1)
    return F.when(t.startswith("*") | ~t.rlike(r"\s"), F.lit(None)).otherwise(F.when(head == "", F.substring(t, 1, n)).otherwise(F.trim(head)))


def interpolate(text: Column, values: dict[str, str], keep_missing: bool = False) -> Column:
    """``${NAME}`` and ``${NAME:-default}``; missing gives '' or stays as written.

    The text is cut at its placeholders once, so a value or default that looks like one stays as it is.
    """
    t, place = text_or_empty(text), r"\$\{([A-Za-z_][A-Za-z0-9_.]*)(?::-([^}]*))?\}"
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv]) if values else F.create_map().cast("map<string,string>")

    def resolved(mark: Column) -> Column:
        has_default = mark.contains(":-")
        default = F.when(has_default, F.regexp_extract(mark, place, 2)).otherwise(mark if keep_missing else F.lit(""))
        return F.coalesce(F.try_element_at(table, F.regexp_extract(mark, place, 1)), default)

    marks = F.regexp_extract_all(t, F.lit(place), F.lit(0))
    pieces = F.split(t, place, -1)
    return F.array_join(F.zip_with(pieces, F.transform(marks, resolved), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def missing_names(text: Column, values: dict[str, str]) -> Column:
    """Names used without value or default, for warnings."""
    used = F.regexp_extract_all(text_or_empty(text), F.lit(r"\$\{([A-Za-z_][A-Za-z0-9_.]*)\}"), F.lit(1))
    return F.array_except(used, F.array(*map(F.lit, values)).cast("array<string>"))


def duration_text(seconds: Column) -> Column:
    """``2h 30m``, ``5m 30s``, ``45s``; null is ``in progress``."""
    s = F.floor(seconds).cast("long")
    part = lambda n, unit: F.concat(n.cast("string"), F.lit(unit))
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return (
        F.when(s.isNull(), "in progress")
        .when(s >= 3600, F.concat_ws(" ", part(h, "h"), part(m, "m")))
        .when(s >= 60, F.concat_ws(" ", part(m, "m"), part(s % 60, "s")))
        .otherwise(part(s, "s"))
    )


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """Case-insensitive, terms are literal; blanks are skipped; empty text matches nothing."""
    t = F.lower(text_or_empty(text))
    out = F.lit(False)
    for term in terms:
        if term.strip():
            out = out | t.contains(term.strip().lower())
    return out


def wildcard(value: Column, patterns: Sequence[str]) -> Column:
    """Equal to a pattern, or below ``prefix.*``."""
    out = F.lit(False)
    for p in patterns:
        out = out | (value.startswith(p[:-1]) if p.endswith(".*") else value == p)
    return out


def purpose(text: Column, path: Column) -> Column:
    """H9: ``## Purpose`` section, else ``description:``, else first header, else the path; 200 characters."""
    some = lambda p: F.nullif(F.trim(F.regexp_extract(text_or_empty(text), p, 1)), F.lit(""))
    found = F.coalesce(some(r"(?im)^##\s+purpose\s*\n+([^\n]+)"), some(r"(?im)^\s*description:\s*([^\n]+)"), some(r"(?m)^#+\s+([^\n]+)"), path)
    return F.substring(found, 1, 200)


def dependencies(text: Column, own: Column | None = None) -> Column:
    """Names of relatively required or imported files and of YAML list items that are files, without ``own``."""
    t = text_or_empty(text)
    code = F.regexp_extract_all(t, F.lit(r"(?:require\(|from\s+|import\s+)['\"](\.{1,2}/[^'\"]+)['\"]"), F.lit(1))
    listed = F.regexp_extract_all(t, F.lit(r"(?m)^\s*-\s+([A-Za-z0-9_-]+\.(?:md|ya?ml|js))\s*$"), F.lit(1))
    name = lambda x: F.regexp_replace(F.regexp_replace(x, r"^.*/", ""), r"\.[A-Za-z0-9]+$", "")
    found = F.array_distinct(F.transform(F.concat(code, listed), name))
    return found if own is None else F.array_remove(found, own)


def paths_in(text: Column) -> Column:
    """Backticked paths and paths after wrote / created / modified / file:, each once."""
    t = text_or_empty(text)
    ticked = F.regexp_extract_all(t, F.lit(r"`([\w./-]+\.\w+)`"), F.lit(1))
    told = F.regexp_extract_all(t, F.lit(r"(?i)(?:wrote|created|modified|file:)\s+`?([\w./-]+\.\w+)"), F.lit(1))
    return F.array_distinct(F.concat(ticked, told))


def sheet_range(text: Column) -> Column:
    """``'Sheet Name'!A1:B2`` as struct; null rows for whole columns."""
    get = lambda k: F.nullif(F.regexp_extract(text_or_empty(text), r"^(?:'([^']+)'!|([^!']+)!)?([A-Z]+)(\d*)(?::([A-Z]+)(\d*))?$", k), F.lit(""))
    row = lambda k: F.try_to_number(get(k), F.lit("9999999")).cast("int")
    return F.struct(F.coalesce(get(1), get(2)).alias("sheet"), get(3).alias("first_col"), row(4).alias("first_row"), get(5).alias("last_col"), row(6).alias("last_row"))


def relevance(own_keywords: Column, own_purpose: Column, wanted_keywords: Column, wanted_purpose: Column, share: float = 0.6) -> Column:
    """H8: ``share`` of keyword overlap and the rest of purpose similarity, 0 to 1.

    The weights are given, the components' formulas ours: the part of the wanted keywords that is there (0 without
    any), and the Jaccard similarity of the purposes' words.
    """
    wanted = F.array_distinct(F.transform(wanted_keywords, F.lower))
    overlap = F.coalesce(F.try_divide(F.size(F.array_intersect(F.transform(own_keywords, F.lower), wanted)), F.size(wanted)), F.lit(0.0))
    a, b = words(own_purpose), words(wanted_purpose)
    alike = F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))
    return share * overlap + (1 - share) * alike


def filter_text(parts: dict[str, Column]) -> Column:
    """``name:value`` terms joined by spaces (all must hold) of the values that are there; values with spaces are quoted."""
    term = lambda n, v: F.when(v.rlike(r"\s"), F.concat(F.lit(f'{n}:"'), v, F.lit('"'))).otherwise(F.concat(F.lit(f"{n}:"), F.nullif(v, F.lit(""))))
    return F.concat_ws(" ", *(term(n, v) for n, v in parts.items()))
