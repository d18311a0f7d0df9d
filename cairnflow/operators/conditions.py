"""A small condition language compiled to columns (inventory B1-B9, B21, B27, A15, A16, K2)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(>=|<=|==|!=|>|<|\(|\)|'[^']*'|\"[^\"]*\"|\$\{[\w.]+\}|[\w.]+)")
_TESTS: dict[str, Callable[[Column, Column], Column]] = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
}


class ConditionError(ValueError):
    """The text is not a condition."""


def compile_condition(text: str, columns: Sequence[str], lists: dict[str, Sequence[str]] | None = None) -> Column:
    """Comparisons, quoted strings, ``IN <named list>``, AND, OR, parentheses, bare booleans.

    A missing or null number counts as 0, a missing boolean as false, a missing string as ''.
    """
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ConditionError(f"cannot read {text[at:]!r}")
        tokens.append(m[1])
        at = m.end()
    place = 0

    def peek() -> str | None:
        return tokens[place] if place < len(tokens) else None

    def take(expected: str | None = None) -> str:
        nonlocal place
        token = peek()
        if token is None or (expected and token.upper() != expected):
            raise ConditionError(f"expected {expected or 'a value'}, found {token!r} in {text!r}")
        place += 1
        return token

    def name_of(token: str) -> str:
        return token[2:-1] if token.startswith("${") else token

    def value(token: str, like: str) -> Column:
        if token[0] in "'\"":
            return F.lit(token[1:-1])
        if re.fullmatch(r"\d+(\.\d+)?", token):
            return F.lit(float(token))
        if token.lower() in ("true", "false"):
            return F.lit(token.lower() == "true")
        name = name_of(token)
        blank = {"number": F.lit(0.0), "string": F.lit(""), "boolean": F.lit(False)}[like]
        kind = {"number": "double", "string": "string", "boolean": "boolean"}[like]
        return F.coalesce(F.col(name).cast(kind), blank) if name.split(".")[0] in columns else blank

    def kind_of(token: str) -> str | None:
        if token[0] in "'\"":
            return "string"
        if re.fullmatch(r"\d+(\.\d+)?", token):
            return "number"
        return "boolean" if token.lower() in ("true", "false") else None

    def primary() -> Column:
        if peek() == "(":
            take()
            out = either()
            take(")")
            return out
        left = take()
        following = peek()
        if following in _TESTS:
            take()
            right = take()
            kinds = {kind_of(left), kind_of(right)} - {None}
            like = kinds.pop() if len(kinds) == 1 else "number"
            return _TESTS[following](value(left, like), value(right, like))
        if following and following.upper() == "IN":
            take()
            listed = (lists or {}).get(take(), ())
            return value(left, "string").isin(list(listed)) if listed else F.lit(False)
        return value(left, "boolean")

    def both() -> Column:
        out = primary()
        while (peek() or "").upper() == "AND":
            take()
            out = out & primary()
        return out

    def either() -> Column:
        out = both()
        while (peek() or "").upper() == "OR":
            take()
            out = out | both()
        return out

    out = either()
    if peek() is not None:
        raise ConditionError(f"unexpected {peek()!r} in {text!r}")
    return out


def condition_object(field: Column, operator: str, value=None) -> Column:
    """Equals, notEquals, includes, exists; an unknown operator is true."""
    if operator == "equals":
        return field == value
    if operator == "notEquals":
        return field != value
    if operator == "includes":
        return F.array_contains(field, value)
    return field.isNotNull() if operator == "exists" else F.lit(True)


def scope_exceeds(flag: Column, requested: Column, approved: Column) -> Column:
    """The flag if given, else whether the request is the longer text."""
    return F.coalesce(flag, F.length(requested) > F.length(approved), F.lit(False))


def equals_fold(c: Column, wanted: str | None) -> Column:
    """B1: case-insensitive; null or '' matches nothing."""
    return F.lower(c) == wanted.lower() if wanted else F.lit(False)


def contains_fold(c: Column, wanted: str | None) -> Column:
    """B2."""
    return F.lower(c).contains(wanted.lower()) if wanted else F.lit(False)


def any_keyword(c: Column, wanted: Sequence[str]) -> Column:
    """An array shares a keyword, case-insensitive; none wanted matches nothing."""
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(F.transform(c, F.lower), F.array(*(F.lit(w.lower()) for w in wanted))), F.lit(False))


def all_tags(c: Column, wanted: Sequence[str]) -> Column:
    """An array holds every tag; none wanted matches all."""
    out = F.lit(True)
    for w in wanted:
        out = out & F.coalesce(F.array_contains(c, w), F.lit(False))
    return out


def checks(rules: dict[str, Column]) -> Column:
    """Array of the messages whose condition holds."""
    return F.array_compact(F.array(*(F.when(c, F.lit(message)) for message, c in rules.items())))


def validated(rules: dict[str, Column]) -> Column:
    """K2: struct(valid, errors): the messages whose condition holds, valid without any."""
    errors = checks(rules)
    return F.struct((F.size(errors) == 0).alias("valid"), errors.alias("errors"))


def duplicate_gate(relevance: Column, least: float = 0.8) -> Column:
    """Blocked if something as relevant as ``least`` is there already."""
    return F.coalesce(relevance >= least, F.lit(False))


def select_text(table: str, columns: Sequence[str] = ("*",), where: dict | None = None, order_by: str | None = None, limit: int | None = None) -> tuple[str, dict]:
    """SQL text with named parameters, for ``spark.sql(text, args)``; names are checked, values never inlined."""
    for name in [table, *columns, *(where or {}), *([order_by] if order_by else [])]:
        if name != "*" and not re.fullmatch(r"[A-Za-z_][\w.]*", name):
            raise ValueError(f"not a name: {name!r}")
    text = f"SELECT {', '.join(columns)} FROM {table}"
    if where:
        text += " WHERE " + " AND ".join(f"{k} = :{k}" for k in where)
    text += f" ORDER BY {order_by}" if order_by else ""
    text += f" LIMIT {int(limit)}" if limit is not None else ""
    return text, dict(where or {})


def statement_allowed(sql: Column) -> Column:
    """Not DROP, CREATE or ALTER."""
    return ~sql.rlike(r"(?i)^\s*(drop|create|alter)\b")


def filtered(rows: DataFrame, **wanted) -> DataFrame:
    """Equality filters on those that are given."""
    for name, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    return rows
