"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is a condition under which a text is rejected. On a bounded sample each rule's cost (seconds a
row, measured by repeated evaluation, without what any job takes) and selectivity (share rejected) are
estimated, and all rules are ordered by rejection per cost, so that the usual bad text is settled by the
cheapest telling test. :func:`passing` computes what a rule reads only when the rules before it have let the
text pass; :func:`judge` returns all features and so computes them for every row, once. The order changes the
time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import inf, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_CLASS, discard, written


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once: a lambda variable, which the optimizer does not copy."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text, none if it is null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+"), lambda w: w != "")


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", "")).cast("long")


def count_of(text: Column, char_class: str) -> Column:
    """Characters of a class written as the inside of square brackets."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{char_class}]+", "")).cast("long")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD_CLASS))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeat_words(w: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text, first ones included.

    Windows are compared by 64-bit hashes, sorted with their places: n log n in the words of one text,
    however often it repeats itself.
    """

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (width - 1))
        window = F.transform(starts, lambda i: F.struct(F.xxhash64(*[F.element_at(w, i + k) for k in range(width)]).alias("h"), i.alias("i")))
        return let(F.sort_array(window), covered)

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, zero, step)["n"]

    return let(w, lambda w: F.when(F.size(w) < width + 1, F.lit(0)).otherwise(of(w))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject`` is true where the text must go; null counts as false."""

    name: str
    reject: Column


#: What :func:`judge` returns of every text.
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = r"#*$%&|<>"


class View:
    """A text as the rules read it: its features are expressions, or columns where they are known already."""

    def __init__(self, text: Column, w: Column | None = None, known: Callable[[str], Column] | None = None):
        self.text, self.words, self.known = F.coalesce(text, F.lit("")), words(text) if w is None else w, known

    def __getitem__(self, name: str) -> Column:
        if self.known:
            return self.known(name)
        if name == "n_words":
            return F.size(self.words).cast("long")
        if name == "word_chars":
            return word_chars(self.text)
        if name == "n_symbols":
            return count_of(self.text, SYMBOLS)
        return dup_lines(self.text) if name == "n_dup_lines" else repeat_words(self.words)

    def mostly_repeated(self) -> Column:
        """Whether more than half of the words lie in windows found twice or more.

        R such windows cover at most 3 R words, and at least half of the R add no new window, so if that many words
        are covered, a twelfth of the number of words is missing from the distinct windows. Where it is not, the
        sort that tells the exact number is spared.
        """
        told = 100 * self["n_repeat_words"] > 50 * self["n_words"]
        if self.known:
            return told

        def of(w: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(w) - 3)
            window = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(3)]))
            missing = F.size(w) - 2 - F.size(F.array_distinct(window))
            return F.when((F.size(w) < 4), F.lit(False)).when(12 * missing < F.size(w), F.lit(False)).otherwise(100 * repeat_words(w) > 50 * F.size(w))

        return let(self.words, of)

    def count(self, char_class: str) -> Column:
        return count_of(self.text, char_class)

    def lines(self) -> Column:
        """Lines with a word."""
        return F.size(F.filter(F.split(self.text, "\n"), lambda x: x.rlike(WORD_CLASS)))


def base_rules(v: View) -> list[Rule]:
    """Fewer than 50 words; more than half of the words in repeated windows."""
    return [Rule("few_words", v["n_words"] < 50), Rule("repeated", v.mostly_repeated())]


def text_rules(v: View) -> list[Rule]:
    """Rules beyond the base: junk symbols, table cells, shouting, repeated lines.

    Thresholds leave a wide margin to running prose in any language with an alphabet.
    """
    chars = F.greatest(v["word_chars"], F.lit(1))
    return [
        Rule("symbols", v["n_symbols"] > 0.1 * chars),
        Rule("cells", (v["n_symbols"] > 0.2 * v["n_words"]) & (v.count("|") > 0.2 * v["n_words"])),
        Rule("capitals", v.count(r"\p{Lu}") > 0.4 * chars),
        Rule("marks", v.count(r"!?") > 0.08 * chars),
        Rule("digits", v.count(r"0-9") > 0.4 * chars),
        Rule("long_words", chars > 20 * v["n_words"]),
        Rule("dup_lines", (v["n_dup_lines"] > 1) & (v["n_dup_lines"] > 0.5 * v.lines())),
    ]


def all_rules(v: View) -> list[Rule]:
    return [*base_rules(v), *text_rules(v)]


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule: share rejected and seconds a row."""

    rule: Rule
    rejects: float
    cost: float

    @property
    def worth(self) -> float:
        return self.rejects / max(self.cost, 1e-9)


#: Rows that costs and selectivities are estimated on, and how often a rule is evaluated on each.
SAMPLE_ROWS = 300
REPEATS = 3


def estimate(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = REPEATS, shared: dict[str, Column] | None = None) -> list[Estimate]:
    """Measure every rule on about ``sample_rows`` rows, drawn by a seeded draw (a bound on the estimate alone).

    A rule is evaluated ``repeats`` times a row in one job; from its time goes what the same job takes with a rule
    that does nothing. What is lost in noise counts as a nanosecond. ``shared``: columns that rules read and that the
    cascade computes once for all of them; they are part of the sample and of no rule's cost.
    """
    rate = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.filter(F.rand(17) < rate).limit(2 * sample_rows).coalesce(1)
    sample = written(sample.withColumns(shared or {}), "rule_sample")
    hit = [F.coalesce(F.avg(F.coalesce(r.reject, F.lit(False)).cast("double")), F.lit(0.0)).alias(f"r{k}") for k, r in enumerate(rules)]
    share = sample.agg(F.count("*").alias("n"), *hit).first()

    def seconds(reject: Column, times: int = repeats) -> float:
        # A lambda is evaluated for each element, whether or not it reads it.
        hits = F.aggregate(F.sequence(F.lit(1), F.lit(times)), F.lit(0), lambda a, _: a + F.coalesce(reject, F.lit(False)).cast("int"))
        began = time.perf_counter()
        sample.agg(F.sum(hits)).collect()
        return time.perf_counter() - began

    base = min(seconds(F.lit(False)), seconds(F.lit(False)))  # the first also starts what later jobs find started

    def cost(reject: Column) -> float:
        """Seconds an evaluation; what is lost in the noise of a job is measured again, with four times as many."""
        took, times = seconds(reject) - base, repeats
        if took < 0.1:
            times = 4 * repeats
            took = seconds(reject, times) - base
        return max(took, 0.0) / (max(share["n"], 1) * times)

    # What rejects nothing comes last whatever it takes, so its time is not measured.
    out = [Estimate(rule, share[f"r{k}"], cost(rule.reject) if share[f"r{k}"] else 0.0) for k, rule in enumerate(rules)]
    discard(sample)
    return out


def ranked(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, shared: dict[str, Column] | None = None) -> list[str]:
    """Names of the rules by rejection per cost, in steps of four so that noise seldom tells; one rule needs no sample."""
    if len(rules) < 2:
        return [r.name for r in rules]
    step = lambda e: round(log2(e.worth) / 2) if e.worth else -inf
    return [e.rule.name for e in sorted(estimate(docs, rules, sample_rows, shared=shared), key=lambda e: (-step(e), e.rule.name))]


def first_failed(rules: Sequence[Rule], order: Sequence[str]) -> Column:
    """Name of the first rule in ``order`` that rejects, else null: one CASE, which stops where it is decided."""
    by_name = {r.name: r for r in rules}
    verdict = F
    for name in order:
        verdict = verdict.when(F.coalesce(by_name[name].reject, F.lit(False)), F.lit(name))
    return F.lit(None).cast("string") if verdict is F else verdict.otherwise(F.lit(None).cast("string"))


def cascade(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with kept boolean and failed_rule string (the first rule in cascade order that rejects).

    Which of several rules that reject a row is named depends on the order and so on the measured times; whether
    one does, never. Columns of these names are replaced. No rows, no sample: any order will do. A repeated row
    is judged each time alike.
    """
    failed = first_failed(rules, ranked(docs, rules, sample_rows))
    return docs.withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull())


def _order(docs: DataFrame, text: str, sample_rows: int) -> list[str]:
    """The order of all rules; a text's words, which they share, are no part of their costs."""
    return ranked(docs.select(F.col(text).alias("text")), all_rules(View(F.col("text"), F.col("words"))), sample_rows, {"words": words(F.col("text"))})


def passing(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, columns as they are.

    A text's words are split once; every other feature is computed only if a rule is reached that reads it.
    A null or empty text has fewer than 50 words and goes. Repeated rows stay or go together.
    """
    order = _order(docs, text, sample_rows)
    failed = let(words(F.col(text)), lambda w: first_failed(all_rules(View(F.col(text), w)), order))
    return docs.filter(failed.isNull())


def judge(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the ``FEATURES``, base_failed, kept and failed_rule of every row; null text: all zero.

    Columns of ``docs`` stay in front; those with a name of a result are replaced. What is computed stands in
    one generator, which a filter on the result does not move or repeat. The first failed rule is that of the
    cascade, whose order may differ between runs; the other columns do not.
    """
    order = _order(docs, text, sample_rows)

    def of(w: Column) -> Column:
        plain = View(F.col(text), w)
        return let(F.struct(*(plain[f].alias(f) for f in FEATURES)), verdict)

    def verdict(f: Column) -> Column:
        v = View(F.col(text), F.array().cast("array<string>"), f.getField)
        base = base_rules(v)
        given = [f[x].alias(x) for x in FEATURES]
        return F.struct(*given, (base[0].reject | base[1].reject).alias("base_failed"), first_failed(all_rules(v), order).alias("failed_rule"))

    names = {*FEATURES, "base_failed", "failed_rule", "kept"}
    own = [c for c in docs.columns if c.lower() not in names]
    out = docs.select(*(F.col(f"`{c}`") for c in own), F.inline(F.array(let(words(F.col(text)), of))))
    return out.withColumn("kept", F.col("failed_rule").isNull())
