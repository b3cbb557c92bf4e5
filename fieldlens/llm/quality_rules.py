"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule is a Boolean expression that is true for a bad text.  On a bounded
sample each rule's cost (time over the sample) and selectivity (share that it
rejects) are estimated; rules run in the order of rejection per cost inside
one CASE expression, so a text that one rule rejects never reaches the
later ones.  The order changes the work, not the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.runtime import checkpoint

_SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Working columns of a prepared text; rules may use all of them.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL expression over the measures, ``body`` (the text)
    and ``words`` (its words)."""

    name: str
    fails: str


#: Rejected before the cascade: too short, or mostly repeated word windows.
BASE = Rule("base", "n_words < 20 OR 100 * n_repeat_words > 30 * n_words")

RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", "length(regexp_replace(body, '[^A-Za-z]', '')) >= 20 AND "
                     "2 * length(regexp_replace(body, '[^A-Z]', '')) > length(regexp_replace(body, '[^A-Za-z]', ''))"),
    Rule("stutter", "5 * size(filter(words, (w, i) -> i > 0 AND w = words[i - 1])) > n_words"),
    Rule("no_letters", "2 * size(filter(words, w -> w RLIKE '[A-Za-z]|[^\\\\x00-\\\\x7F]')) < n_words"),
)

# Positions in 8-word windows that occur twice or more: window hashes sorted
# with their positions; neighbours with one hash are repeats; the union of the
# repeats' word ranges is summed from the sorted positions.
_REPEATED = f"""
CASE WHEN n_words <= {WINDOW} OR size(array_distinct(hashes)) = size(hashes) THEN 0L ELSE
  transform(array(sort_array(transform(hashes, (h, i) -> struct(h AS h, i AS i)))), s ->
    transform(array(sort_array(filter(transform(s, (x, j) ->
        CASE WHEN (j > 0 AND s[j - 1].h = x.h) OR (j < size(s) - 1 AND s[j + 1].h = x.h) THEN x.i END),
        i -> i IS NOT NULL))), p ->
      aggregate(transform(p, (x, j) -> CASE WHEN j = size(p) - 1 THEN {WINDOW}L
                                            ELSE least({WINDOW}L, cast(p[j + 1] - x AS long)) END),
                0L, (a, b) -> a + b))[0])[0]
END"""


def prepare(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns as ``row`` plus ``body``, ``words`` and the measures.
    A null text is an empty one."""
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    words = body.select("row", "body", F.filter(F.split("body", _SPACE, -1), lambda w: w != "").alias("words"))
    counted = words.select(
        "row", "body", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("body", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.when(F.size("words") > WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW))))).alias("hashes"))
    return counted.select(
        "row", "body", "words", "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_REPEATED).alias("n_repeat_words"))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                sample_rows: int = 1000, seed: int = 42) -> list[Rule]:
    """The rules by rejection per cost, estimated on about ``sample_rows``
    rows (the documented bound); a rule's cost is its time over the prepared
    sample beyond that of reading it.  An empty table leaves the given order."""
    n = docs.count()
    if not n:
        return list(rules)
    texts = docs.select(F.col(text_col).alias("text")).sample(fraction=min(1.0, sample_rows / n), seed=seed).limit(2 * sample_rows)
    sample = checkpoint(prepare(texts).drop("row"))

    def timed(*columns: Column) -> tuple[float, tuple]:
        began = time.perf_counter()
        out = sample.agg(F.count("*"), *columns).first()
        return time.perf_counter() - began, tuple(out)

    timed()
    nothing, (rows,) = timed()
    found = []
    for k, rule in enumerate(rules):
        cost, (_, rejected) = timed(F.count_if(F.expr(rule.fails)))
        found.append((-((rejected + 0.5) / (rows + 1)) / max(cost - nothing, 1e-3), k, rule))
    return [rule for _, _, rule in sorted(found, key=lambda x: x[:2])]


def apply_rules(docs: DataFrame, rules: list[Rule] | tuple[Rule, ...] = RULES, text_col: str = "text",
                base: Rule = BASE) -> DataFrame:
    """Every input row with the measures, ``base_failed``, ``kept`` and
    ``failed_rule`` (the first rule in the given order that rejects the row,
    null if kept; with estimated orders it may differ between runs, ``kept``
    does not).  Null, empty and word-less texts fail the base rule; repeated
    rows and null ids are rows like any other.  Input columns called like an
    output column are replaced."""
    added = [*MEASURES, "base_failed", "kept", "failed_rule"]
    verdict = F.when(F.expr(base.fails), F.lit(base.name))
    for rule in rules:
        verdict = verdict.when(F.expr(rule.fails), F.lit(rule.name))
    judged = prepare(docs, text_col).select("row", *MEASURES, F.expr(base.fails).alias("base_failed"), verdict.alias("failed_rule"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in added]
    return judged.select(*kept, *MEASURES, "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
