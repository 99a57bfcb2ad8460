"""Quality rules as a short-circuit cascade, in DataFrame functions only.

``measures`` counts what the base rules need; ``cascade`` evaluates the rules one after another and stops at the first
that rejects, so a row pays only for the rules up to its rejection. The order comes from a sample: each rule's share of
rejected rows over its measured time per row, highest first. The order never changes which rows are kept; ``rejected_by``
names the first rule that rejects in an order that hangs on measured times, so it may differ from run to run.

Defined cases: a null text counts as empty; a blank one has no words and fails the base rule. Rows are judged alone, so
repeated rows get equal results. Further columns are carried in the struct ``row`` and can't clash with the measures.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderline.session import stage

BLANK = "[\\x20\\x09-\\x0D]+"
WINDOW, BLOCK = 8, 5000
"""Words in a window that may repeat, and in a block whose distinct words are counted: the share of distinct words in a
whole text falls with its length, whatever it is like."""
SAMPLE = 2000
"""Rows, about, on which cost and selectivity of the rules are estimated."""


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an SQL condition over ``text``, ``words`` and the measures."""

    name: str
    rejects: str


RULES = (
    Rule("symbols", "10 * n_symbols > word_chars"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("letters", "10 * size(filter(words, w -> w rlike '\\\\p{L}')) < 6 * n_words"),
    Rule("few_distinct", f"100 * aggregate(sequence(0, greatest(size(words) - 1, 0), {BLOCK}), 0, (a, i) -> a + size(array_distinct(slice(words, i + 1, {BLOCK})))) < 3 * n_words"),
)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``text``, ``words``, and the counts of words, characters, symbols and repeats."""
    base = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = base.select(
        "*",
        F.filter(F.split("text", BLANK), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    counted = split.select(
        "row", "text", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(f"if(size(words) < {WINDOW}, array(), transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))))").alias("windows"),
    )
    return _with_repeats(counted).drop("windows", "by_hash", "starts")


def _with_repeats(counted: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: windows sorted by hash, those equal to a neighbour, and the words that they cover.

    Only texts with a repeated window are sorted. Each step is a column of its own, so that no lambda evaluates an
    array anew for every element.
    """
    numbered = "transform(windows, (h, i) -> struct(h as h, i as i))"
    by_hash = counted.withColumn("by_hash", F.expr(f"if(size(array_distinct(windows)) = size(windows), null, array_sort({numbered}))"))
    starts = by_hash.withColumn(
        "starts",
        F.expr(
            "array_sort(transform(filter(by_hash, (x, k) -> coalesce(get(by_hash, k - 1).h = x.h, false)"
            " or coalesce(get(by_hash, k + 1).h = x.h, false)), x -> x.i))"
        ),
    )
    covered = f"aggregate(transform(starts, (x, k) -> least({WINDOW}, coalesce(get(starts, k + 1) - x, {WINDOW}))), 0, (a, x) -> a + x)"
    return starts.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("bigint"))


def base_failed() -> Column:
    return F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")


def ordered_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules by share of rejected rows per second on about ``sample`` rows, most first; ties keep the given order.

    The sample is drawn while the texts are read, and only its rows are measured.
    """
    some = docs.select(text_col).sample(min(1.0, sample / max(docs.count(), 1)), seed=1)
    rows = stage(measures(some, text_col).drop("row"), "rule-sample")

    def timed(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = rows.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - began, hits

    timed(F.lit(True))
    idle = timed(F.lit(True))[0]
    found = {r.name: timed(F.expr(r.rejects)) for r in rules}
    gain = {name: hits / max(seconds - idle, 1e-3) for name, (seconds, hits) in found.items()}
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rejected_by`` (the first rule that rejects, null if none) and ``kept``."""
    checked = measured.withColumn("base_failed", base_failed())
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        first = first.when(F.expr(rule.rejects), F.lit(rule.name))
    return checked.withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull())


def judged(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``docs`` as ``row`` with its measures and verdict."""
    return cascade(measures(docs, text_col), ordered_rules(docs, text_col, rules))


def kept_rows(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects. A generator drops the others: a filter would be pushed below the measures,
    which would then be evaluated anew for each of its references."""
    one = F.explode(F.when(F.col("kept"), F.array(F.lit(1))))
    return judged(docs, text_col, rules).select("row", one).select("row.*")
