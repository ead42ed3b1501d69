"""Quality rules: a threshold table compiled into Spark expressions, without user functions.

``measure`` computes every figure of a text natively; ``compile_rules`` turns a table of
``Rule`` rows into one boolean column each, all in one projection, and ``apply_rules``
keeps the documents that break none.

Words are runs of characters other than blank, tab, newline, vertical tab, form feed and
carriage return; lines are split at newlines. Defined cases: a null text has no words and
no lines, so all its figures are 0; empty texts likewise; other columns pass through
``measure`` unchanged; repeated rows are measured each for itself; no rows give no rows.
Ratios of a text without words (or lines) are 0.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is was that for it with as on by at are this from be or an not "
    "le la les de des du et en un une est que qui dans pour pas sur au par "
    "der die das und zu den von ist mit ein eine nicht im auf sich dem auch "
    "el los las del y se con una por para su al lo como más o"
).split()


class Rule(NamedTuple):
    """A document fails if ``metric`` is below ``least`` or above ``most``."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "mean_word_chars", least=1.5, most=20.0),
    Rule("symbols", "symbols_per_word", most=0.3),
    Rule("exclamations", "exclamations_per_word", most=0.5),
    Rule("stop_words", "stop_word_ratio", least=0.005),
    Rule("equal_lines", "dup_line_ratio", most=0.75),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.5),
    Rule("bullet_lines", "bullet_line_ratio", most=0.95),
)


def _count_chars(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _staged(docs: DataFrame) -> DataFrame:
    """The whole input row and the arrays that several figures share, each computed once."""
    text, words, hashes, pairs = (F.col(c) for c in ("text", "words", "hashes", "pairs"))
    filled = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    split = filled.withColumn("words", F.array_remove(F.split(text, SPACE, -1), ""))
    split = split.withColumn("lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    windows = split.withColumn("hashes", F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))))
    # Equal windows are neighbours among the sorted pairs; most texts have none.
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pair = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    sorted_pairs = windows.withColumn("pairs", F.when(some, F.sort_array(pair)))

    def twice(t: Column, k: Column) -> Column:
        return F.get(pairs, k - 1)["h"].eqNullSafe(t["h"]) | F.get(pairs, k + 1)["h"].eqNullSafe(t["h"])

    places = F.sort_array(F.transform(F.filter(pairs, twice), lambda t: t["i"]))
    return sorted_pairs.withColumn("places", F.coalesce(places, F.array().cast("array<int>")))


def measure(docs: DataFrame) -> DataFrame:
    """Every input row as ``row`` with ``figures``, a struct of counts and ratios of its text."""
    text, words, lines, places = (F.col(c) for c in ("text", "words", "lines", "places"))
    # A window covers the words up to the next repeated window, at most all of its own.
    steps = F.transform(places, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - x, F.lit(WINDOW))))
    n_words, n_lines = F.size(words), F.size(lines)
    counts = {
        "n_words": n_words,
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": _count_chars(text, r"[#*$%&|<>]"),
        "n_exclamations": _count_chars(text, "!"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - F.size(F.array_distinct(lines)),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*\u2022][\x20\x09-\x0D]"))),
        "n_repeat_words": F.aggregate(steps, F.lit(0), lambda a, x: a + x),
    }
    counted = _staged(docs).select("row", *(c.cast("long").alias(name) for name, c in counts.items()))
    ratios = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbols_per_word": ("n_symbols", "n_words"),
        "exclamations_per_word": ("n_exclamations", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "ellipsis_line_ratio": ("n_ellipsis_lines", "n_lines"),
        "bullet_line_ratio": ("n_bullet_lines", "n_lines"),
    }
    return counted.select(
        "row",
        F.struct(
            *counts, *(_ratio(F.col(a), F.col(b)).alias(name) for name, (a, b) in ratios.items())
        ).alias("figures"),
    )


def base_failed(figures: Column) -> Column:
    """Fewer than 20 words, or more than 30 % of the words in repeated windows."""
    return (figures["n_words"] < 20) | (100 * figures["n_repeat_words"] > 30 * figures["n_words"])


def compile_rules(figures: Column, rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One boolean column per rule: true if the document breaks it."""
    broken = {}
    for rule in rules:
        value, fails = figures[rule.metric], F.lit(False)
        if rule.least is not None:
            fails = fails | (value < rule.least)
        if rule.most is not None:
            fails = fails | (value > rule.most)
        broken[rule.name] = fails
    return broken


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row``, ``figures``, ``base_failed``, ``broken`` (a struct of booleans) and ``kept``."""
    figures = F.col("figures")
    broken = F.struct(*(c.alias(name) for name, c in compile_rules(figures, rules).items()))
    judged = measure(docs).select("row", "figures", base_failed(figures).alias("base_failed"), broken.alias("broken"))
    passed = ~F.col("base_failed")
    for rule in rules:
        passed = passed & ~F.col("broken")[rule.name]
    return judged.withColumn("kept", passed)


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with all their columns."""
    # A filter on a running id stays above the projection. A plain one would be pushed
    # through it, and the shared arrays would be computed anew for each of their uses.
    judged = judge(docs, rules).withColumn("number", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("number") >= 0)).select("row.*")
