"""License scans by diagonal voting.

Every run of ``GRAM`` words of a text is joined with the places where a license template
has the same run. A match votes for the diagonal ``word place - template place``: the
votes of one copy of a template share a diagonal, and an inserted or lost word moves the
rest to a neighbouring one. Neighbouring diagonals are merged, and a span counts as
verified if its votes cover at least ``COVERED`` of the template's words. Votes are equal
words, not only equal hashes, so coverage is exact.

The templates are a constant of the caller: ``MAX_GRAMS`` bounds their runs, and only
they are broadcast.

Words are runs of ASCII letters and digits, lower-cased, and of all other characters above
U+007F. Defined cases: a null or empty text has no words, no labels and score 0; rows equal
in doc_id and text get the same result each; a null ``doc_id`` stays null; other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

GRAM = 3
COVERED = 0.8
MAX_GRAMS = 50_000
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    text: str  # lower-case words
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def slack(self) -> int:
        """How far a neighbouring diagonal may lie: none for short templates."""
        return len(self.words) // 8

    def grams(self) -> list[str]:
        w = self.words
        return [" ".join(w[i : i + GRAM]) for i in range(len(w) - GRAM + 1)]


# Phrases and openings of public licenses, as words.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("all-rights-reserved", "all rights reserved"),
    Template("gpl", "gnu general public license"),
    Template("mpl-2", "mozilla public license v 2 0"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except "
        "in compliance with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation",
    ),
)


def _gram_rows(templates: tuple[Template, ...]) -> list[tuple]:
    rows = [(t, q, g) for t, x in enumerate(templates) for q, g in enumerate(x.grams())]
    if any(len(x.words) < GRAM for x in templates) or len(rows) > MAX_GRAMS:
        raise ValueError(f"templates need {GRAM} words each and at most {MAX_GRAMS} runs together")
    return rows


def _words(text):
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS, -1), "")


def matches(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, text_hash, template, q, p``: equal runs at template word q and text word p."""
    spark = docs.sparkSession
    grams = spark.createDataFrame(_gram_rows(templates), "template int, q int, gram string")
    words = F.col("words")
    starts = F.when(F.size(words) >= GRAM, F.sequence(F.lit(0), F.size(words) - GRAM))
    runs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("words"))
    runs = runs.select(
        "doc_id",
        "text_hash",
        F.posexplode(F.transform(starts, lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(GRAM))))).alias("p", "run"),
    )
    # Fold all letters for the join, then compare with only ASCII folded.
    found = runs.join(F.broadcast(grams), F.lower("run") == F.col("gram"))
    exact = F.translate("run", string.ascii_uppercase, string.ascii_lowercase) == F.col("gram")
    return found.filter(exact).select("doc_id", "text_hash", "template", "q", "p").distinct()


def spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, text_hash, template, label, base, first_word, votes, covered, verified``.

    One row per merged group of diagonals; ``covered`` is the covered share of the template.
    """
    spark = docs.sparkSession
    about = spark.createDataFrame(
        [(t, x.label, x.base, len(x.words), x.slack) for t, x in enumerate(templates)],
        "template int, label string, base boolean, size int, slack int",
    )
    votes = matches(docs, templates).groupBy("doc_id", "text_hash", "template", (F.col("p") - F.col("q")).alias("diagonal"))
    votes = votes.agg(F.collect_set("q").alias("qs")).join(F.broadcast(about), "template")
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack")
    group = F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(along)
    merged = votes.withColumn("group", group).groupBy("doc_id", "text_hash", "template", "label", "base", "size", "group")
    merged = merged.agg(
        F.min(F.col("diagonal") + F.array_min("qs")).alias("first_word"),
        F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"),
    )
    words = F.array_distinct(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + (GRAM - 1)))))
    covered = F.size(words) / F.col("size")
    return merged.select(
        "doc_id", "text_hash", "template", "label", "base", "first_word",
        F.size("qs").alias("votes"), covered.alias("covered"),
        F.when(F.col("base"), covered == 1).otherwise(covered >= COVERED).alias("verified"),
    )


def _joined(label_set):
    return F.array_join(F.sort_array(label_set), ",")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per input row: its words, the base places and all labels found."""
    found = spans(docs, templates)
    base = F.col("base") & F.col("verified")
    per_text = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        _joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        _joined(F.collect_set(F.when(F.col("verified"), F.col("label")))).alias("labels"),
        F.max("covered").alias("score"),
    )
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.size(_words(F.col("text"))).cast("long").alias("n_words")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return texts.join(per_text, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
