"""How quality filters interact: every order of them, from one walk over their subsets.

A document's mask has one bit for each filter that it fails. Documents are counted by
part, mask and label class; these cells, at most 32 for a part, are all that the audit
needs. A walk in Gray-code order turns one filter on or off at a time: it changes the
counter of active failures of the cells with that bit, and a cell whose counter becomes
or stops being zero joins or leaves the survivors. That gives the survivors of all 32
subsets of active filters; each step of an order is the difference of two of them.

Filter E (a copy of a text with a smaller id) needs the smallest id of each text. Texts
are represented by their SHA-256. Rows of one text are summed up by label class before
they meet, so a text that a third of all rows hold is a few rows by then.

Defined cases: a null text is empty and equals other empty texts; a null ``lang`` is the
empty part; a null ``doc_id`` is neither smaller nor larger than any and has no labels;
rows equal in ``doc_id`` and text are documents of their own, none the copy of the other;
of several labels of one id, the largest quality and the largest toxic value count; other
columns are ignored; no rows give no parts. A text of any length is read as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyroute.llm.text import small_batches, words_of

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 3  # words; % of words; % of code points
SYMBOLS = b"#$%&*|"
CLASSES = ("n", "good", "toxic")
SPREAD = 1 << 12
OUT = {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(
    ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "long"
)

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_UPPER = (np.arange(256) > 64) & (np.arange(256) < 91)
_BEGINS = np.arange(256) & 0xC0 != 0x80  # the first byte of a code point


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(hashes[a:b])) for a, b in zip(bounds[:-1], bounds[1:])], np.int64)


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, body``: the failures of A to D, and the text's SHA-256."""
    small_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in words_of(batch.column(1)):
                n_words = np.diff(words.bounds)
                chars, upper, symbols = (
                    _per_text(which[words.data], words.byte_bounds) for which in (_BEGINS, _IS_UPPER, _IS_SYMBOL)
                )
                fails = [
                    n_words < LEAST_WORDS,
                    100 * _distinct(words.hashes(), words.bounds) < LEAST_DISTINCT * n_words,
                    100 * upper > MOST_UPPER * chars,
                    symbols > 0,
                ]
                mask = sum(fail.astype(np.int32) << bit for bit, fail in enumerate(fails))
                ends = words.byte_bounds
                body = [hashlib.sha256(words.data[a:b]).digest() for a, b in zip(ends[:-1], ends[1:])]
                keys = batch.select([0, 2]).slice(first, last - first)
                columns = [*keys.columns, pa.array(mask), pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "body"])

    texts = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("part"))
    return texts.mapInArrow(run, f"doc_id {key}, part string, mask int, body binary")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` of their id's labels."""
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.select(F.col("doc_id").alias("_id"), F.lit(0).alias("_salt"), "quality", "toxic")
    # Null ids match nothing; the salt spreads them over the tasks of the join.
    spread = F.pmod(F.xxhash64("body"), F.lit(SPREAD)).cast("int")
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), spread).otherwise(0))
    joined = rows.join(known, (F.col("doc_id") == F.col("_id")) & (F.col("salt") == F.col("_salt")), "left")
    flags = [F.coalesce(F.col(c) == 1, F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return joined.select("doc_id", "part", "mask", "body", *flags)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the filters they fail."""
    kind = ["body", "part", "mask", "good", "toxic"]
    rows = _labelled(failures(docs), labels)
    # One row an id, so that the smallest one comes with its number of rows.
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    nameless = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    by_kind = by_id.groupBy(*kind).agg(F.sum("n").alias("n"), first, nameless)
    # Few rows of one text are left: one for each part and label class.
    least = F.min("first.doc_id").over(Window.partitionBy("body"))
    originals = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0) + F.col("nameless")
    split = by_kind.withColumn("originals", originals).withColumn(
        "side",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")),
                F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
            )
        ),
    )
    sums = [F.sum(F.when(F.col(c), F.col("side.n")).otherwise(0)).alias(f"_{c}") for c in ("good", "toxic")]
    found = split.groupBy("part", F.col("side.mask").alias("_mask")).agg(F.sum("side.n").alias("n"), *sums)
    return found.select("part", F.col("_mask").alias("mask"), "n", F.col("_good").alias("good"), F.col("_toxic").alias("toxic"))


def gray_walk(cells: list[tuple[int, ...]], filters: int = len(FILTERS)) -> list[list[int]]:
    """Survivors of each subset of active filters, by subset, for each count of a cell.

    A cell is its mask and its counts. Step ``i`` of the walk toggles the filter of the
    lowest set bit of ``i``, so each subset is met once.
    """
    active, subset = [0] * len(cells), 0
    running = [sum(column) for column in zip(*(cell[1:] for cell in cells))]
    states = [[0] * (1 << filters) for _ in running]
    for step in range(1 << filters):
        if step:
            bit = step & -step
            subset ^= bit
            turn = 1 if subset & bit else -1
            for i, (mask, *counts) in enumerate(cells):
                if mask & bit:
                    before, active[i] = active[i], active[i] + turn
                    if not before or not active[i]:  # it leaves, or comes back
                        running = [total - turn * n for total, n in zip(running, counts)]
        for state, total in zip(states, running):
            state[subset] = total
    return states


def states(counted: DataFrame) -> DataFrame:
    """``part`` and, by subset of active filters, the survivors ``n``, ``good`` and ``toxic``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gray_walk([tuple(c.values()) for c in row]) for row in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in range(len(CLASSES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["part", *CLASSES])

    # At most 32 cells in a part.
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *CLASSES)).alias("cells"))
    return by_part.mapInArrow(run, "part string, " + ", ".join(f"{c} array<long>" for c in CLASSES))


def _shapley(n: np.ndarray, bit: int) -> int:
    """A filter's removals summed over all orders: each subset before it has so many orders."""
    before = [s for s in range(SUBSETS) if not s & bit]
    orders = [factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) for s in before]
    return int(sum(k * (n[s] - n[s | bit]) for k, s in zip(orders, before)))


def steps(walked: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, as differences of two states."""
    at = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            at.append((name, step, before, 1 << i))
            before |= 1 << i
    names, number, before, bit = zip(*at)
    before, bit = np.array(before), np.array(bit)
    after, every = before | bit, SUBSETS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, good, toxic = (np.array(row[c], np.int64) for c in CLASSES)
                shares = {1 << i: _shapley(n, 1 << i) for i in range(len(FILTERS))}
                columns = [
                    [row["part"]] * len(at), names, np.array(number, np.int32), n[after], n[before] - n[after],
                    n[0] - n[bit] - n[before] + n[after], n[every ^ bit] - n[every], good[before] - good[after],
                    toxic[before] - toxic[after], [shares[b] for b in bit.tolist()],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(OUT))

    schema = ", ".join(f"{name} {kind}" for name, kind in OUT.items())
    return walked.select("part", *CLASSES).mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole audit: 600 rows a part."""
    return steps(states(cells(docs, labels)))
