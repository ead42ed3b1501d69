"""Ranked lexical search turned around: documents stream through an index of the items.

The index lists, for each term of the items, the items that hold it and how often. It is
broadcast, in blocks of items with a bounded number of entries, and one pass over the
documents a block counts each document's terms, looks them up, and adds up its scores for
all items of the block. A task keeps the best ``k`` documents of each item in a bounded
heap; the heaps of all tasks are merged by item, first in salted groups.

Weights need the number of documents, their length and the items' document frequencies;
one pass over the documents a block counts these over all of them.

Defined cases: a null or empty text has no terms, and a document or item without terms is
in no result; rows equal in ``item_id`` and text are one item, texts that share an id are
ranked apart; repeated documents are ranked each; equal scores go by ascending ``doc_id``,
null first; other columns are ignored; without documents or items there are no rows. A
document of any length is read as a whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyroute.llm.text import ALNUM, FOLD, SECOND, U64, Words, small_batches, words_of

TOP = 10
ENTRIES, ITEMS, CELLS = 1 << 20, 1 << 14, 1 << 22  # of a block; items; scores held at once
SALTS = 64


class Index(NamedTuple):
    """Sorted hashes of terms; term ``t`` has entries ``bounds[t]`` to ``bounds[t + 1]``."""

    terms: np.ndarray
    check: np.ndarray  # a second hash of each term
    bounds: np.ndarray
    items: np.ndarray
    times: np.ndarray
    n_items: int

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, and their terms."""
        hashes = words.hashes(FOLD)
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        places = np.flatnonzero(self.terms[at] == hashes)
        second = words._replace(starts=words.starts[places], ends=words.ends[places]).hashes(FOLD, SECOND)
        same = second == self.check[at[places]]
        return places[same], at[places[same]]


def make_index(texts: list[str | None]) -> Index:
    """The inverted index of the items' texts."""
    terms, checks, owners = [], [], []
    for first, _, words in words_of(pa.array(texts, pa.string()), ALNUM):
        terms.append(words.hashes(FOLD))
        checks.append(words.hashes(FOLD, SECOND))
        owners.append(words.owner() + first)
    if not terms:
        terms, checks, owners = [np.zeros(0, U64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    known, first, term = np.unique(np.concatenate(terms), return_index=True, return_inverse=True)
    entry, times = np.unique(term * max(len(texts), 1) + np.concatenate(owners), return_counts=True)
    bounds = np.searchsorted(entry // max(len(texts), 1), np.arange(len(known) + 1))
    items = (entry % max(len(texts), 1)).astype(np.int64)
    return Index(known, np.concatenate(checks)[first], bounds, items, times, len(texts))


def _counts(index: Index, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``document, term, tf`` of the terms that the index knows."""
    places, term = index.find(words)
    size = max(len(index.terms), 1)
    pair, tf = np.unique(words.owner()[places] * size + term, return_counts=True)
    return pair // size, pair % size, tf


def _statistics(docs: DataFrame, index: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the document frequency of each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, some, length = np.zeros(len(index.value.terms), np.int64), 0, 0
        for batch in batches:
            for _, _, words in words_of(batch.column(0), ALNUM):
                some += int((np.diff(words.bounds) > 0).sum())
                length += len(words.starts)
                frequency += np.bincount(_counts(index.value, words)[1], minlength=len(frequency))
        # Terms -1 and -2 stand for the two totals.
        at = np.flatnonzero(frequency)
        slot, n = np.concatenate([at, [-1, -2]]), np.concatenate([frequency[at], [some, length]])
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], ["slot", "n"])

    counted = docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = dict(counted.collect())  # at most a number for each term of the block
    frequency = np.array([found.get(t, 0) for t in range(len(index.value.terms))], np.int64)
    return found.get(-1, 0), found.get(-2, 0), frequency


class Heaps:
    """The best ``k`` documents of each item: highest score, then smallest id, null first."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.best: list[list[tuple]] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)  # scores below don't get in

    def update(self, ids: pa.Array, scores: np.ndarray) -> None:
        """``scores`` of documents by item."""
        for item in np.flatnonzero((scores >= self.floor).any(axis=0)):
            column = scores[:, item]
            at = np.flatnonzero(column >= self.floor[item])
            if len(at) > self.k:
                least = np.partition(column[at], -self.k)[-self.k]
                at = at[column[at] >= least]
            new = [(-int(column[i]), x is not None, x) for i, x in zip(at, ids.take(pa.array(at)).to_pylist())]
            self.best[item] = heapq.nsmallest(self.k, self.best[item] + new, key=_rank)
            if len(self.best[item]) == self.k:
                self.floor[item] = -self.best[item][-1][0]

    def rows(self) -> Iterator[tuple[int, Any, int]]:
        for item, best in enumerate(self.best):
            for score, _, doc_id in best:
                yield item, doc_id, -score


def _rank(entry: tuple) -> tuple:
    return entry if entry[1] else entry[:2]  # nulls are equal and not compared


def _scores(index: Index, words: Words, weights: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Scores of a piece's documents for all items, in 64-bit integers."""
    doc, term, tf = _counts(index, words)
    own = np.diff(words.bounds).astype(np.int64)
    m = 100 - 75 + (75 * own * n_docs) // length
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    out = np.zeros((len(own), index.n_items), np.int64)
    order = np.argsort(term, kind="stable")
    bounds = np.searchsorted(term[order], np.arange(len(index.terms) + 1))
    for t in np.flatnonzero(np.diff(bounds)):
        rows = order[bounds[t] : bounds[t + 1]]
        entries = slice(index.bounds[t], index.bounds[t + 1])
        out[doc[rows][:, None], index.items[entries][None, :]] += value[rows][:, None] * index.times[entries]
    return out


def _pieces(texts: pa.Array, n_items: int) -> Iterator[tuple[int, int, Words]]:
    """Pieces of few enough documents for the scores of all items."""
    rows = max(1, CELLS // max(n_items, 1))
    for begin in range(0, len(texts), rows):
        for first, last, words in words_of(texts.slice(begin, rows), ALNUM):
            yield begin + first, begin + last, words


def _search_block(docs: DataFrame, items: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    key = docs.schema["doc_id"].dataType.simpleString()
    index = spark.sparkContext.broadcast(make_index([row["text"] for row in items]))
    n_docs, length, frequency = _statistics(docs, index)
    if not length:
        return None
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * frequency + 1))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.value.n_items, k)
        for batch in batches:
            for first, last, words in _pieces(batch.column(1), index.value.n_items):
                found = _scores(index.value, words, weights, n_docs, length)
                heaps.update(batch.column(0).slice(first, last - first), found)
        rows = list(heaps.rows())
        if rows:
            item, doc_id, score = zip(*rows)
            columns = [pa.array(item, pa.int64()), pa.array(doc_id, kind), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    best = docs.select("doc_id", "text").mapInArrow(run, f"item long, doc_id {key}, score long")
    order = (F.desc("score"), F.asc_nulls_first("doc_id"))
    for group in (("item", "salt"), ("item",)):
        keys = best.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        ranked = keys.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        best = ranked.filter(F.col("rank") <= k).select("item", "doc_id", "score", "rank")
    # The block's ids: at most ``ITEMS`` rows.
    ids = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(items)], f"item long, item_id {items[0]['kind']}")
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, entries: int = ENTRIES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` best documents.

    Items are taken in blocks of about ``entries`` terms, one after the other.
    """
    if k < 1 or entries < 1:
        raise ValueError("k and entries must be above 0")
    small_batches(docs.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()
    stated = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(kind).alias("kind")).distinct()
    # A text has at most half as many terms as bytes, and one more.
    n, size = stated.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-(size or 0) // (2 * entries)), -(-n // ITEMS))
    found = None
    for block in range(blocks):
        own = stated.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        part = _search_block(docs, own, k) if own else None
        if part is not None:
            found = part if found is None else found.unionAll(part)
    if found is None:
        key = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id {key}, score long")
    return found
