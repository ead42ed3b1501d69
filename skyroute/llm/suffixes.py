"""Substring dedup by a sparse suffix array.

Of all suffixes of all texts, those are retained that begin at a minimiser: the place with
the smallest hash of ``GRAM`` words among ``WINDOW - PREFIX + 1`` consecutive places. Every
window of 50 words begins with so many places, so it holds a retained suffix with at
least ``PREFIX`` words of it, chosen by content alone.

Spark sorts the retained suffixes by the hash of their first ``PREFIX`` words, document
and place. The ranges of the sort cut hot prefixes as well, since the whole key decides.
Each batch of a range compares neighbours: a prefix whose first and last suffix come from
different documents is repeated. A prefix at either end of a batch may go on in the next
one, so those, two a batch, are compared once more.

No match is extended word by word. In place of that, all windows that contain a repeated
prefix are hashed over their 50 words and grouped by ``repeats``, which finds the same
repeats. Copies of whole texts are left out before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import write_table
from skyroute.llm import repeats
from skyroute.llm.text import PRIMARY, U64, Slots, Words, mix, signed, words_of

GRAM = 5
PREFIX = 25
SLOT_BITS = 28
SPAN = repeats.WINDOW - PREFIX + 1


def minimisers(words: Words, hashes: np.ndarray) -> np.ndarray:
    """First words of the suffixes that a piece retains, in order."""
    grams = PRIMARY.windows(hashes, GRAM)
    whole = words.whole(repeats.WINDOW)
    n = len(whole)
    if not n:
        return np.zeros(0, np.int64)
    # Sliding minimum by blocks: the smaller of a block's tail and the next block's head.
    padded = np.full(-(-len(grams) // SPAN) * SPAN, ~U64(0))
    padded[: len(grams)] = grams
    blocks = padded.reshape(-1, SPAN)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = np.minimum(tail[:n], head[SPAN - 1 : SPAN - 1 + n])[whole]
    # The minimum's first place in a window: the next one from its start on, among the
    # places sorted by gram and then by order.
    distinct, number = np.unique(grams, return_inverse=True)
    keys = np.sort(number * len(grams) + np.arange(len(grams)))
    wanted = np.searchsorted(distinct, smallest) * len(grams) + np.flatnonzero(whole)
    return np.unique(keys[np.searchsorted(keys, wanted)] % len(grams))


def _prefixes(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = minimisers(words, hashes)
    return at, mix(PRIMARY.spans(hashes, at, at + PREFIX))


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column(0).to_numpy()
        for first, _, words in words_of(batch.column(1)):
            at, prefix = _prefixes(words, words.hashes())
            owner = np.searchsorted(words.bounds, at, "right") - 1
            place = (at - words.bounds[owner]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [signed(prefix), pa.array(doc[first + owner]), pa.array(place)], ["prefix", "doc", "place"]
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of a sorted batch with their first and last document: the repeated ones,
    and the batch's first and last."""
    for batch in batches:
        if not batch.num_rows:
            continue
        prefix, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        first, last = doc[begins], doc[np.append(begins[1:], len(doc)) - 1]
        told = first != last
        told[[0, -1]] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(prefix[begins][told]), pa.array(first[told]), pa.array(last[told])], ["prefix", "first", "last"]
        )


def repeated_prefixes(texts: DataFrame) -> DataFrame:
    """``prefix`` hashes of retained suffixes that two or more documents have."""
    order = ["prefix", "doc", "place"]
    suffixes = texts.mapInArrow(_suffixes, "prefix long, doc long, place int")
    array = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    told = array.mapInArrow(_compare, "prefix long, first long, last long")
    ends = told.groupBy("prefix").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return ends.filter("first < last").select("prefix")


def _candidates(repeated: Slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, words in words_of(batch.column(1)):
                hashes = words.hashes()
                at, prefix = _prefixes(words, hashes)
                at = at[repeated.has(prefix)]
                if not len(at):
                    continue
                whole = words.whole(repeats.WINDOW)
                chosen = np.flatnonzero(repeats.covering(len(whole), at, at + PREFIX) & whole)
                yield repeats.window_rows(batch, first, words, hashes, chosen)

    return run


def dedup(docs: DataFrame, slot_bits: int = SLOT_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` of every row.

    ``slot_bits`` sizes the bitmap of repeated prefixes: the more of it is set, the more
    windows are compared in vain; results don't depend on it.
    """
    later = repeats.later_copies(docs)
    texts = repeats.first_copies(docs, later)
    repeated = write_table(repeated_prefixes(texts))
    windows = write_table(texts.mapInArrow(_candidates(Slots(repeated, slot_bits)), repeats.WINDOW_SCHEMA))
    return repeats.cut(docs, later, write_table(repeats.later_windows(windows)))
