"""Substring dedup by recompression.

``ROUNDS`` rename token runs and pairs. A run round gives every run of equal symbols of at
most so many words one name; a pair round splits the names in two halves by a coin that
each name throws, and gives every pair of a left and a right name, neither longer than
the limit, one name. A new name is a hash of what it stands for: it is global, equal for
equal content in every document and task, without a dictionary to shuffle or to broadcast.

How a text is parsed depends on few words around: a run round reaches as far as its limit,
a pair round one symbol of at most its limit. Of a window of 50 words the outer ``MARGIN``
on either side may be parsed otherwise elsewhere, but the symbols between are the same
wherever the window occurs. They are at most ``LONGEST`` words long, so there are at least
``INTERIOR`` of them. The top symbols are named in groups of ``GROUP`` neighbours, and of
every ``INTERIOR - GROUP + 1`` consecutive groups the smallest name is an anchor.
Every window therefore holds an anchor that all its occurrences share.

Anchors are counted by Spark; those of two documents or more reveal candidate windows,
whose words ``repeats`` compares by 96 bits of hash. Copies of whole texts are left out before.
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

ROUNDS = (("run", 4), ("pair", 1), ("pair", 2), ("pair", 2))
MARGIN = sum(limit for _, limit in ROUNDS)
LONGEST = 4
INTERIOR = (repeats.WINDOW - 2 * MARGIN) // LONGEST
GROUP = 4
SLOT_BITS = 28


def _runs(sym: np.ndarray, size: np.ndarray, doc: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    first = np.ones(len(sym), bool)
    first[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(sym)))
    words = np.add.reduceat(size, at)
    named = (counts > 1) & (words <= limit)
    keep = first | ~np.repeat(named, counts)
    sym, size = sym.copy(), size.copy()
    sym[at[named]] = mix(sym[at[named]] ^ mix(counts[named].astype(U64)))
    size[at[named]] = words[named]
    return sym[keep], size[keep], doc[keep]


def _pairs(sym: np.ndarray, size: np.ndarray, doc: np.ndarray, limit: int, number: int) -> tuple[np.ndarray, ...]:
    right = (mix(sym + U64(number)) & U64(1)).astype(bool)
    short = size <= limit
    joined = ~right[:-1] & right[1:] & short[:-1] & short[1:] & (doc[:-1] == doc[1:])
    at = np.flatnonzero(joined)
    keep = np.ones(len(sym), bool)
    keep[at + 1] = False
    sym, size = sym.copy(), size.copy()
    sym[at] = mix(sym[at] * U64(3) + mix(sym[at + 1] + U64(number)))
    size[at] += size[at + 1]
    return sym[keep], size[keep], doc[keep]


def parse(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, lengths in words and documents of the top symbols of a piece, in order."""
    sym, size, doc = hashes, np.ones(len(hashes), np.int64), words.owner()
    for number, (kind, limit) in enumerate(ROUNDS, 1):
        if not len(sym):
            break
        if kind == "run":
            sym, size, doc = _runs(sym, size, doc, limit)
        else:
            sym, size, doc = _pairs(sym, size, doc, limit, number)
    return sym, size, doc


def anchors(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first words and ends of a piece's anchors."""
    sym, size, doc = parse(words, hashes)
    names = PRIMARY.windows(sym, GROUP)
    span = INTERIOR - GROUP + 1
    n = len(names) - span + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = doc[:n] == doc[INTERIOR - 1 : INTERIOR - 1 + n]
    smallest = np.argmin(np.stack([names[i : i + n] for i in range(span)]), axis=0)
    at = np.unique((np.arange(n) + smallest)[inside])
    ends = np.cumsum(size)
    return names[at], ends[at] - size[at], ends[at + GROUP - 1]


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column(0).to_numpy()
        for first, _, words in words_of(batch.column(1)):
            names, starts, _ = anchors(words, words.hashes())
            owner = first + np.searchsorted(words.bounds, starts, "right") - 1
            yield pa.RecordBatch.from_arrays([signed(names), pa.array(doc[owner])], ["name", "doc"])


def _candidates(shared: Slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, words in words_of(batch.column(1)):
                hashes = words.hashes()
                names, starts, ends = anchors(words, hashes)
                hit = shared.has(names)
                if not hit.any():
                    continue
                whole = words.whole(repeats.WINDOW)
                chosen = np.flatnonzero(repeats.covering(len(whole), starts[hit], ends[hit]) & whole)
                yield repeats.window_rows(batch, first, words, hashes, chosen)

    return run


def dedup(docs: DataFrame, slot_bits: int = SLOT_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` of every row.

    ``slot_bits`` sizes the bitmap of shared anchors: the more of it is set, the more
    windows are compared in vain; results don't depend on it.
    """
    later = repeats.later_copies(docs)
    texts = repeats.first_copies(docs, later)
    names = texts.mapInArrow(_names, "name long, doc long")
    ends = names.groupBy("name").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    shared = write_table(ends.filter("first < last").select("name"))
    windows = write_table(texts.mapInArrow(_candidates(Slots(shared, slot_bits)), repeats.WINDOW_SCHEMA))
    return repeats.cut(docs, later, write_table(repeats.later_windows(windows)))
