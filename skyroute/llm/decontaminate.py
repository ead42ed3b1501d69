"""Benchmark decontamination by size-partitioned MinHash containment search.

Benchmark items are partitioned by their number of shingles into classes of a factor of
two. For a class of at most ``s`` shingles a document is cut into windows of ``2 s``
shingles, a new one every ``s``: a passage with an item lies whole in some window, so a
contained item and its window have a Jaccard similarity of at least about 0.19, however
long the document is. Each of ``HASHES`` MinHash values of item and window is a band of
its own; an item of which a window holds 0.8 is missed with a probability of at most
about 1.4e-6. Candidates are verified by exact containment: the share of the item's
distinct shingles that occur anywhere in the document.

Item bands and item shingles reach the tasks as bitmaps of fixed size (``text.Slots``);
what passes them is joined with the item tables, so their size never changes results.

Words are runs of ASCII letters, lower-cased, digits and characters above U+007F; a
shingle is ``SHINGLE`` words, or the whole text if it has fewer. Defined cases: null and
empty texts contain nothing and are contained in nothing; equal items are found each for
itself; rows equal in doc_id and text are one document; other columns are ignored by
``search`` and kept by ``remove``; without items nothing is contaminated. An item of fewer
words than a shingle is contained only in texts of just its words. A very long text is
read whole, in windows; its row carries the shingles that it shares with items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import write_table
from skyroute.llm.repeats import checked_broadcast
from skyroute.llm.text import ALNUM, FOLD, PRIMARY, U64, Slots, Words, mix, small_batches, words_of

SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 64
CLASSES = 40  # classes of at most 1, 2, 4, ... shingles
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=U64))


def _shingles(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a piece in order, and each document's first one."""
    hashes = words.hashes(FOLD)
    windows = PRIMARY.windows(hashes, shingle)[words.whole(shingle)]
    counts = np.diff(words.bounds)
    per_doc = np.maximum(counts - (shingle - 1), 0)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    if len(short):
        whole = mix(PRIMARY.spans(hashes, words.bounds[short], words.bounds[short + 1]))
        at = np.concatenate([[0], np.cumsum(per_doc)])[short]
        windows = np.insert(windows, at, mix(whole ^ counts[short].astype(U64)))
        per_doc[short] = 1
    return windows, np.concatenate([[0], np.cumsum(per_doc)])


def _bands(shingles: np.ndarray, starts: np.ndarray, size_class: int) -> np.ndarray:
    """Band values, one row per hash function, of the groups that begin at ``starts``."""
    out = np.empty((HASHES, len(starts)), U64)
    tags = _SEEDS * np.full(HASHES, CLASSES + size_class, U64)
    for i, seed in enumerate(_SEEDS):
        x = (shingles ^ seed) * U64(0x9E3779B97F4A7C15)
        x ^= x >> U64(29)
        out[i] = mix(np.minimum.reduceat(x, starts) + tags[i])
    return out


def _item_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in words_of(batch.column(1), ALNUM):
                hashes, bounds = _shingles(words, shingle)
                for i in range(last - first):
                    own = np.unique(hashes[bounds[i] : bounds[i + 1]])
                    if not len(own):
                        continue
                    size_class = int(len(own) - 1).bit_length()
                    bands = _bands(own, np.zeros(1, np.int64), size_class)[:, 0]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item_id": batch.column(0).slice(first + i, 1),
                            "size_class": pa.array([size_class], pa.int32()),
                            "bands": [bands.view(np.int64)],
                            "shingles": [own.view(np.int64)],
                        }
                    )

    return run


def index_items(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, item (unique), size_class, bands, shingles`` of every item with words."""
    key = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {key}, size_class int, bands array<long>, shingles array<long>"
    rows = items.select("item_id", "text").mapInArrow(_item_rows(shingle), schema)
    return write_table(rows.withColumn("item", F.monotonically_increasing_id()))


def _document_rows(classes: list[int], bands: Slots, members: Slots, shingle: int):
    """For documents with a band hit: the distinct hits and the distinct item shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hit_lists, shingle_lists = [], [], []
            for first, last, words in words_of(batch.column(1), ALNUM):
                hashes, bounds = _shingles(words, shingle)
                if not len(hashes):
                    continue
                member = members.has(hashes)
                docs, values = [], []
                for size_class in classes:
                    starts, ends = _windows(bounds, 1 << size_class)
                    # A window without any item shingle can't hold an item.
                    inside = np.concatenate([[0], np.cumsum(member)])
                    some = inside[np.minimum(ends, len(member))] > inside[starts]
                    if not some.any():
                        continue
                    flat, at = _gather(hashes, starts[some], ends[some])
                    found = _bands(flat, at, size_class)
                    hit = bands.has(found)
                    owner = np.searchsorted(bounds, starts[some], "right") - 1
                    docs.append(np.broadcast_to(owner, found.shape)[hit])
                    values.append(found[hit])
                if not docs:
                    continue
                docs, values = np.concatenate(docs), np.concatenate(values)
                for i in np.unique(docs):
                    own = slice(bounds[i], bounds[i + 1])
                    rows.append(first + int(i))
                    hit_lists.append(np.unique(values[docs == i]).view(np.int64))
                    shingle_lists.append(np.unique(hashes[own][member[own]]).view(np.int64))
            if rows:
                keys = batch.select([0, 2]).take(pa.array(rows, pa.int64()))
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, pa.array(hit_lists, lists), pa.array(shingle_lists, lists)],
                    ["doc_id", "text_hash", "hits", "shingles"],
                )

    return run


def _windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of each document's windows of ``2 size``, one every ``size``."""
    lengths = np.diff(bounds)
    counts = np.where(lengths > 0, np.maximum(-(-lengths // size) - 1, 1), 0)
    owner = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[owner] + place * size
    return starts, np.minimum(starts + 2 * size, bounds[owner + 1])


def _gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all spans one after another, and where each begins."""
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))], at


def search(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """``doc_id, text_hash, item_id, n_item, n_shared, containment`` of contained items."""
    spark = docs.sparkSession
    small_batches(spark)
    index = index_items(items, shingle)
    classes = sorted(r[0] for r in index.select("size_class").distinct().collect())  # at most CLASSES
    bands = index.select("item", F.explode("bands").alias("band"))
    parts = index.select(F.explode("shingles").alias("part"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    key = docs.schema["doc_id"].dataType.simpleString()
    run = _document_rows(classes, Slots(bands.select("band")), Slots(parts), shingle)
    hits = texts.mapInArrow(run, f"doc_id {key}, text_hash long, hits array<long>, shingles array<long>")
    hits = write_table(hits.dropDuplicates(["doc_id", "text_hash"]).withColumn("doc", F.monotonically_increasing_id()))
    pairs = hits.select("doc", F.explode("hits").alias("band")).join(bands, "band").select("doc", "item").distinct()
    # Shingles are compared for the pairs alone: a common one would join all its items.
    own = hits.select("doc", "doc_id", "text_hash", F.col("shingles").alias("doc_shingles"))
    both = pairs.join(own, "doc").join(index.select("item", "item_id", "shingles"), "item")
    n_shared = F.size(F.array_intersect("doc_shingles", "shingles")).cast("long")
    counted = both.select(
        "doc_id", "text_hash", "item_id", F.size("shingles").cast("long").alias("n_item"), n_shared.alias("n_shared")
    )
    share = F.col("n_shared") / F.col("n_item")
    named = counted.filter((F.col("n_shared") > 0) & (share >= containment))
    return named.select("doc_id", "text_hash", "item_id", "n_item", "n_shared", share.alias("containment"))


def remove(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    bad = search(docs, items, shingle, containment).select("doc_id", "text_hash").distinct()
    bad = checked_broadcast(write_table(bad)).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    return rows.join(bad, same, "left_anti").select("row.*")
