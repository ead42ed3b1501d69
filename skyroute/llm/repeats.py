"""What both substring operators share: exact repeats of ``WINDOW``-word windows.

A window of ``WINDOW`` consecutive words of a document is repeated if its word sequence
also starts in a document with a smaller ``doc_id``. The operators find candidate windows
by their own methods; ``later_windows`` keeps the repeated ones among them, comparing 96
bits of two independent hashes, and ``cut`` removes the words that they cover.

Words are runs of bytes other than ASCII blanks. Defined cases for both operators: a null
or empty text has no words; rows equal in doc_id and text are one document, which repeats
nothing of itself; a null ``doc_id`` counts as larger than all others; a repeat within a
document is kept; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import write_table
from skyroute.llm.text import PRIMARY, SECOND, Words, signed, small_batches

WINDOW = 50
BROADCAST_ROWS = 200_000
BROADCAST_SPANS = 1_000_000
_LAST = (1 << 63) - 1


def checked_broadcast(table: DataFrame, lists: str | None = None) -> DataFrame:
    """A written table, with a broadcast hint if it has few rows and entries of ``lists``.

    Each row has besides at most three numbers, so some 30 MB bound what is broadcast;
    a larger table is joined by a shuffle.
    """
    entries = F.coalesce(F.sum(F.size(lists)), F.lit(0)) if lists else F.lit(0)
    rows, spans = table.agg(F.count("*"), entries).first()
    return F.broadcast(table) if rows <= BROADCAST_ROWS and spans <= BROADCAST_SPANS else table


def keyed(docs: DataFrame) -> DataFrame:
    """``doc`` (never null, null ids last), ``hash`` of the text, ``text``."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return docs.select(doc.alias("doc"), F.xxhash64("text").alias("hash"), "text", "doc_id")


def later_copies(docs: DataFrame) -> DataFrame:
    """``doc, hash`` of texts that a smaller document has whole; a written table."""
    keys = keyed(docs).select("doc", "hash", F.xxhash64(F.lit(1), "text").alias("other"))
    first = keys.groupBy("hash", "other").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copied = first.filter("first < last").drop("last")
    later = keys.join(copied, ["hash", "other"]).filter("doc > first")
    return write_table(later.select("doc", "hash").distinct())


def first_copies(docs: DataFrame, later: DataFrame) -> DataFrame:
    """The rows of ``keyed(docs)`` but for the later copies."""
    small_batches(docs.sparkSession)
    rows = keyed(docs).drop("doc_id")
    return rows.join(checked_broadcast(later), ["doc", "hash"], "left_anti").select("doc", "text", "hash")


WINDOW_SCHEMA = "a long, b int, doc long, hash long, place int"


def covering(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` window starts give windows that contain one of the spans."""
    marks = np.zeros(n + 1, np.int32)
    first, last = np.maximum(ends - WINDOW, 0), np.minimum(starts, n - 1)
    some = first <= last
    np.add.at(marks, first[some], 1)
    np.add.at(marks, last[some] + 1, -1)
    return np.cumsum(marks[:-1]) > 0


def window_rows(batch: pa.RecordBatch, first: int, words: Words, hashes: np.ndarray, chosen: np.ndarray) -> pa.RecordBatch:
    """Hashes and places of the windows that begin at the words ``chosen`` of a piece.

    ``batch`` has the columns doc, text, hash; ``first`` is the piece's first row.
    """
    a = PRIMARY.windows(hashes, WINDOW)[chosen]
    b = SECOND.windows(words.hashes(family=SECOND), WINDOW)[chosen]
    owner = np.searchsorted(words.bounds, chosen, "right") - 1
    keys = batch.select([0, 2]).take(pa.array(first + owner))
    return pa.RecordBatch.from_arrays(
        [
            signed(a),
            pa.array((b >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            *keys.columns,
            pa.array((chosen - words.bounds[owner]).astype(np.int32)),
        ],
        ["a", "b", "doc", "hash", "place"],
    )


def later_windows(windows: DataFrame) -> DataFrame:
    """``doc, hash, spans``: the words of each text that its repeated ``windows`` cover.

    The repeated windows are written first: so the join reads its two shuffles as they
    are, and Spark can split a window that a large part of the documents has.
    """
    first = windows.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    shared = write_table(first.filter("first < last").drop("last"))
    later = windows.join(shared, ["a", "b"]).filter("doc > first")
    places = later.groupBy("doc", "hash").agg(F.collect_set("place").alias("places"))
    return places.mapInArrow(_spans, "doc long, hash long, spans array<struct<start:int,length:int>>")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows that touch, as spans of words in order."""
    for batch in batches:
        spans = []
        for places in batch.column("places"):
            at = np.sort(places.values.to_numpy())
            last = np.append(np.flatnonzero(np.diff(at) > WINDOW), len(at) - 1)
            begin, end = at[np.append(0, last[:-1] + 1)], at[last] + WINDOW
            spans.append([{"start": s, "length": e - s} for s, e in zip(begin.tolist(), end.tolist())])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        yield pa.RecordBatch.from_arrays([*batch.select(["doc", "hash"]).columns, pa.array(spans, kind)], ["doc", "hash", "spans"])


def cut(docs: DataFrame, later: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` of every row.

    ``spans`` lists the removed runs of words as (start, length).
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs).join(checked_broadcast(later.withColumn("copy", F.lit(True))), ["doc", "hash"], "left")
    rows = rows.join(checked_broadcast(spans, "spans"), ["doc", "hash"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                words = (batch.column("text")[i].as_py() or "").encode().split()
                n = len(words)
                spans = batch.column("spans")[i].as_py() or []
                if n >= WINDOW and batch.column("copy")[i].as_py():
                    spans = [{"start": 0, "length": n}]
                kept, at = [], 0
                for span in spans:
                    kept += words[at : span["start"]]
                    at = span["start"] + span["length"]
                kept += words[at:]
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), spans))
            if out:
                n, removed, digest, spans = zip(*out)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(digest, pa.string()), pa.array(spans, kind)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
                )

    schema = f"doc_id {key}, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,length:long>>"
    return rows.select("doc_id", "text", "copy", "spans").mapInArrow(run, schema)
