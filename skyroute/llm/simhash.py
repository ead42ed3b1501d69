"""SimHash near-dedup with anchor points of a covering code.

A document's fingerprint has a bit set where more than half of its shingles' XXH64
hashes have it. Fingerprints that differ in at most ``DISTANCE`` = 3 bits are linked.

Three differing bits leave one half of 32 bits with at most one. On a half, the anchors
are the words of the perfect Hamming code of length 31 with any 32nd bit: every half lies
within 1 of an anchor (the covering radius). A fingerprint's home is the nearest anchor;
it is replicated to every anchor within 1 + 1 bits, at most 17 for each half. Two linked
fingerprints therefore meet at the home of either, where their distance is compared. Only
distinct fingerprints are replicated, so copies cost nothing here.

Defined cases: a null or empty text has fingerprint 0, which links like any other; a
repeated row has the fingerprint of its twin; a null ``doc_id`` takes part, and counts as
the smallest only where a component has no other; other columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import write_table
from skyroute.llm.components import connect
from skyroute.llm.repeats import checked_broadcast
from skyroute.llm.text import signed, small_batches

SHINGLE = 3
DISTANCE = 3
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # ASCII letters and ASCII blanks only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (a signed long) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            columns = [batch.column(0), batch.column(2), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    key = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return texts.mapInArrow(run, f"doc_id {key}, text_hash long, fp long")


def _flips() -> np.ndarray:
    """For each syndrome: the bits to flip for every code word within distance 2."""
    table = np.zeros((32, 16), np.uint32)
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if i < i ^ s and i ^ s < 32]
        masks = [1 << s - 1] + [1 << i - 1 | 1 << j - 1 for i, j in pairs]
        table[s, : len(masks)] = masks
    return table


_FLIPS = _flips()
_CHECKS = [np.uint32(sum(1 << i - 1 for i in range(1, 32) if i >> b & 1)) for b in range(5)]


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within two bits of 32-bit halves, one row each, the home first.

    The second array marks the valid columns: a code word has no other within 2 bits.
    """
    half = half.astype(np.uint32)
    syndrome = np.zeros(len(half), np.uint32)
    for b, check in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(half & check) & 1).astype(np.uint32) << np.uint32(b)
    near = half[:, None] ^ _FLIPS[syndrome]
    other = near[:, :1] ^ np.uint32(1 << 31)
    valid = np.ones((len(half), 17), bool)
    valid[:, 1:16] = (syndrome > 0)[:, None]
    return np.hstack([near, other]), valid


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for side in (0, 1):
            keys, valid = anchors(fp >> np.uint64(32 * side))
            row, column = np.nonzero(valid)
            anchor = keys[row, column].astype(np.int64) | side << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), signed(fp[row]), pa.array(column == 0)], ["anchor", "fp", "home"]
            )


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``fp`` with at most ``distance`` bits."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the anchors cover distances up to 3")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = distinct.select("fp").repartition(parts).mapInArrow(_replicate, "anchor long, fp long, home boolean")
    home = at.filter("home").select("anchor", F.col("fp").alias("a"))
    guest = at.select("anchor", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return home.join(guest, "anchor").filter((F.col("a") < F.col("b")) & close).select("a", "b")


def _rooted(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and ``fp``, ``first``, ``root`` of the distinct ones."""
    table = write_table(fingerprints(docs, shingle))
    distinct = write_table(table.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connect(links(distinct, distance))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    return table, member.select("fp", "first", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest doc_id reachable) of every row."""
    table, member = _rooted(docs, shingle, distance)
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = member.join(smallest, "root").select("fp", "component_id")
    return table.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that lead their component, one each, with all their columns.

    The leader has the smallest ``doc_id``, null last, and of its texts the one with the
    smallest hash. Of rows equal in doc_id and text any one stays. So each component keeps
    one row, whatever ids its rows share with others or lack.
    """
    table, member = _rooted(docs, shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")
    keys = table.groupBy("doc_id", "text_hash", "fp").agg(F.count("*").alias("copies"))
    keys = write_table(keys.join(member.select("fp", "root"), "fp"))
    leaders = keys.groupBy("root").agg(F.min(order).alias("leader"))
    keys = keys.join(leaders, "root").withColumn("leads", order.eqNullSafe(F.col("leader")))
    # The keys that don't simply stay are fewer than those that do, so they are joined.
    other = keys.filter("not leads or copies > 1").select("doc_id", "text_hash", "leads")
    other = write_table(other)
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    single = rows.join(checked_broadcast(other), same, "left_anti").select("row.*")
    repeated = other.filter("leads")
    if repeated.isEmpty():
        return single
    # Copies meet in an aggregate, which combines them before the shuffle.
    one = rows.join(checked_broadcast(repeated), same).groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
    return single.unionAll(one.select("row.*"))
