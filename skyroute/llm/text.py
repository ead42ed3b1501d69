"""Words of texts and rolling hashes of them, with numpy over Arrow batches.

Hashes are polynomials over 64-bit integers, summed once a piece of text, so any window's
hash is one subtraction and one product. ``PRIMARY`` and ``SECOND`` are independent; two
hashes together make false matches negligible at any corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 19
U64 = np.uint64

BLANKS = np.ones(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[128:] = True
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD_DIGITS = FOLD.copy()
FOLD_DIGITS[48:58] = 48


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Family:
    """One family of polynomial hashes; powers are made as far as they are needed."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letters = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self._base = int(rng.integers(1, 2**62)) * 4 + 3
        self._powers = np.ones(1, U64)
        self._inverse = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            n = 1 << max(n - 1, 1).bit_length()
            inverse = pow(self._base, -1, 1 << 64)
            for name, base in (("_powers", self._base), ("_inverse", inverse)):
                steps = np.full(n, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self._powers, self._inverse

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[starts[i]:ends[i]]``, not mixed."""
        powers, inverse = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * inverse[starts]

    def windows(self, values: np.ndarray, k: int) -> np.ndarray:
        """Mixed hashes of all runs of ``k`` values, across document bounds as well."""
        n = len(values) - k + 1
        if n <= 0:
            return np.zeros(0, U64)
        starts = np.arange(n)
        return mix(self.spans(values, starts, starts + k))


PRIMARY, SECOND = Family(11), Family(23)


class Words(NamedTuple):
    """Words of consecutive documents: byte places in ``data`` and each document's words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words before each document, and all of them
    byte_bounds: np.ndarray

    def hashes(self, fold: np.ndarray | None = None, family: Family = PRIMARY) -> np.ndarray:
        letters = family.letters if fold is None else family.letters[fold]
        return mix(family.spans(letters.take(self.data), self.starts, self.ends))

    def whole(self, k: int) -> np.ndarray:
        """For each start of ``k`` words: whether they lie in one document."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        inside = np.ones(n, bool)
        for b in self.bounds[1:-1]:
            inside[max(0, b - k + 1) : min(b, n)] = False
        return inside

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def split_words(data: np.ndarray, byte_bounds: np.ndarray, letters: np.ndarray) -> Words:
    word = letters[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = byte_bounds[(byte_bounds > 0) & (byte_bounds < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, byte_bounds), byte_bounds)


def text_pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` of a text column with their bytes; null is empty.

    A piece has at most ``limit`` bytes, or one text.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(
    texts: pa.Array, letters: np.ndarray = BLANKS, limit: int = PIECE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    for first, last, data, bounds in text_pieces(texts, limit):
        yield first, last, split_words(data, bounds, letters)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows that a Python task holds at once; texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


class Slots:
    """A set of 64-bit hashes as a bitmap of fixed size, for use inside tasks.

    It is made by Spark in parts of 4 KB, so what reaches the driver and the tasks has
    ``2**bits`` bits whatever the number of hashes. A member is always found; others are
    found at the share of set bits, so callers check what it lets through with a join.
    """

    def __init__(self, hashes: DataFrame, bits: int = 24):
        self.bits = bits
        column = hashes.columns[0]
        slot = F.shiftrightunsigned(column, 64 - bits)
        parts = (
            hashes.select(slot.alias("slot"))
            .groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("map"))
        )
        table = np.zeros((1 << bits) // 8 + 4096, np.uint8)
        for row in parts.collect():  # at most 2**bits / 32768 + 1 rows of 4 KB
            # Part 1 holds values 1 to 32768, part 0 the values from -32767 to 0.
            at = row["part"] * 4096
            table[at : at + 4096] = np.frombuffer(bytes(row["map"]), np.uint8)
        self._shared = hashes.sparkSession.sparkContext.broadcast(table)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> U64(64 - self.bits)).astype(np.int64)
        at = np.where(slot > 0, 32768 + slot - 1, 0)  # value 0 is bit 0 of part 0
        return (self._shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0
