"""Lines of texts as sequences of word hashes, their SimHash bits and edit similarity.

A line's normal form is its sequence of words: runs of ASCII letters, digits and
characters above U+007F, lower-cased; ``fold`` maps bytes and may write digits as 0 too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from skyroute.llm.text import (
    ALNUM,
    FOLD,
    PRIMARY,
    SECOND,
    U64,
    Slots,
    mix,
    signed,
    split_words,
    text_pieces,
    words_of,
)

PAIRS = 1 << 20  # compared at a time
LINES_BYTES = 1 << 18  # of text in a piece: what its words are hashed by stays in the processor's cache
COUNTED = 1 << 12  # words whose bits are counted at a time
PLACE_BIT = 40  # the places of a text change the leading bits, which a bitmap of lines looks at


def line_bounds(data: np.ndarray, byte_bounds: np.ndarray):
    """Each line's first byte, the byte after it, its row and its place."""
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([[0], breaks + 1, byte_bounds[1:-1]]))
    begin = begin[begin < len(data)]
    row = np.searchsorted(byte_bounds, begin, "right") - 1
    # A line's place is the number of newlines before it in its text.
    place = np.searchsorted(breaks, begin) - np.searchsorted(breaks, byte_bounds[row])
    return begin, np.append(begin[1:], len(data)), row, place


def line_words(texts: pa.Array, fold: np.ndarray = FOLD):
    """Per piece: rows, line places, words' hashes and each line's first and last word."""
    for first, last, words in words_of(texts, ALNUM, LINES_BYTES):
        begin, end, row, place = line_bounds(words.data, words.byte_bounds)
        lo, hi = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, end)
        some = hi > lo
        yield first, row[some], place[some], words.hashes(fold), lo[some], hi[some], words


def simhashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, salts: np.ndarray | None = None) -> np.ndarray:
    """Bits set in more than half of the words of each span; spans follow each other.

    With ``salts`` there is a column for each of them, of words salted by it.

    Eight counters of eight bits share an integer, so spans are counted in parts of 255.
    Integers wrap around, so a part's counters are the difference of two running sums.
    """
    found = np.zeros((len(lo), 1 if salts is None else len(salts)), U64)
    i = 0
    while i < len(lo):
        j = max(i + 1, int(np.searchsorted(hi, lo[i] + COUNTED, "right")))
        here = hashes[lo[i] : hi[j - 1]]
        here = np.ascontiguousarray(here[None]) if salts is None else mix(here ^ salts[:, None])
        found[i:j] = _bits(here, lo[i:j] - lo[i], hi[i:j] - lo[i])
        i = j
    return found[:, 0] if salts is None else found


def _bits(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n, bytes_ = hi - lo, hashes.view(np.uint8).reshape(*hashes.shape, 8).transpose(0, 2, 1)
    # A byte's bits, one in each byte of an integer.
    spread = np.unpackbits(bytes_.ravel(), bitorder="little").view(U64).reshape(-1, hashes.shape[1])
    sums = np.cumsum(spread, axis=1, out=spread)
    if n.max() < 256:
        ends = sums.take(hi - 1, axis=1)
        ends[:, 1:] -= ends[:, :-1].copy()
        more = ends.T.copy().view(np.uint8) > (n >> 1)[:, None].astype(np.uint8)
    else:
        parts = -(-n // 255)
        first = np.cumsum(parts) - parts
        starts = np.repeat(lo - 255 * first, parts) + 255 * np.arange(int(parts.sum()))
        ends = sums.take(np.append(starts[1:], hi[-1]) - 1, axis=1)
        ends[:, 1:] -= ends[:, :-1].copy()
        counts = np.add.reduceat(ends.T.copy().view(np.uint8).astype(np.int32), first, axis=0)
        more = 2 * counts > n[:, None]
    return np.packbits(more, axis=1, bitorder="little").view(U64)


def spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    n = hi - lo
    return np.arange(int(n.sum())) + np.repeat(lo - np.cumsum(n) + n, n)


def can_link(size: np.ndarray, least: float) -> np.ndarray:
    """Whether a different form can be similar to one of so many words."""
    longest = np.floor(size / least + 1e-9)
    return missing(longest, least) >= 1


def missing(size: np.ndarray, least: float) -> np.ndarray:
    """The words of a line that may lack a counterpart in a similar one that isn't longer."""
    return np.floor(size - least * size + 1e-9).astype(np.int64)


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Sorted rows in tables of whole keys, with the bounds of keys of two rows or more."""

    def cut(rows: pa.Table, bounds: np.ndarray):
        some = np.diff(bounds) > 1
        return rows, bounds[:-1][some], bounds[1:][some]

    rest = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and batch.column("key")[-1] == rest[0].column("key")[-1]:
            rest.append(batch)
            continue
        rows = pa.Table.from_batches([*rest, batch])
        key = rows.column("key").to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield cut(rows.slice(0, bounds[-1]), bounds)
        rest = rows.slice(bounds[-1]).to_batches()
    if rest:
        rows = pa.Table.from_batches(rest)
        yield cut(rows, np.array([0, rows.num_rows]))


def fitting_pairs(key: np.ndarray, size: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with one key and fitting sizes; rows are sorted by key and size."""
    block = np.cumsum(np.append(0, key[1:] != key[:-1]))
    top = int(size.max()) + 1
    longest = np.minimum(np.floor(size / least + 1e-9).astype(np.int64), top - 1)
    count = np.searchsorted(block * top + size, block * top + longest, "right") - np.arange(len(key)) - 1
    total = np.cumsum(count)
    i = 0
    while i < len(key):
        before = total[i] - count[i]
        j = max(i + 1, int(np.searchsorted(total, before + PAIRS, "right")))
        x = np.repeat(np.arange(i, j), count[i:j])
        y = x + 1 + np.arange(len(x)) - np.repeat(total[i:j] - count[i:j] - before, count[i:j])
        yield x, y
        i = j


def edit_distance(a: list, b: list) -> int:
    """Insertions, deletions and replacements between two sequences, bit-parallel."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for x in b:
        same = where.get(x, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        gain, loss = down | ~(diagonal | up) & full, up & diagonal
        score += bool(gain & top) - bool(loss & top)
        gain, loss = (gain << 1 | 1) & full, loss << 1 & full
        up, down = loss | ~(diagonal | gain) & full, gain & diagonal
    return score


def aligned(a: list, b: list, most: int) -> int:
    """Edits of a greedy alignment, at least the edit distance; it ends once they exceed ``most``."""
    n, m, i, j, edits = len(a), len(b), 0, 0, 0
    while i < n and j < m and edits <= most:
        if a[i] == b[j]:
            i, j = i + 1, j + 1
            continue
        edits += 1
        if a[i + 1 : i + 2] != b[j + 1 : j + 2]:
            if i + 1 < n and a[i + 1] == b[j]:
                j -= 1
            elif j + 1 < m and a[i] == b[j + 1]:
                i -= 1
        i, j = i + 1, j + 1
    return edits + max(n - i, m - j)


def similar(a: np.ndarray | list, b: np.ndarray | list, least: float) -> bool:
    longest, shortest = max(len(a), len(b)), min(len(a), len(b))
    if shortest < least * longest:
        return False
    a, b = (x if isinstance(x, list) else x.tolist() for x in (a, b))
    same = 0
    while same < shortest and a[same] == b[same]:
        same += 1
    if same == shortest:
        return True  # one begins with the other
    end = 0
    while end < shortest - same and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[same : len(a) - end], b[same : len(b) - end]
    if longest - max(len(a), len(b)) >= least * longest:
        return True  # so few words differ that replacing them all will do
    if longest - aligned(a, b, int(longest - least * longest)) >= least * longest:
        return True
    # The distance is at least the number of words without a counterpart anywhere.
    common = (Counter(a) & Counter(b)).total()
    if longest - (max(len(a), len(b)) - common) < least * longest:
        return False
    return longest - edit_distance(a, b) >= least * longest


def wanted_forms(wanted: Slots, fold: np.ndarray = FOLD):
    """The words of lines whose form is perhaps wanted, once per piece and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, hashes, lo, hi, _ in line_words(batch.column(0), fold):
                a, once = np.unique(mix(PRIMARY.spans(hashes, lo, hi)), return_index=True)
                some = wanted.has(a)
                a, lo, hi = a[some], lo[once[some]], hi[once[some]]
                if not len(a):
                    continue
                b = mix(SECOND.spans(hashes, lo, hi))
                words = pa.array([hashes[i:j].view(np.int64) for i, j in zip(lo, hi)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([signed(a), signed(b), words], ["a", "b", "words"])

    return run


def wanted_lines(wanted: Slots, fold: np.ndarray = FOLD):
    """Form and words of lines whose ``line_at`` is perhaps wanted; batches are texts and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_hashes = batch.column(1).to_numpy().view(U64)
            for first, _, data, byte_bounds in text_pieces(batch.column(0)):
                begin, end, row, place = line_bounds(data, byte_bounds)
                some = wanted.has(text_hashes[first + row] ^ place.astype(U64) << U64(PLACE_BIT))
                begin, end = begin[some], end[some]
                if not len(begin):
                    continue
                bounds = np.append(0, np.cumsum(end - begin))
                words = split_words(data[spans(begin, end)], bounds, ALNUM)
                hashes, lo, hi = words.hashes(fold), words.bounds[:-1], words.bounds[1:]
                lo, hi = lo[hi > lo], hi[hi > lo]
                a, b = (mix(family.spans(hashes, lo, hi)) for family in (PRIMARY, SECOND))
                ends = np.append(0, np.cumsum(hi - lo)).astype(np.int32)
                flat = pa.array(hashes[spans(lo, hi)].view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([signed(a), signed(b), lists], ["a", "b", "words"])

    return run


def line_at(text_hash: str, place: str) -> Column:
    """A number for a line of a text, of which ``wanted_lines`` knows those that are wanted."""
    return F.col(text_hash).bitwiseXOR(F.shiftleft(F.col(place).cast("long"), PLACE_BIT))
