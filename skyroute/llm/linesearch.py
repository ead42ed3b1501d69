"""Complete search for similar lines: rare shared words, word bitmaps, edit similarity.

It misses no pair of lines whose edit similarity is at least the bound, at a higher cost
than SimHash blocks. Of a line's n words at most n - SIMILARITY * n have no
counterpart in a linked one, so by the pigeonhole principle both have a word in common
among the one more than so many that are rarest in each. These words are the keys to meet
at; any order of rarity will do if it is one for all, so it is counted on a sample. At a
key a pair is dropped only if its lengths, or bitmaps of its words, show more words
without a counterpart than the similarity allows. The rest is verified.

First this finds the forms with a partner, and only the words of these travel. A group of
many similar lines is not compared pair by pair: at each key, forms that are still free
are tied to the most frequent free one whose SimHash differs in at most ``TIE`` bits,
and these few pairs are verified. What remains are pairs whose ends are not connected by
then; all of them are verified, whatever their SimHashes, so no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import write_table
from skyroute.llm.components import connect
from skyroute.llm.lineforms import by_key, can_link, fitting_pairs, line_words, missing, similar, simhashes, spans, wanted_forms
from skyroute.llm.text import ALNUM, FOLD, PRIMARY, U64, Slots, mix, signed, words_of

TIE = 16  # of 64 SimHash bits, for ties only; pairs farther apart are verified as well
SAMPLE = 8  # one text of so many is counted for the order of words
RANK_BITS, KEY_BITS, FORMS = 20, 46, 1 << 18
LANES = ("s0", "s1", "s2", "s3")
SEEN = 1 << 16


def _ranks(docs: DataFrame, fold: np.ndarray) -> np.ndarray:
    """How common words are, on a log scale, by the first ``RANK_BITS`` bits of their hash.

    It is counted on a sample of the texts. Any table gives the same links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RANK_BITS, np.int64)
        for batch in batches:
            for _, _, words in words_of(batch.column(0), ALNUM):
                slot = words.hashes(fold) >> U64(64 - RANK_BITS)
                counts += np.bincount(slot.astype(np.int64), minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["slot", "n"])

    sample = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    found = sample.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = found.toArrow()  # at most 2**RANK_BITS rows of two numbers
    counts = np.zeros(1 << RANK_BITS)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return np.minimum(np.log2(1 + counts) * 64, 2047).astype(U64)


def _rare_words(flat: np.ndarray, n: np.ndarray, ranks: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys to meet at, ``form, key``: the rarest words of each form, without repeats.

    ``flat`` has ``n[i]`` words of each form. A key is a word's rank and hash bits, so
    sorted keys are the order of rarity.
    """
    forms, keys = [], []
    ends = np.cumsum(n)
    for i in range(0, len(n), FORMS):
        own = n[i : i + FORMS]
        words = flat[ends[i] - n[i] : ends[i + len(own) - 1]]
        word = ranks[words >> U64(64 - RANK_BITS)] << U64(KEY_BITS - 11) | words >> U64(64 - KEY_BITS + 11)
        word = np.sort(np.repeat(np.arange(len(own), dtype=U64), own) << U64(KEY_BITS) | word)
        begin = np.cumsum(own) - own
        rare = word[spans(begin, begin + np.minimum(missing(own, least) + 1, own))]
        rare = rare[np.append(True, rare[1:] != rare[:-1])] if len(rare) else rare
        forms.append((rare >> U64(KEY_BITS)).astype(np.int64) + i)
        keys.append((rare & U64((1 << KEY_BITS) - 1)).astype(np.int64))
    return np.concatenate(forms), np.concatenate(keys)


def _bitmaps(flat: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """256 bits of each form in four integers, one set for each word."""
    begin = np.cumsum(n) - n
    bit, lane = U64(1) << (flat & U64(63)), flat >> U64(6) & U64(3)
    return [np.bitwise_or.reduceat(np.where(lane == U64(i), bit, U64(0)), begin) for i in range(4)]


def _keys_of_texts(ranks, least: float, fold: np.ndarray):
    """``key, a, size`` and bitmap of lines, once per piece and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, _, _, hashes, lo, hi, _ in line_words(batch.column(0), fold):
                a, once = np.unique(mix(PRIMARY.spans(hashes, lo, hi)), return_index=True)
                fresh = np.array([x not in seen for x in a.tolist()], bool)
                fresh &= can_link(hi[once] - lo[once], least)
                a, lo, hi = a[fresh], lo[once[fresh]], hi[once[fresh]]
                if not len(a):
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.update(a.tolist())
                flat, n = hashes[spans(lo, hi)], hi - lo
                form, key = _rare_words(flat, n, ranks.value, least)
                columns = [pa.array(key), signed(a[form]), pa.array(n[form].astype(np.int32))]
                columns += [signed(lane[form]) for lane in _bitmaps(flat, n)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "a", "size", *LANES])

    return run


def _keys_of_words(ranks, least: float):
    """``key``, all columns but the first, size, SimHash and bitmap of forms with ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(0).flatten().to_numpy().view(U64)
            n = batch.column(0).value_lengths().to_numpy().astype(np.int64)
            form, key = _rare_words(flat, n, ranks.value, least)
            others = batch.select(batch.schema.names[1:]).take(pa.array(form))
            sims = simhashes(flat, np.cumsum(n) - n, np.cumsum(n))
            columns = [pa.array(key), *others.columns, pa.array(n[form].astype(np.int32)), signed(sims[form])]
            columns += [signed(lane[form]) for lane in _bitmaps(flat, n)]
            yield pa.RecordBatch.from_arrays(columns, ["key", *others.schema.names, "size", "sim", *LANES])

    return run


class _Screen:
    """Which pairs of rows may be similar, by their sizes and bitmaps."""

    def __init__(self, rows: pa.Table, least: float):
        self.size = rows.column("size").to_numpy().astype(np.int64)
        self.missing = missing(self.size, least)
        self.maps = np.stack([rows.column(lane).to_numpy().view(U64) for lane in LANES], axis=1)
        self.bits = np.bitwise_count(self.maps).sum(axis=1, dtype=np.int64)
        self.least = least

    def may(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        shorter, longest = np.minimum(self.size[x], self.size[y]), np.maximum(self.size[x], self.size[y])
        both = np.bitwise_count(self.maps[x] & self.maps[y]).sum(axis=-1, dtype=np.int64)
        lone = np.maximum(self.bits[x], self.bits[y]) - both
        return (shorter >= self.least * longest - 1e-9) & (lone <= np.maximum(self.missing[x], self.missing[y]))


def _with_partner(least: float):
    """Forms that may be similar to another one; rows are sorted by key, size and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in by_key(batches):
            if not rows.num_rows:
                continue
            key, a = rows.column("key").to_numpy(), rows.column("a").to_numpy()
            first = np.append(True, (key[1:] != key[:-1]) | (a[1:] != a[:-1]))
            rows, key, a = rows.filter(pa.array(first)), key[first], a[first]
            screen, told = _Screen(rows, least), np.zeros(len(a), bool)
            for x, y in fitting_pairs(key, screen.size, least):
                near = screen.may(x, y)
                told[x[near]] = told[y[near]] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(a[told]))], ["a"])

    return run


def _pair_rows(rows: pa.Table, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    form = pa.StructArray.from_arrays([rows.column(c).combine_chunks() for c in ("a", "b")], ["a", "b"])
    return pa.RecordBatch.from_arrays([form.take(pa.array(x)), form.take(pa.array(y))], ["x", "y"])


def _ties(distance: int, least: float):
    """Pairs of each free form in reach with the first free form of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins, ends in by_key(batches):
            if not len(begins):
                continue
            sims, screen = rows.column("sim").to_numpy().view(U64), _Screen(rows, least)

            def near(x, y):
                return (np.bitwise_count(sims[x] ^ sims[y]) <= distance) & screen.may(x, y)  # noqa: B023

            two = begins[ends - begins == 2]
            two = two[near(two, two + 1)]
            heads, members = [two], [two + 1]
            for b, e in zip(begins[ends - begins > 2], ends[ends - begins > 2]):
                free = np.arange(b, e)
                while len(free) > 1:
                    head, rest = free[0], free[1:]
                    told = near(np.full(len(rest), head), rest)
                    members.append(rest[told])
                    heads.append(np.full(len(members[-1]), head))
                    free = rest[~told]
            yield _pair_rows(rows, np.concatenate(heads), np.concatenate(members))

    return run


def _open_pairs(least: float):
    """Pairs ``x < y`` that may be similar, of different roots; rows are sorted by key and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in by_key(batches):
            if not rows.num_rows:
                continue
            a, b, root, other = (rows.column(c).to_numpy() for c in ("a", "b", "root_a", "root_b"))
            screen = _Screen(rows, least)
            for x, y in fitting_pairs(rows.column("key").to_numpy(), screen.size, least):
                apart = (root[x] != root[y]) | (other[x] != other[y])
                x, y = x[apart], y[apart]
                told = screen.may(x, y)
                x, y = x[told], y[told]
                turn = (a[x] > a[y]) | (a[x] == a[y]) & (b[x] > b[y])
                if len(x):
                    yield _pair_rows(rows, np.where(turn, y, x), np.where(turn, x, y))

    return run


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for name in ("x_words", "y_words"):
                column = batch.column(name)
                ends.append((column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths())])))
            (x, i), (y, j) = ends
            same = [similar(x[i[k] : i[k + 1]], y[j[k] : j[k + 1]], least) for k in range(batch.num_rows)]
            yield batch.select(["x", "y"]).filter(pa.array(same, pa.bool_()))

    return run


def _verify(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` x, y of forms that are similar; a written table."""
    form = F.struct("a", "b")
    x = words.select(form.alias("x"), F.col("words").alias("x_words"))
    y = words.select(form.alias("y"), F.col("words").alias("y_words"))
    both = pairs.join(x, "x").join(y, "y").select("x", "y", "x_words", "y_words")
    return write_table(both.mapInArrow(_verified(similarity), "x struct<a:long,b:long>, y struct<a:long,b:long>"))


def links(docs: DataFrame, forms: DataFrame, similarity: float, fold: np.ndarray = FOLD) -> DataFrame:
    """Pairs ``x, y`` of forms that connect what verified links connect, and no more.

    ``forms`` has ``a, b, times``, one row per form.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(docs, fold))
    lanes = ", ".join(f"{lane} long" for lane in LANES)
    pair = "x struct<a:long,b:long>, y struct<a:long,b:long>"
    met = docs.select("text").mapInArrow(_keys_of_texts(ranks, similarity, fold), f"key long, a long, size int, {lanes}")
    met = met.repartition("key").sortWithinPartitions("key", "size", "a")
    partners = met.mapInArrow(_with_partner(similarity), "a long").distinct()
    wanted = write_table(forms.join(partners, "a"))
    found = docs.select("text").mapInArrow(wanted_forms(Slots(wanted.select("a")), fold), "a long, b long, words array<long>")
    words = write_table(found.dropDuplicates(["a", "b"]).join(wanted, ["a", "b"]))
    keyed = words.select("words", "a", "b", "times").mapInArrow(
        _keys_of_words(ranks, similarity), f"key long, a long, b long, times long, size int, sim long, {lanes}"
    )
    ranked = keyed.repartition("key").sortWithinPartitions("key", F.desc("times"), "a", "b")
    ties = ranked.mapInArrow(_ties(TIE, similarity), pair)
    ordered = ties.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    tied = write_table(ordered.distinct())
    sure = _verify(tied, words, similarity)
    roots = connect(sure)
    form = F.struct("a", "b")
    group = words.join(roots, form == F.col("node"), "left").withColumn("root", F.coalesce("root", form))
    group = group.select("words", "a", "b", F.col("root.a").alias("root_a"), F.col("root.b").alias("root_b"))
    at = group.mapInArrow(
        _keys_of_words(ranks, similarity),
        f"key long, a long, b long, root_a long, root_b long, size int, sim long, {lanes}",
    )
    at = at.drop("sim").repartition("key").sortWithinPartitions("key", "size")
    left = at.mapInArrow(_open_pairs(similarity), pair).distinct()
    rest = _verify(left.join(tied, ["x", "y"], "left_anti"), words, similarity)
    return roots.select(F.col("node").alias("x"), F.col("root").alias("y")).unionAll(rest)
