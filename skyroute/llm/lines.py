"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line per group.

A line's normal form is its sequence of words: runs of ASCII letters, digits and
characters above U+007F, lower-cased; with ``fold_digits`` every digit is written as 0.
Lines of one normal form are equal. Different lines are linked if

- their SimHashes, 256 bits over distinct words, agree in one of 16 blocks of 16 bits,
- they differ in at most ``DISTANCE`` bits, and
- the edit similarity of their word sequences (one less the edit distance over the longer
  length) is at least ``SIMILARITY``.

By the pigeonhole principle all lines within 15 bits agree in a block; most pairs farther
apart do as well. ``exact=True`` takes the complete search of ``linesearch`` instead, which
needs no SimHash and misses no line of that edit similarity. Linked and equal lines form
groups, and only the occurrence in the smallest (doc_id, place) stays.

Fingerprints meet first, without words: each form is sent to its 16 blocks, and a pair in
reach is taken at the first block it agrees in. They travel packed, many of neighbouring
blocks in one row. Only forms with a partner then send their words to those blocks, read
from the one line of each that was noted. There a task verifies a pair unless links found
before connect it, so a task of n lines gives fewer than n links. Blocks with more than ``TILE`` forms
are dealt into groups, and every pair of groups is a task of its own.

Defined cases: null and empty texts, and lines without words, are left as they are; rows
equal in doc_id and text are one document and keep the same lines; a null ``doc_id`` is
smallest; a text whose lines all go becomes empty; other columns pass unchanged. A very
long text without a newline is one line and one row; its edit distance is computed bit by
bit in parallel over what two lines don't share at their ends, quadratic in that length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import new_folder, scope, write_table
from skyroute.llm import linesearch
from skyroute.llm.components import connect
from skyroute.llm.lineforms import by_key, can_link, fitting_pairs, line_at, line_words, similar, simhashes, spans, wanted_lines
from skyroute.llm.repeats import checked_broadcast
from skyroute.llm.text import FOLD, FOLD_DIGITS, PRIMARY, SECOND, U64, Slots, mix, signed, small_batches

DISTANCE = 56  # of 256 bits
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 16, 16
TILE = 4096
SEEN = 1 << 16
LANES = ("s0", "s1", "s2", "s3")
SHARD, MOST_SHARDS = 1 << 13, 11  # fingerprints that meet in one place, bits of such places in a block
PACKED, SENT = 1 << 20, 512  # records packed at a time, rows of them in a batch
PART = 1 << 12  # blocks whose counts share a row
_RECORD = np.dtype([("lanes", "<u8", len(LANES)), ("size", "<u2")])
_SALTS = mix(np.arange(1, len(LANES) + 1, dtype=U64))
_PRINT = ", ".join(f"{lane} long" for lane in LANES)


def fingerprints(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """256 SimHash bits, four integers a row, of lines with ``n[i]`` words each.

    A word counts once a line, so frequent words don't make unlike lines meet.
    """
    line = np.repeat(np.arange(len(n)), n)
    # One key is sorted: the line, then as many leading bits of the hash as there is room for.
    room = U64(max(len(n), 2).bit_length())
    order = np.argsort(line.astype(U64) << U64(64) - room | hashes >> room)
    hashes, line = hashes[order], line[order]
    once = np.append(True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1]))[: len(hashes)]
    n = np.bincount(line[once], minlength=len(n))
    hashes, end = hashes[once], np.cumsum(n)
    return simhashes(hashes, end - n, end, _SALTS)


def _fold(fold_digits: bool) -> np.ndarray:
    return FOLD_DIGITS if fold_digits else FOLD


def _occurrences(fold: np.ndarray, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for first, row, place, hashes, lo, hi, _ in line_words(batch.column(1), fold):
                if not len(row):
                    continue
                keys = batch.select([0, 2]).take(pa.array(first + row))
                a, size = mix(PRIMARY.spans(hashes, lo, hi)), (hi - lo).astype(np.int32)
                once = np.unique(a, return_index=True)[1]
                once = once[can_link(size[once], least)]
                once = once[np.array([x not in seen for x in a[once].tolist()], bool)]
                if len(seen) > SEEN:
                    seen.clear()
                seen.update(a[once].tolist())
                none, prints = np.ones(len(a), bool), np.zeros((len(LANES), len(a)), U64)
                none[once] = False
                prints[:, once] = fingerprints(hashes[spans(lo[once], hi[once])], size[once]).T
                columns = [*keys.columns, pa.array(place.astype(np.int32)), signed(a)]
                columns += [signed(mix(SECOND.spans(hashes, lo, hi))), pa.array(size)]
                columns += [pa.array(lane.view(np.int64), mask=none) for lane in prints]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "text_hash", "place", "a", "b", "size", *LANES]
                )

    return run


def occurrences(docs: DataFrame, fold_digits: bool = False, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, text_hash, place, a, b, size`` of lines with words, and their fingerprints.

    a, b name the form. Forms that can be linked have a fingerprint, once per piece or a
    few times; other rows have nulls.
    """
    small_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return texts.mapInArrow(
        _occurrences(_fold(fold_digits), least),
        f"doc_id {key}, text_hash long, place int, a long, b long, size int, {_PRINT}",
    )


def forms(lines: DataFrame) -> DataFrame:
    """``a, b``, how many ``times`` they occur, ``size``, ``at``, a line of theirs, and the fingerprint."""
    most = [F.max(lane).alias(lane) for lane in LANES]  # those of one form are equal or null
    at = F.max(line_at("text_hash", "place")).alias("at")
    return lines.groupBy("a", "b").agg(F.count("*").alias("times"), F.max("size").alias("size"), at, *most)


def _blocks(prints: np.ndarray) -> np.ndarray:
    """The blocks of each fingerprint, a number below ``BLOCKS << BLOCK_BITS`` each."""
    bits = np.ascontiguousarray(prints).view("<u2").astype(np.int64)
    return bits + (np.arange(BLOCKS) << BLOCK_BITS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many forms of the task each block has, ``PART`` blocks a row."""
    counts = np.zeros(BLOCKS << BLOCK_BITS, np.int64)
    for batch in batches:
        lanes = np.stack([c.to_numpy().view(U64) for c in batch.columns], axis=1)
        np.add.at(counts, _blocks(lanes).ravel(), 1)
    for part, some in enumerate(counts.astype("<u4").reshape(-1, PART)):
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([some.tobytes()])], ["part", "counts"])


def _crowded(tile: int):
    """Blocks with more than ``tile`` forms, from all counts of the parts that are in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                here = total.setdefault(part, np.zeros(PART, np.int64))
                here += np.frombuffer(counts, "<u4")
        for part, n in total.items():
            some = np.flatnonzero(n > tile)
            yield pa.RecordBatch.from_arrays([pa.array(part * PART + some), pa.array(n[some])], ["block", "n"])

    return run


def _tiles(prints: DataFrame, tile: int) -> np.ndarray:
    """For each block the number of groups of some ``tile`` forms that it is dealt into."""
    counts = prints.select(*LANES).mapInArrow(_counts, "part int, counts binary")
    found = counts.repartition("part").mapInArrow(_crowded(tile), "block long, n long")
    found = found.toArrow()  # at most 2**20 rows of two numbers
    groups = np.ones(BLOCKS << BLOCK_BITS, np.int32)
    groups[found.column("block").to_numpy()] = -(-found.column("n").to_numpy() // tile)
    return groups


def _group(prints: np.ndarray, groups: np.ndarray) -> np.ndarray:
    return (prints[:, 0] % groups.astype(U64)).astype(np.int64)


def _places(prints: np.ndarray, wanted: np.ndarray | None, tiles: np.ndarray):
    """Rows and keys to meet at: the block, and the pair of groups where it is dealt."""
    blocks = _blocks(prints)
    row = np.repeat(np.arange(len(prints)), BLOCKS)
    if wanted is not None:
        some = (wanted[:, None] >> np.arange(BLOCKS) & 1).astype(bool).ravel()
        row, blocks = row[some], blocks.ravel()[some]
    blocks = blocks.ravel()
    groups = tiles[blocks].astype(np.int64)
    own = np.repeat(_group(prints[row], groups), groups)
    other = spans(np.zeros(len(groups), np.int64), groups)
    key = np.repeat(blocks, groups) << 32 | np.minimum(own, other) << 16 | np.maximum(own, other)
    return np.repeat(row, groups), key


class _Reach:
    """Which pairs of rows, of one key, are in reach and taken at this key."""

    def __init__(self, key: np.ndarray, prints: np.ndarray, distance: int, tiles: np.ndarray):
        self.key, self.prints, self.distance = key, prints, distance
        self.lanes = prints.T.copy()
        self.blocks = prints.view("<u2")
        self.within = (key >> 16 & 0xFFFF) == (key & 0xFFFF)
        self.group = None if self.within.all() else _group(prints, tiles[key >> 32])

    def pairs(self, size: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        half = len(LANES) // 2
        for x, y in fitting_pairs(self.key, size, least):
            apart = self._apart(self.lanes[:half], x, y)
            near = apart <= self.distance
            x, y, apart = x[near], y[near], apart[near]
            near = apart + self._apart(self.lanes[half:], x, y) <= self.distance
            if self.group is not None:
                near &= self.within[x] | (self.group[x] != self.group[y])
            x, y = x[near], y[near]
            first = (self.blocks[x] == self.blocks[y]).argmax(axis=1) == self.key[x] >> 32 + BLOCK_BITS
            yield x[first], y[first]

    @staticmethod
    def _apart(lanes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x), np.int16)
        for lane in lanes:
            found += np.bitwise_count(lane[x] ^ lane[y])
        return found


def _packed(tiles, low: int):
    """Fingerprints and sizes, packed by where they meet: ``key`` and ``records``.

    The key is that of a pair of groups, or for blocks that aren't dealt, below zero, that
    of ``2**low`` neighbouring ones.
    """

    def rows(key: np.ndarray, records: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        bounds = (np.append(begin, len(key)) * _RECORD.itemsize).astype(np.int32)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(records.view(np.uint8))]
        columns = [pa.array(key[begin]), pa.Array.from_buffers(pa.binary(), len(begin), buffers)]
        found = pa.RecordBatch.from_arrays(columns, ["key", "records"])
        for i in range(0, len(begin), SENT):
            yield found.slice(i, SENT)

    def packed(waiting: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        prints, size = (np.concatenate(x) for x in zip(*waiting))
        records = np.empty(len(size), _RECORD)
        records["lanes"], records["size"] = prints, np.minimum(size, 0xFFFF)
        # Numbers of 16 bits are sorted in proportion to their count.
        key = prints.view("<u2") >> low | np.arange(BLOCKS) << BLOCK_BITS - low
        key = key.astype(np.min_scalar_type((BLOCKS << BLOCK_BITS - low) - 1)).ravel()
        dealt = tiles.value[_blocks(prints)] > 1
        if dealt.any():
            row, pair = _places(prints, (dealt << np.arange(BLOCKS)).sum(axis=1), tiles.value)
            order = np.argsort(pair, kind="stable")
            yield from rows(pair[order], records[row[order]])
            some = np.flatnonzero(~dealt)
            order = some[np.argsort(key[some], kind="stable")]
        else:
            order = np.argsort(key, kind="stable")
        if len(order):
            yield from rows(~key[order].astype(np.int64), records[order // BLOCKS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = np.stack([batch.column(lane).to_numpy().view(U64) for lane in LANES], axis=1)
            size, places = batch.column("size").to_numpy(), tiles.value[_blocks(prints)].sum(axis=1)
            step = max(1, PACKED // int(places.max()))  # rows whose places aren't more than are packed at a time
            for i in range(0, len(size), step):
                waiting.append((prints[i : i + step], size[i : i + step]))
                n += int(places[i : i + step].sum())
                if n >= PACKED:
                    yield from packed(waiting)
                    waiting, n = [], 0
        if waiting:
            yield from packed(waiting)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch], low: int):
    """Keys, fingerprints and sizes of what meets, sorted by key and size; rows are sorted by key."""
    for rows, _, _ in by_key(batches):
        if not rows.num_rows:
            continue
        key, packed = rows.column("key").to_numpy(), rows.column("records").combine_chunks()
        bounds = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset :]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        for i, j in zip(begin, np.append(begin[1:], len(key))):
            records = np.frombuffer(packed.buffers()[2][bounds[i] : bounds[j]], _RECORD)
            prints, size = np.ascontiguousarray(records["lanes"]), records["size"].astype(np.int64)
            if key[i] < 0:
                at = ~key[i] >> BLOCK_BITS - low
                order = np.argsort(prints.view("<u2")[:, at].astype(np.int64) << 16 | size)
                prints = prints[order]
                yield (prints.view("<u2")[:, at] + (at << BLOCK_BITS)) << 32, prints, size[order]
            else:
                order = np.argsort(size)
                yield np.full(len(size), key[i]), prints[order], size[order]


def _partners(distance: int, least: float, tiles, low: int):
    """``s0`` and the blocks, as bits, where forms have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, prints, size in _unpacked(batches, low):
            reach, told = _Reach(key, prints, distance, tiles.value), np.zeros(len(key), bool)
            for x, y in reach.pairs(size, least):
                told[x] = told[y] = True
            if told.any():
                bits = 1 << (key[told] >> 32 + BLOCK_BITS)
                yield pa.RecordBatch.from_arrays([signed(prints[told, 0]), pa.array(bits)], ["s0", "blocks"])

    return run


def _keys_of_words(tiles):
    """``key``, form, size, fingerprint and words of forms at the blocks where they have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("words")
            n = words.value_lengths().to_numpy().astype(np.int64)
            prints = fingerprints(words.flatten().to_numpy().view(U64), n)
            row, key = _places(prints, batch.column("blocks").to_numpy(), tiles.value)
            others = batch.select(["a", "b", "words"]).take(pa.array(row))
            columns = [pa.array(key), *others.columns, pa.array(n[row].astype(np.int32))]
            columns += [signed(lane) for lane in prints[row].T.copy()]
            yield pa.RecordBatch.from_arrays(columns, ["key", "a", "b", "words", "size", *LANES])

    return run


def _links(distance: int, least: float, tiles):
    """Pairs that connect, in each task, all that are linked there: a form and the smallest of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[tuple[int, int], tuple[int, int]] = {}  # linked forms of this task

        def root(form):
            while (up := parent.get(form, form)) != form:
                parent[form] = parent.get(up, up)
                form = parent[form]
            return form

        for rows, _, _ in by_key(batches):
            if not rows.num_rows:
                continue
            words = rows.column("words").combine_chunks()
            flat = words.flatten().to_numpy()
            end = np.append(0, np.cumsum(words.value_lengths().to_numpy().astype(np.int64))).tolist()
            form = list(zip(rows.column("a").to_pylist(), rows.column("b").to_pylist()))
            lists: dict[int, list] = {}

            def line(i):
                if i not in lists:  # noqa: B023
                    lists[i] = flat[end[i] : end[i + 1]].tolist()  # noqa: B023
                return lists[i]  # noqa: B023

            prints = np.stack([rows.column(lane).to_numpy().view(U64) for lane in LANES], axis=1)
            reach = _Reach(rows.column("key").to_numpy(), prints, distance, tiles.value)
            for x, y in reach.pairs(rows.column("size").to_numpy().astype(np.int64), least):
                for i, j in zip(x.tolist(), y.tolist()):
                    u, v = root(form[i]), root(form[j])
                    if u != v and similar(line(i), line(j), least):
                        parent[max(u, v)] = min(u, v)
        linked = [(*root(form), *form) for form in list(parent)]
        ends = [pa.array(c, pa.int64()) for c in (zip(*linked) if linked else [()] * 4)]
        ends = [pa.StructArray.from_arrays(ends[i : i + 2], ["a", "b"]) for i in (0, 2)]
        yield pa.RecordBatch.from_arrays(ends, ["x", "y"])

    return run


def links(
    docs: DataFrame,
    distance: int = DISTANCE,
    similarity: float = SIMILARITY,
    fold_digits: bool = False,
    tile: int = TILE,
    named: DataFrame | None = None,
) -> DataFrame:
    """Pairs ``x, y`` of forms that connect what linked forms connect, and no more.

    ``named`` are the stored ``forms`` of these documents, folding and similarity.
    """
    spark, fold = docs.sparkSession, _fold(fold_digits)
    if named is None:
        named = write_table(forms(occurrences(docs, fold_digits, similarity)), hashes=True)
    prints = named.filter("s0 is not null")
    tiles = spark.sparkContext.broadcast(_tiles(prints, tile))
    shards = max(prints.count() // SHARD, 1).bit_length() - 1
    low = BLOCK_BITS - min(shards, MOST_SHARDS)
    met = prints.select("size", *LANES).mapInArrow(_packed(tiles, low), "key long, records binary")
    met = met.repartition("key").sortWithinPartitions("key")
    partners = met.mapInArrow(_partners(distance, similarity, tiles, low), "s0 long, blocks long")
    # Forms of one s0 share their blocks here; the words tell them apart.
    blocks = partners.groupBy("s0").agg(F.bit_or("blocks").alias("blocks"))
    wanted = write_table(prints.select("a", "b", "s0", "at").join(blocks, "s0").drop("s0"))
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"))
    found = texts.mapInArrow(wanted_lines(Slots(wanted.select("at")), fold), "a long, b long, words array<long>")
    words = found.dropDuplicates(["a", "b"]).join(wanted.drop("at"), ["a", "b"])
    keyed = words.mapInArrow(
        _keys_of_words(tiles), f"key long, a long, b long, words array<long>, size int, {_PRINT}"
    )
    keyed = keyed.repartition("key").sortWithinPartitions("key", "size", "a", "b")
    pair = "x struct<a:long,b:long>, y struct<a:long,b:long>"
    return keyed.mapInArrow(_links(distance, similarity, tiles), pair)


def _grouped(linked: DataFrame) -> DataFrame:
    """``a, b, root`` of all linked forms; forms of one root are connected."""
    pairs = write_table(linked)
    forms = write_table(pairs.select("x.a", "x.b").unionAll(pairs.select("y.a", "y.b")).distinct())
    name = F.struct("a", "b")
    if forms.groupBy("a").count().filter("count > 1").isEmpty():
        # No two linked forms share it, so one number stands for the form.
        name, pairs = F.col("a"), pairs.select(F.col("x.a").alias("x"), F.col("y.a").alias("y"))
    roots = connect(pairs)
    named = forms.select("a", "b", name.alias("node")).join(roots, "node", "left")
    return named.select("a", "b", F.coalesce("root", "node").alias("root"))


def repeated(
    docs: DataFrame,
    distance: int = DISTANCE,
    similarity: float = SIMILARITY,
    fold_digits: bool = False,
    exact: bool = False,
) -> DataFrame:
    """``doc_id, text_hash, places``: for each text with repeated lines, those to remove."""
    if not 0 < similarity <= 1:
        raise ValueError("the similarity must be above 0 and at most 1")
    lines = write_table(occurrences(docs, fold_digits, similarity), hashes=True)
    named = write_table(forms(lines), hashes=True)
    if exact:
        linked = linesearch.links(docs, named.select("a", "b", "times"), similarity, _fold(fold_digits))
    else:
        linked = links(docs, distance, similarity, fold_digits, named=named)
    # Forms that occur once and have no link, most of all, stay where they are.
    often = named.filter("times > 1").select("a", "b")
    member = often.join(_grouped(linked), ["a", "b"], "full")
    # A group is named by its root, or if it has one form, by both hashes of that.
    name = F.struct("a", "b") if "struct" in dict(member.dtypes)["root"] else F.col("a")
    alone = F.col("root").isNull()
    group = (F.coalesce("root", name).alias("group"), F.when(alone, F.col("b")).otherwise(0).alias("other"))
    # What hot forms and groups are joined with is written, so that Spark can split their rows.
    member = write_table(member.select("a", "b", *group))
    found = lines.select("doc_id", "text_hash", "place", "a", "b").join(member, ["a", "b"])
    found = write_table(found.drop("a", "b"))
    here = F.struct("doc_id", "text_hash", "place")
    keep = write_table(found.groupBy("group", "other").agg(F.min(here).alias("keep")))
    gone = found.join(keep, ["group", "other"]).filter(~here.eqNullSafe(F.col("keep")))
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("place")).alias("places"))


def _apply(docs: DataFrame, *how) -> DataFrame:
    """``row``, its shortened ``text``, its ``n_lines`` and the ``places`` removed."""
    folder = new_folder(docs.sparkSession)
    with scope(docs.sparkSession):
        drop = write_table(repeated(docs, *how), folder)
    drop = checked_broadcast(drop, "places")
    drop = drop.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "places")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    every = F.when(F.col("places").isNotNull(), F.split("row.text", "\n", -1))
    joined = rows.join(drop, same, "left").withColumn("every", every)
    every = F.col("every")
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("places"))
    lines = F.transform(left, lambda i: F.get(every, i))
    text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(F.array_join(lines, "\n"))
    breaks = F.octet_length("row.text") - F.octet_length(F.replace("row.text", F.lit("\n"), F.lit("")))
    return joined.select("row", text.alias("text"), (breaks + 1).cast("long").alias("n_lines"), "places")


def dedup(
    docs: DataFrame,
    distance: int = DISTANCE,
    similarity: float = SIMILARITY,
    fold_digits: bool = False,
    exact: bool = False,
) -> DataFrame:
    """``docs`` without the repeated lines; every row and column stays, ``text`` is shortened.

    ``n_chars``, where it is a column, follows the text.
    """
    out = _apply(docs, distance, similarity, fold_digits, exact)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("row.n_chars").isNotNull(), F.char_length("text").cast(kind)))
    return out.select(row.alias("row")).select("row.*")


def report(
    docs: DataFrame,
    distance: int = DISTANCE,
    similarity: float = SIMILARITY,
    fold_digits: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Per row: its lines, the lines removed and the SHA-256 of what is left (null: empty)."""
    out = _apply(docs.select("doc_id", "text"), distance, similarity, fold_digits, exact)
    return out.select(
        "row.doc_id",
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
