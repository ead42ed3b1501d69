"""SimHash components, fuzzy lines and connected components against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import xxhash
from helpers import BLANKS, LOWER, SF, WORDS, close_pairs, documents, groups, low, read
from hypothesis import given, settings
from hypothesis import strategies as st

from skyroute.llm import lineforms, lines, queries, simhash
from skyroute.llm.components import connect
from skyroute.llm.text import ALNUM, FOLD, words_of


def plain_fingerprint(text):
    words = BLANKS.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_plain_ones():
    for text in [None, "", " \n", "One", "one TWO", "É é ß x", "a b c d e f a b c"] + [d["text"] for d in read("documents")[:40]]:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    value = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert value & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_query_equals_brute_force(spark):
    docs = read("documents")
    prints = [plain_fingerprint(d["text"]) for d in docs]
    root = groups(len(docs), close_pairs(prints, 3))
    first = {}
    for d, r in zip(docs, root):
        first[r] = min(first.get(r, d["doc_id"]), d["doc_id"])
    expected = sorted((d["doc_id"], f"{f:016x}", first[r]) for d, f, r in zip(docs, prints, root))
    assert sorted(map(tuple, queries.simhash_components(spark, SF).collect())) == expected


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_close_fingerprints_meet_at_a_home(value, flips):
    other = value
    for b in flips:
        other ^= 1 << b
    met = False
    for side in (0, 1):
        halves = np.array([value >> 32 * side & 0xFFFFFFFF, other >> 32 * side & 0xFFFFFFFF], np.uint64)
        keys, valid = simhash.anchors(halves)
        met |= keys[0, 0] in keys[1][valid[1]].tolist() and keys[1, 0] in keys[0][valid[0]].tolist()
        assert all(int(k ^ h).bit_count() <= 2 for k, h in zip(keys[0][valid[0]], [int(halves[0])] * 17))
    assert met


def test_links_are_all_links(spark):
    rng = random.Random(3)
    values = {0, 7, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        values |= {base} | {base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(6)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    expected = {frozenset((signed[i], signed[j])) for i, j in close_pairs(values, 3)}
    assert {frozenset(r) for r in found.collect()} == expected


def test_components_keep_one_and_edges(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = [(5, text), (3, text), (3, text), (9, None), (8, ""), (None, " "), (7, text + " end"), (2, "alone here")]
    found = {(r.doc_id, r.component_id) for r in simhash.components(documents(spark, docs)).collect()}
    assert {(5, 3), (3, 3), (9, 8), (8, 8), (None, 8), (2, 2)} <= found
    kept = simhash.keep_one(documents(spark, docs))
    assert kept.columns == documents(spark, docs).columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids in ([2, 3, 8], [2, 3, 7, 8])
    assert simhash.keep_one(documents(spark, docs).limit(0)).collect() == []


def test_keep_one_keeps_unlinked_rows_without_own_ids(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(80))
    docs = [(None, text(c)) for c in "abcd"] + [(None, text("a")), (None, text("e")), (5, text("e"))]
    docs += [(7, text("f")), (7, text("g")), (7, text("g")), (8, text("g"))]
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(documents(spark, docs)).collect()), key=str)
    expected = [(None, text(c)) for c in "abcd"] + [(5, text("e")), (7, text("f")), (7, text("g"))]
    assert kept == sorted(expected, key=str)
    alone = [(None, text("a")), (None, text("a")), (1, text("b"))]
    assert simhash.keep_one(documents(spark, alone)).count() == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_connected_components(spark, pairs):
    found = connect(spark.createDataFrame([*pairs, (50, 51), (51, 52), (52, 53), (53, 54)], "a long, b long"))
    root = groups(60, [*pairs, (50, 51), (51, 52), (52, 53), (53, 54)])
    assert {r.node: r.root for r in found.collect()} == {i: r for i, r in enumerate(root) if i != r}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20))
def test_edit_distance(a, b):
    assert lineforms.edit_distance(a, b) == plain_distance(a, b)
    x, y = np.array(a, np.int64), np.array(b, np.int64)
    longest = max(len(a), len(b))
    assert lineforms.similar(x, y, 0.8) == (longest - plain_distance(a, b) >= 0.8 * longest)


def form(line):
    return tuple(WORDS.findall(line.translate(LOWER)))


def in_reach(forms):
    """Pairs of forms whose SimHashes agree in a block and differ in at most ``DISTANCE`` bits."""
    hashes = np.concatenate([words.hashes(FOLD) for _, _, words in words_of(pa.array([" ".join(f) for f in forms]), ALNUM)])
    prints = lines.fingerprints(hashes, np.array([len(f) for f in forms]))
    numbers = [sum(int(lane) << 64 * k for k, lane in enumerate(row)) for row in prints]
    blocks = prints.copy().view("<u2")
    for i in range(len(forms)):
        for j in np.flatnonzero((blocks[i + 1 :] == blocks[i]).any(axis=1)) + i + 1:
            if (numbers[i] ^ numbers[j]).bit_count() <= lines.DISTANCE:
                yield i, int(j)


def plain_lines(docs):
    """Per document: places of the lines to remove."""
    where = {}
    for d, t in docs:
        for p, line in enumerate((t or "").split("\n")):
            if form(line):
                where.setdefault(form(line), set()).add(((d is not None, d or 0), p))
    forms = list(where)
    pairs = []
    for i, j in in_reach(forms):
        longest = max(len(forms[i]), len(forms[j]))
        if longest - plain_distance(forms[i], forms[j]) >= lines.SIMILARITY * longest:
            pairs.append((i, j))
    members = {}
    for f, r in zip(forms, groups(len(forms), pairs)):
        members.setdefault(r, set()).update(where[f])
    gone = {}
    for places in members.values():
        for d, p in sorted(places)[1:]:
            gone.setdefault(d, set()).add(p)
    return gone


def test_lines_equal_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in read("documents")]
    gone = plain_lines(docs)
    expected = set()
    for d, t in docs:
        drop = gone.get((True, d), set())
        left = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in drop)
        expected.add((d, t.count("\n") + 1, len(drop), hashlib.sha256(left.encode()).hexdigest()))
    assert {tuple(r) for r in queries.fuzzy_lines(spark, SF).collect()} == expected


def test_fuzzy_lines_and_edges(spark):
    line = " ".join(f"word{i}" for i in "abcdefghijklmnopqrstuvwxyz" * 8)
    near = line.replace("wordq", "other", 1)
    docs = [
        (4, f"Unique one\n{line}\n\n ---\nUnique two"), (2, f"{near}\nseen 2 times"), (2, f"{near}\nseen 2 times"),
        (6, "SEEN 7 times!\n\nlast"), (7, None), (8, ""), (9, "\n\n"), (10, "last"), (None, "only\nonly"),
    ]
    table = documents(spark, docs)
    out = lines.dedup(table)
    assert out.columns == table.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    gone = plain_lines(docs)
    expected = []
    for d, t in docs:
        drop = gone.get((d is not None, d or 0), set())
        left = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in drop)
        expected.append((d, left, None if left is None else len(left)))
    assert got == sorted(expected, key=str)
    assert (10, "", 0) in got and (6, "SEEN 7 times!\n\nlast", 19) in got
    folded = {r.doc_id: r.text for r in lines.dedup(table, fold_digits=True).collect()}
    assert folded[6] == "\nlast"
    assert lines.dedup(table.limit(0)).collect() == []


def test_all_similar_lines_are_linked(spark):
    rng = random.Random(5)
    vocabulary = [f"w{c}{d}x" for c in "abcdefghij" for d in "klmnopqrstuvwxyz"]
    texts = []
    for n in [3, 4, 5, 6, 9, 10, 10, 14, 20, 35, 50, 100, 300]:
        base = rng.choices(vocabulary, k=n)
        texts.append(base)
        for share in (0.05, 0.1, 0.15, 0.2, 0.25):
            line = list(base)
            for at in sorted(rng.sample(range(n), int(n * share)), reverse=True):
                change = rng.randrange(3)
                line[at : at + 1] = [[], [rng.choice(vocabulary)], [line[at], rng.choice(vocabulary)]][change]
            texts.append(line)
    texts = [list(t) for t in sorted({tuple(t) for t in texts})]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    pairs = []
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            longest = max(len(a), len(b))
            if min(len(a), len(b)) >= 0.8 * longest and longest - plain_distance(a, b) >= 0.8 * longest:
                pairs.append((j, i))
    root = groups(len(texts), pairs)
    expected = [(i, t if i == r else "") for (i, t), r in zip(docs, root)]
    assert sum(i != r for i, r in enumerate(root)) > 30
    found = lines.dedup(documents(spark, docs), exact=True)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == expected


def test_recall_of_similar_lines(spark):
    """Of the similar lines that the complete search removes, blocks find nine in ten or more."""
    table = queries.table(spark, SF, "documents")
    exact = lines.report(table, exact=True).agg({"n_removed": "sum"}).first()[0]
    found = lines.report(table).agg({"n_removed": "sum"}).first()[0]
    assert 0.9 * exact <= found <= exact
    forms = list({form(line) for d in read("documents") for line in d["text"].split("\n")} - {()})
    reach, linked, met = set(in_reach(forms)), 0, 0
    for i, a in enumerate(forms):
        for j in range(i + 1, len(forms)):
            b = forms[j]
            longest, shortest = max(len(a), len(b)), min(len(a), len(b))
            if shortest < 0.8 * longest or len(set(a) & set(b)) < 0.4 * len(set(a)):
                continue
            if longest - lineforms.edit_distance(list(a), list(b)) >= 0.8 * longest:
                linked, met = linked + 1, met + ((i, j) in reach)
    assert linked and met >= 0.9 * linked


def test_dealt_blocks_give_the_same_groups(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for k in range(40):
        line = list(base)
        line[rng.randrange(60)] = f"other{k}"
        texts.append(" ".join(line))
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(90, "one two three four five six")])
    roots = [{tuple(r) for r in connect(lines.links(docs, tile=tile)).collect()} for tile in (3, lines.TILE)]
    assert roots[0] == roots[1] and len(roots[0]) == 39
    assert lines.links(docs).count() >= 39


def test_very_long_lines(spark):
    rng = random.Random(2)
    line = [f"w{rng.randrange(5000)}" for _ in range(30000)]
    near = [w if i % 100 else "changed" for i, w in enumerate(line)]
    other = [f"v{rng.randrange(5000)}" for _ in range(30000)]
    docs = [(1, " ".join(line)), (2, " ".join(near) + "\nshort one"), (3, " ".join(other)), (4, "short one")]
    got = {r.doc_id: r.text for r in lines.dedup(documents(spark, docs)).collect()}
    assert got == {1: docs[0][1], 2: "short one", 3: docs[2][1], 4: ""}


class Shared:
    def __init__(self, value):
        self.value = value


def test_fingerprints_travel_packed_and_meet_all_partners():
    """Many fingerprints share a row, in dealt blocks too, and all pairs in reach are met."""
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2**63, (3000, 4), dtype=np.uint64)
    prints[1000:2000] = prints[:1000] ^ (np.uint64(1) << rng.integers(0, 64, (1000, 4), dtype=np.uint64))
    prints[:40] = prints[0]  # a block with several groups
    prints[:40, 3] ^= np.arange(40, dtype=np.uint64)
    size = np.full(len(prints), 9, np.int32)
    size[2500] = 1 << 20  # more than a record holds
    prints[2501], size[2501] = prints[2500] ^ np.uint64(1), 1 << 20
    counts = np.bincount(lines._blocks(prints).ravel(), minlength=lines.BLOCKS << lines.BLOCK_BITS)
    tiles = Shared(np.maximum(1, -(-counts // 8)).astype(np.int32))
    batch = pa.RecordBatch.from_arrays([pa.array(size), *(lines.signed(x) for x in prints.T.copy())], ["size", *lines.LANES])
    for low in (16, 12, 7):
        rows = pa.Table.from_batches(lines._packed(tiles, low)(iter([batch]))).sort_by("key")
        n_tiled = sum(k >= 0 for k in rows.column("key").to_pylist())
        assert rows.num_rows - n_tiled <= 16 << 16 - low and n_tiled
        batches = rows.to_batches(max_chunksize=50)
        found = {}
        for part in lines._partners(lines.DISTANCE, 0.8, tiles, low)(iter(batches)):
            for s0, bits in zip(*(c.to_pylist() for c in part.columns)):
                found[s0] = found.get(s0, 0) | bits
        expected = {}
        blocks = lines._blocks(prints)
        for i, j in close_pairs(prints[:, 0], 64):
            same = np.flatnonzero(blocks[i] == blocks[j])
            if len(same) and 0.8 * max(size[i], size[j]) <= min(size[i], size[j]):
                if np.bitwise_count(prints[i] ^ prints[j]).sum() <= lines.DISTANCE:
                    for k in (i, j):
                        s0 = int(prints[k, 0].view(np.int64))
                        expected[s0] = expected.get(s0, 0) | 1 << int(same[0])
        assert found == expected and len(found) > 1500


def test_words_of_wanted_lines_are_read_from_their_lines():
    texts = ["One two three\n\n-- --\nFour five\r\nsix", None, "", "Four five", "ä ß\n" + "x " * 40]
    hashes = [7, 42, 1 << 62, -5, 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(hashes, pa.int64())], ["text", "text_hash"])

    class Some:
        def has(self, at):
            where = [(hashes[0], 0), (hashes[0], 3), (hashes[0], 2), (hashes[4], 1)]
            return np.isin(at, np.array([h ^ p << lineforms.PLACE_BIT for h, p in where]).view(np.uint64))

    class Every:
        def has(self, hashes):
            return np.ones(len(hashes), bool)

    rows = [tuple(map(tuple, (r["words"],))) + (r["a"], r["b"]) for b in lineforms.wanted_lines(Some())(iter([batch])) for r in b.to_pylist()]
    every = [tuple(map(tuple, (r["words"],))) + (r["a"], r["b"]) for b in lineforms.wanted_forms(Every())(iter([batch])) for r in b.to_pylist()]
    assert len(rows) == 3 and set(rows) < set(every)
    assert sorted(len(r[0]) for r in rows) == [2, 3, 40]


def test_linked_forms_that_share_a_number_stay_apart(spark):
    """Groups are connected by one number a form, unless two linked forms share it."""
    pair = "x struct<a:long,b:long>, y struct<a:long,b:long>"
    chain = [((1, 10), (2, 20)), ((2, 20), (3, 30)), ((7, 70), (8, 80))]
    for links, n in ((chain, 2), ([*chain, ((3, 31), (9, 90))], 3), ([], 0)):
        found = lines._grouped(spark.createDataFrame(links, pair)).collect()
        assert sorted((r.a, r.b) for r in found) == sorted({f for link in links for f in link})
        root = {(r.a, r.b): r.root for r in found}
        assert all(root[x] == root[y] for x, y in links) and len(set(root.values())) == n


def test_most_similar_lines_need_no_edit_distance(monkeypatch):
    """A greedy alignment, never below the edit distance, is enough for scattered edits."""
    rng = random.Random(7)
    base = list(range(100))
    near = []
    for _ in range(20):
        line = list(base)
        for at in sorted(rng.sample(range(2, 98, 4), 15), reverse=True):
            line[at : at + 1] = [[], [1000 + at], [line[at], 2000 + at]][rng.randrange(3)]
        near.append(line)
        assert plain_distance(base, line) <= lineforms.aligned(base, line, 100) <= 20
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 15))] for _ in "ab")
        assert lineforms.aligned(a, b, 100) >= plain_distance(a, b)
    monkeypatch.setattr(lineforms, "edit_distance", None)
    assert all(lineforms.similar(base, line, 0.8) for line in near)


def test_simhashes_count_long_lines_and_salts():
    rng = np.random.default_rng(8)
    n = np.array([1, 2, 5, 254, 255, 256, 700, 5000, 3, 4096, 1])
    hashes, end = rng.integers(0, 2**64, int(n.sum()), dtype=np.uint64), np.cumsum(n)
    salts = rng.integers(0, 2**64, 3, dtype=np.uint64)

    def plain(words):
        return sum(1 << b for b in range(64) if 2 * sum(int(w) >> b & 1 for w in words) > len(words))

    found = lineforms.simhashes(hashes, end - n, end, salts)
    lone = lineforms.simhashes(hashes, end - n, end)
    for i, (j, k) in enumerate(zip(end - n, end)):
        assert int(lone[i]) == plain(hashes[j:k])
        assert [int(x) for x in found[i]] == [plain(lines.mix(hashes[j:k] ^ s)) for s in salts]


def test_counts_of_blocks_travel_in_few_rows():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**64, (2000, 4), dtype=np.uint64)
    prints[:30] = prints[0]
    batch = pa.RecordBatch.from_arrays([lines.signed(x) for x in prints.T.copy()], list(lines.LANES))
    rows = [r for half in (batch.slice(0, 900), batch.slice(900)) for r in lines._counts(iter([half]))]
    assert len(rows) <= 2 * (lines.BLOCKS << lines.BLOCK_BITS) // lines.PART
    counts = np.bincount(lines._blocks(prints).ravel())
    for tile in (3, 29, 30):
        found = {b: n for r in lines._crowded(tile)(iter(rows)) for b, n in zip(*(c.to_pylist() for c in r.columns))}
        assert found == {int(b): int(counts[b]) for b in np.flatnonzero(counts > tile)}


def test_forms_are_named_once_with_a_line_of_theirs(spark):
    docs = documents(spark, [(1, "one two three four five\nx"), (2, "x\none two three four five"), (3, "x\nx"), (4, None)])
    found = lines.forms(lines.occurrences(docs)).collect()
    assert sorted((r.times, r.size, r.s0 is None) for r in found) == [(2, 5, False), (4, 1, True)]
    places = lines.occurrences(docs).select("a", lineforms.line_at("text_hash", "place").alias("at")).collect()
    assert {(r.a, r["at"]) for r in found} <= {(r.a, r["at"]) for r in places}
