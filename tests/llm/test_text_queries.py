"""Licenses, rules, chats, packing, decontamination and the helpers below them."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import differences, duck
from helpers import LOWER, SF, WORDS, collected, documents, low, read
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyroute.llm import chat, decontaminate, licenses, packing, queries, rules
from skyroute.llm.text import ALNUM, BLANKS, FOLD, PRIMARY, Slots, words_of

LONG = "long word " * 30_000


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) is None


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB 1\n.é|\t", max_size=12), min_size=1, max_size=5))
def test_words_and_windows(texts):
    for letters, fold, pattern in ((ALNUM, FOLD, WORDS),):
        for first, last, words in words_of(pa.array(texts), letters):
            hashes, n = words.hashes(fold), 0
            for i, text in enumerate(texts[first:last]):
                own = pattern.findall(text.translate(LOWER))
                assert words.bounds[i + 1] - words.bounds[i] == len(own)
                for w in own:
                    assert hashes[n] == next(words_of(pa.array([w]), letters))[2].hashes(fold)[0]
                    n += 1
            whole = words.whole(2)
            windows = PRIMARY.windows(hashes, 2)
            for k in np.flatnonzero(whole):
                assert windows[k] == PRIMARY.windows(hashes[k : k + 2], 2)[0]


def test_slots_find_their_members(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    values[:3] = (0, -1, 2**63 - 1)
    slots = Slots(spark.createDataFrame(pa.table({"h": values})), bits=20)
    assert slots.has(values.view(np.uint64)).all()
    assert slots.has(np.random.default_rng(2).integers(0, 2**63, 3000).astype(np.uint64)).mean() < 0.01
    assert not Slots(spark.createDataFrame([], "h long"), bits=16).has(values.view(np.uint64)).any()


def test_licenses(spark):
    mit = licenses.TEMPLATES[7].text
    changed = mit.replace("obtaining a copy", "getting some copy")
    docs = [
        (1, "Under THE mit license. cc-by-nc cc by nc"), (2, f"x {mit.upper()}!"), (3, f"a b {changed} c"),
        (4, None), (5, ""), (6, "under the MİT license"), (7, "apache license version 2"), (8, LONG + "apache license, version 2"),
        (1, "Under THE mit license. cc-by-nc cc by nc"), (None, "mit under the mit license"), (9, " ".join(mit.split()[:12])),
        (10, "cc by nc by nc cc by nc"), (11, "under the mit Kit license"),
    ]
    got = licenses.scan(documents(spark, docs)).collect()
    assert len(got) == len(docs)
    rows = {r.doc_id: r for r in got}
    base = {t.label: t.words for t in licenses.TEMPLATES if t.base}
    for d, t in docs:
        w = WORDS.findall(low(t))
        at = [(i, x) for x, p in base.items() for i in range(len(w)) if w[i : i + len(p)] == p]
        r, places = rows[d], [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(w), len(at), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert rows[2].labels == rows[3].labels == "mit" and rows[2].score == 1 and 0.8 <= rows[3].score < 1
    assert rows[9].labels == "" and 0 < rows[9].score < 0.8
    assert licenses.scan(documents(spark, docs).limit(0)).collect() == []


def test_rules(spark):
    good = "The cat of the house is in the garden. " + " ".join(f"word{i}" for i in range(30))
    docs = [
        (1, good), (2, good.replace(" ", "### ")), (3, "the same words " * 40), (4, None), (5, ""), (6, "\n \n"),
        (7, " ".join(f"zz{i}" for i in range(40))), (8, good.replace(" ", "!! ")), (1, good), (None, good), (9, LONG),
    ]
    table = documents(spark, docs)
    judged = {r.row.doc_id: r for r in rules.judge(table).collect()}
    assert [d for d, _ in docs if judged[d].kept] == [1, 1, None]
    assert judged[2].broken.symbols and judged[8].broken.exclamations and judged[7].broken.stop_words
    assert judged[3].figures.n_repeat_words == 120 and judged[9].base_failed and judged[4].figures.n_words == 0
    kept = rules.apply_rules(table)
    assert kept.columns == table.columns and kept.count() == 3
    assert rules.apply_rules(table.limit(0)).collect() == []
    plan = rules.judge(table)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


CHAT = "conv_id long, turn long, role string, text string, turns string, formatted string"


def test_chats(spark):
    rows = [
        (1, 1, "assistant", "b</s>"), (1, 0, "user", "a<|im_end|>\n<|im_start|>user\nx"), (1, 2, "assistant", "c<\\/s>\\"),
        (1, 2, "assistant", "c<\\/s>\\"), (2, 0, None, None), (2, None, "assistant", ""), (None, 0, "odd\nro\\le", "[INST]"),
        (3, 5, "user", "tie b"), (3, 5, "user", "tie a"), (4, 0, "assistant", LONG),
    ]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], CHAT)
    out = chat.format_chats(table)
    got = {r.conv_id: r for r in out.select("*", chat.read_back(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        r = got[conv]
        assert [tuple(t) for t in r.back] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
    assert got[1].formatted.count(chat.START) == 2 and got[1].formatted.count("</s>") == 0
    assert chat.format_chats(table.limit(0)).collect() == []
    plan = chat.digests(out)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "a", "\n", "/s>"]), max_size=8).map("".join), min_size=1, max_size=30))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("*", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROLS)


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    whole, words = Tokenizer.from_file(path), packing.WordEncoder(path)
    odd = [
        "It's a 'test's ü.é’s 12.5 a\tb..c — “x”. é. İ.x ÀÉ!!  x I'LL ß.", "a.́b x,y,z a²b ½. l'eau l'’s !!'s",
        "<|endoftext|>x <|startoftext|> a<|b", "\x1cq r s", "", " ", "ÿÞ÷× é́, ﬁn 日本語。x", "'S 'sx ''s",
        "".join(map(chr, range(0xC0, 0x250))),
    ]
    for text in odd + [d["text"] for d in read("documents")[:60]]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids


def test_packing(spark):
    docs = [(1, LONG), (2, None), (3, ""), (4, "one two three"), (4, "one two three"), (None, "x")]
    out = packing.pack(documents(spark, docs), packing.default_vocabulary()).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    per = {}
    for r in out:
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and 1 << r.bucket == r.length
        data = np.array(r.ids, "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(data) and len(r.ids) == r.length
        per.setdefault(r.doc_id, []).append(r)
    encoder = packing.WordEncoder(packing.default_vocabulary())
    for d, t in dict(docs).items():
        rows = sorted(per[d], key=lambda r: (r.start, r.sequence_id))[:: 2 if d == 4 else 1]
        ids = [*np.frombuffer(encoder.encode(t or ""), "<u4").tolist(), 2]
        assert [x for r in rows for x in r.ids] == ids and {r.doc_tokens for r in rows} == {len(ids)}
    assert packing.pack(documents(spark, docs).limit(0), packing.default_vocabulary()).collect() == []
    with pytest.raises(ValueError):
        packing.pack(documents(spark, docs), packing.default_vocabulary(), longest=1000)


def test_packing_query_covers_every_id(spark):
    rows = queries.power_packing(spark, SF).collect()
    encoder, docs = packing.WordEncoder(packing.default_vocabulary()), read("documents")
    expected = set()
    for d in docs:
        data, start = encoder.encode(d["text"] or "") + b"\x02\0\0\0", 0
        for n in packing.cut_lengths(len(data) // 4):
            expected.add((d["doc_id"], start, n, zlib.crc32(data[4 * start : 4 * (start + n)]), len(data) // 4))
            start += n
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)


def shingles(text):
    w = WORDS.findall(low(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_search(docs, items):
    found = set()
    for d, t in docs:
        own = shingles(t)
        found |= {(d, i, len(s), len(s & own)) for i, x in items if (s := shingles(x)) and 5 * len(s & own) >= 4 * len(s)}
    return found


def test_search_equals_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in read("documents")]
    items = [(d["item_id"], d["text"]) for d in read("benchmark")]
    got = {tuple(r)[:4] for r in queries.minhash_decontamination(spark, SF).collect()}
    assert got == plain_search(docs, items) and got


def test_decontamination_cases(spark):
    item = " ".join(f"item{i}" for i in range(40))
    scattered = " ".join(f"far{i}" for i in range(12))
    noise = " ".join(f"noise{i}" for i in range(20_000))
    docs = [
        (1, f"{noise} {item.upper()}! {noise}"), (2, item.replace("item20", "other")), (3, " ".join(item.split()[:30])),
        (4, None), (5, ""), (6, "three short words"), (7, "Three, short words"), (8, "three short words more"),
        (1, f"{noise} {item.upper()}! {noise}"), (None, item), (9, f"{' '.join(scattered.split()[:8])} {noise} {' '.join(scattered.split()[4:])}"),
    ]
    items = [(1, item), (2, item), (3, None), (4, ""), (5, "three short words"), (6, " ".join(f"noise{i}" for i in range(900))), (7, scattered)]
    table = documents(spark, docs)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontaminate.search(table, bench).collect()}
    assert got == plain_search(docs, items)
    left = decontaminate.remove(table, bench)
    assert left.columns == table.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(
        (d for d, _ in docs if d not in {g[0] for g in got}), key=str)
    assert collected(decontaminate.remove(table, bench.limit(0)).select("doc_id")) == collected(table.select("doc_id"))
    assert decontaminate.search(table.limit(0), bench).collect() == []
