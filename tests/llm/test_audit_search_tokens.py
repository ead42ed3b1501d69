"""The filter audit, ranked search and token counts against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from compare import differences
from helpers import BLANKS, LOWER, SF, collected, documents, read
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyroute.llm import audit, queries, search, sql, tokens

VOCABULARY = tokens.default_vocabulary()


def duck_of(spark, **tables):
    """DuckDB views of small Spark tables."""
    import duckdb

    con = duckdb.connect()
    for name, df in tables.items():
        frame = df.toArrow()
        con.register(name, frame)
    return con


# The audit


def plain_audit(rows, labels):
    """Each order, filter by filter over all documents."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = BLANKS.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and first[text] < doc_id,
        }
        own = [(q, t) for d, q, t in labels if d == doc_id and doc_id is not None]
        good = max((q for q, _ in own if q is not None), default=0) == 1
        toxic = max((t for _, t in own if t is not None), default=0) == 1
        docs.append((lang or "", fails, good, toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, shares, rows_of = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if d[1][f]], [d for d in left if not d[1][f]]
                shares[f] += len(gone)
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                earlier = sum(d[1][f] for d in own) - len(gone)
                lost = (sum(d[2] for d in gone), sum(d[3] for d in gone))
                rows_of.append((part, "".join(order), step, len(left), len(gone), earlier, alone, *lost, f))
        out += [(*r[:-1], shares[r[-1]]) for r in rows_of]
    return out


def audit_case(spark):
    rng, long = random.Random(5), " ".join(f"w{i}" for i in range(220))
    texts = [None, "", "a b", long, long.upper(), long + " #", "ab " * 300, "AB$ " * 400, "Ü" * 50, "long word " * 40_000]
    rows = [(None if i % 11 == 0 else i % 60, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(50)]
    docs = spark.createDataFrame([(d, t, p, "x", "x", 1) for d, t, p in rows],
        "doc_id long, text string, lang string, part string, body string, mask int")
    marks = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, good string")
    return rows, labels, docs, marks


def test_audit_equals_every_order(spark):
    rows, labels, docs, marks = audit_case(spark)
    found = collected(audit.audit(docs, marks))
    assert found == collected_rows(plain_audit(rows, labels))
    assert differences(audit.audit(docs, marks), duck_of(spark, documents=docs, labels=marks), sql.filter_audit_sql()) is None


def collected_rows(rows):
    import collections

    return collections.Counter(rows)


def test_audit_without_rows_or_labels(spark):
    _, _, docs, marks = audit_case(spark)
    assert audit.audit(docs.limit(0), marks).count() == 0
    bare = audit.audit(docs, marks.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(bare) == (0, 0)
    one = docs.filter("doc_id = 1").limit(1)
    assert audit.audit(one, marks).count() == 600


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=32))
def test_gray_walk_meets_every_subset(cells):
    states = audit.gray_walk([(mask, *counts) for mask, counts in cells.items()])
    for kind, state in enumerate(states):
        for subset in range(32):
            assert state[subset] == sum(c[kind] for mask, c in cells.items() if not mask & subset)


def test_copies_of_one_text_meet_as_few_rows(spark):
    """A hot text is summed up before the one window over its rows."""
    rows = [(i, "the same", "en" if i % 2 else "de", None, None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(0, 3000, 3)], "doc_id long, quality int, toxic int")
    found = {(r.part, r.mask): (r.n, r.good) for r in audit.cells(docs, marks).collect()}
    assert found == {("de", 1): (1, 1), ("de", 17): (1499, 499), ("en", 1): (0, 0), ("en", 17): (1500, 500)}


# Ranked search


def terms_of(text):
    import re

    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    own = [(d, terms_of(t)) for d, t in docs]
    some = [(d, t) for d, t in own if t]
    n_docs, length = len(some), sum(len(t) for _, t in some)
    frequency = {}
    for _, t in some:
        for term in set(t):
            frequency[term] = frequency.get(term, 0) + 1
    out = []
    for item_id, text in {(i, t or "") for i, t in items}:
        scored = []
        for doc_id, t in some:
            m, score = 25 + 75 * len(t) * n_docs // length, 0
            for term in terms_of(text):
                if tf := t.count(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item_id, i, d, -s) for i, (s, _, d) in enumerate(scored[:k], 1)]
    return out


def search_case(spark):
    rng, words = random.Random(9), "the of Alpha beta gamma d3 é日 x9 rare one".split()
    docs = [(i % 70, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(120)]
    docs += [(None, "alpha beta"), (None, "Alpha, beta"), (500, None), (501, ""), (502, "--- !"), (503, "of " * 60_000)]
    docs += [(600 + i, "gamma delta") for i in range(40)]  # ties
    items = [(i, " ".join(rng.choices([*words, "nowhere"], k=rng.randint(1, 12)))) for i in range(30)]
    items += [(30, None), (31, ""), (None, "gamma"), (0, "gamma gamma delta"), (32, "nowhere at all"), items[3]]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    return docs, items, documents(spark, docs, ("rank", "item", "salt")), table


def test_search_equals_brute_force(spark):
    docs, items, table, wanted = search_case(spark)
    plain = collected_rows(plain_search(docs, items))
    assert collected(search.search(table, wanted)) == plain
    assert collected(search.search(table.repartition(7), wanted, entries=40)) == plain  # many blocks of items
    few = collected_rows(plain_search(docs, items, 3))
    assert collected(search.search(table, wanted, k=3)) == few
    con = duck_of(spark, documents=table, benchmark=wanted)
    assert differences(search.search(table, wanted), con, sql.RANKED_SEARCH) is None


def test_search_without_rows(spark):
    _, _, table, wanted = search_case(spark)
    for docs, items in ((table.limit(0), wanted), (table, wanted.limit(0)), (table.filter("text = ''"), wanted)):
        found = search.search(docs, items)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        search.search(table, wanted, k=0)


def test_heaps_hold_the_best(spark):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (500, 3)), rng.permutation(500)
    heaps = search.Heaps(3, 10)
    for i in range(0, 500, 37):
        heaps.update(pa.array(ids[i : i + 37]), scores[i : i + 37])
    for item, best in enumerate(heaps.best):
        plain = sorted((-s, d) for s, d in zip(scores[:, item].tolist(), ids.tolist()) if s)[:10]
        assert [(s, d) for s, _, d in best] == plain


def test_search_scans_documents_without_a_shuffle_of_texts(spark):
    _, _, table, wanted = search_case(spark)
    plan = search.search(table, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)


# Token counts


@pytest.fixture(scope="module")
def library():
    whole = Tokenizer.from_file(VOCABULARY)
    return lambda text: len(whole.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return tokens.PrefixCounter(VOCABULARY)


PARTS = [*"abctheRE  \n\t\r'sdl.!,12²éß日🙂\x85 　\x1c½ḁ#-", "<|endoftext|>", "<|endo", " the", "ing", "'re", "'ll", "aaaa", "\r\n", "  "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=20))
def test_every_prefix_equals_the_library(counter, library, parts):
    text = "".join(parts)
    assert np.cumsum(counter.steps(text), dtype=np.int64).tolist() == [library(text[:i]) for i in range(1, len(text) + 1)]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=12))
def test_any_text_equals_the_library(counter, library, text):
    assert np.cumsum(counter.steps(text), dtype=np.int64).tolist() == [library(text[:i]) for i in range(1, len(text) + 1)]


def test_documents_equal_the_library(spark, library):
    docs = read("documents")
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op13_prefix_token_counts"](spark, SF).collect()}
    assert found == {
        d["doc_id"]: (len(d["text"].encode()), n := library(d["text"]), n > 1024) for d in docs
    }


def test_stored_prefixes_answer_budgets(spark, library):
    text = "The  quick\n\n brown fox's 1234 jumps.\n" * 30 + "<|endoftext|>é日"
    long = "ab!cd" * 20_000
    cases = [(1, text), (1, text), (2, None), (None, ""), (3, long)]
    counted = tokens.prefix_counts(documents(spark, cases, ("steps", "width", "n_tokens")), VOCABULARY)
    asked = counted.select(
        "doc_id", "n_bytes", "n_chars", "n_tokens", tokens.tokens_at(77).alias("at"), tokens.chars_within(40).alias("fit"), tokens.chars_within(10**9).alias("all")
    )
    rows = asked.collect()
    assert len(rows) == 5
    for row in rows:
        own = {1: text, 2: "", None: "", 3: long}[row.doc_id]
        assert (row.n_bytes, row.n_chars, row["all"]) == (len(own.encode()), len(own), len(own))
        assert (row.n_tokens, row["at"]) == (library(own), library(own[:77]))
        assert library(own[: row.fit]) <= 40
        assert all(library(own[:i]) > 40 for i in range(row.fit + 1, min(row.fit + 60, len(own)) + 1))
    assert tokens.prefix_counts(documents(spark, cases).limit(0), VOCABULARY).count() == 0


def test_wide_steps(counter, monkeypatch, library):
    """Steps that don't fit a byte make the whole text's wider."""
    text = "some words here"
    own = tokens.PrefixCounter(VOCABULARY)
    own[" words"] = None
    steps = own.steps(text)
    assert steps.dtype == np.int32 and steps.tolist() == counter.steps(text).tolist()


def test_other_models_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        tokens.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))
