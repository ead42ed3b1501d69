"""Recompression and the sparse suffix array against every window compared in plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import collected, documents, removed_words
from hypothesis import given, settings
from hypothesis import strategies as st

from skyroute.llm import recompress, repeats, suffixes
from skyroute.llm.text import words_of

OPERATORS = pytest.mark.parametrize("dedup", [recompress.dedup, suffixes.dedup])


def expected(docs):
    rows = []
    for d, w, gone in removed_words(docs):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        rows.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(rows, key=str)


def actual(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=str)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "é", "ñ"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, whole, hot = text(80), text(400), text(60)
    docs = [(i, f"{text(rng.randint(0, 90))} {hot}\n{text(30)}") for i in range(40)]
    docs += [(100 + i, f"{text(70)} {passage} {text(i)}") for i in range(5)]
    docs += [(200 + i, whole) for i in range(4)]
    docs += [(300, whole + " x"), (301, "y " + whole), (302, whole.replace(" the ", "\t\tof ", 1))]
    docs += [(400, " ".join(["a"] * 300)), (401, " ".join(["a"] * 170) + " b"), (402, " ".join("ab" * 100))]
    docs += [(403, "z " + " ".join("ab" * 60)), (404, " ".join(passage.split()[:49])), (405, " ".join(passage.split()[:50]))]
    docs += [(None, None), (500, None), (501, ""), (502, " \n\t "), (None, whole), (200, whole), (503, text(20_000))]
    docs += [(504, docs[-1][1][5000:9000]), (505, "one"), (506, "one")]
    return docs


@OPERATORS
def test_every_window(spark, dedup):
    docs = corpus()
    assert actual(dedup(documents(spark, docs))) == expected(docs)


@OPERATORS
def test_spans_and_small_bitmap(spark, dedup):
    docs = corpus()[40:60]
    plain = dedup(documents(spark, docs))
    tight = dedup(documents(spark, docs), slot_bits=16)
    assert {str(r) for r in plain.collect()} == {str(r) for r in tight.collect()}
    for r in plain.collect():
        assert sum(s.length for s in r.spans) == r.n_removed
        assert all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:]))


@OPERATORS
def test_empty_table(spark, dedup):
    assert dedup(documents(spark, [(1, "a")]).limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([2, 3, 30, 1000]), st.integers(0, 60), st.integers(0, 60))
def test_each_window_holds_a_shared_anchor(seed, letters, before, after):
    """Both methods choose some place in a window wherever it stands."""
    rng = random.Random(seed)
    word = lambda n: [f"w{rng.randrange(letters)}" for _ in range(n)]
    if rng.random() < 0.3:
        window = (word(rng.randint(1, 4)) * 50)[:50]
    else:
        window = word(50)
    found = []
    for i in range(2):
        texts = pa.array([" ".join(word(before * (1 - i)) + window + word(after * (1 - i))) or "", "other text"])
        at = before * (1 - i)
        for _, _, words in words_of(texts):
            hashes = words.hashes()
            names, starts, ends = recompress.anchors(words, hashes)
            inside = (starts >= at) & (ends <= at + 50)
            places, prefix = suffixes._prefixes(words, hashes)
            within = (places >= at) & (places + suffixes.PREFIX <= at + 50)
            found.append((set(names[inside].tolist()), set(prefix[within].tolist())))
    assert found[0][0] & found[1][0]
    assert found[0][1] & found[1][1]


def test_margins_add_up():
    assert recompress.MARGIN + recompress.LONGEST * recompress.INTERIOR + recompress.MARGIN <= repeats.WINDOW
    assert recompress.INTERIOR >= recompress.GROUP
    assert np.all(repeats.covering(10, np.array([60]), np.array([61])) == [False] * 10)


def test_extra_and_repeated_rows(spark):
    docs = [(1, "p " * 60), (2, "p " * 60), (2, "p " * 60)]
    rows = collected(recompress.dedup(documents(spark, docs)).select("doc_id", "n_removed"))
    assert rows == {(1, 0): 1, (2, 60): 2}
