"""The line classifier on held-out labels, and the pipeline against its plain parts."""

import zlib

import numpy as np
import pytest
from helpers import SF, collected, documents, low, read
from pyspark.sql import functions as F

import corpus_pipeline
from skyroute.functions.scratch import write_table
from skyroute.llm import crf, packing, queries
from test_near_duplicates import plain_fingerprint, plain_lines
from helpers import close_pairs, groups
from test_text_queries import shingles

GOOD = "This is a quiet line about gardens.\nAnother line, with some words in it.\nThe end of it."
BAD = "BUY!! NOW!! CHEAP!!\nCLICK!! HERE!!\nWIN!! WIN!! WIN!!"


@pytest.fixture(scope="module")
def trained(spark):
    texts = [(i, GOOD.replace("line", f"line {i}") if i % 3 else BAD.replace("NOW", f"NOW{i}")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    return documents(spark, texts), labels


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(4)
    doc = np.repeat([0, 1, 2], [3, 1, 5])
    scores, change = rng.normal(size=9), rng.normal(size=(2, 2))
    got, pairs, log_z = crf._Chains(doc).marginals(scores, change)
    expected, total_pairs, total = np.zeros(9), np.zeros((2, 2)), 0.0
    for d in range(3):
        at = np.flatnonzero(doc == d)
        z, marg, own = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for path in np.ndindex(*[2] * len(at)):
            value = sum(scores[i] for i, y in zip(at, path) if y) + sum(change[a, b] for a, b in zip(path, path[1:]))
            z += np.exp(value)
            marg += np.exp(value) * np.array(path)
            for a, b in zip(path, path[1:]):
                own[a, b] += np.exp(value)
        expected[at], total = marg / z, total + np.log(z)
        total_pairs += own / z
    assert np.allclose(got, expected) and np.allclose(pairs, total_pairs) and np.isclose(log_z, total)


def test_held_out_accuracy(spark):
    """On the labels of the smallest table that the rule holds out and on the others."""
    scored = {r.doc_id: r for r in queries.line_crf(spark, "/root/testdata/sf0.01").collect()}
    import pyarrow.parquet as pq

    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    right = [scored[x["doc_id"]].predicted == x["quality"] for x in labels if scored[x["doc_id"]].held_out]
    assert len(right) > 40 and np.mean(right) > 0.93
    for d, r in scored.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.3)


def test_cases(spark, trained):
    docs, labels = trained
    model = crf.fit(docs, labels)
    odd = [(1, GOOD), (2, BAD), (3, None), (4, ""), (5, " \n\t\n"), (1, GOOD), (None, GOOD), (6, (GOOD + "\n") * 3000), (7, "x" * 200_000)]
    scores = {r.row.doc_id: r.score for r in crf.score(documents(spark, odd), model).collect()}
    assert scores[1] > 0.9 and scores[2] < 0.1 and scores[None] == scores[1] and scores[6] > 0.9
    assert scores[3] == scores[4] == scores[5] == 0 and 0 <= scores[7] <= 1
    kept = crf.keep_good(documents(spark, odd), labels)
    assert kept.columns == docs.columns
    repeated = labels.unionAll(labels).unionAll(spark.createDataFrame([(999, None, None), (None, 1, 0)], labels.schema))
    again = crf.fit(docs.select(F.lit("xx").alias("lang"), "text", "doc_id"), repeated)
    assert np.allclose(again.weights, model.weights)
    assert crf.score(docs.limit(0), model).collect() == []


def test_without_labels(spark, trained):
    docs, labels = trained
    scores = lambda m: {round(r.score, 6) for r in crf.score(docs, m).collect()}
    assert scores(crf.fit(docs, labels.limit(0))) == {1.0}
    assert scores(crf.fit(docs, labels.filter("quality = 0"))) == {0.0}
    assert scores(crf.fit(docs.limit(0), labels)) != {1.0}


def test_repeated_ids_train_once(spark):
    good, bad = "One clean line of plain words here.\nAnother line.", "$$ 9 !!\n>> | 88 ##"
    ids = [i for i, held in spark.range(60).select("id", crf.held_out("id")).collect() if not held][:20]
    rows = [(i, f"{good if n % 2 else bad} {i}") for n, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    once = crf.fit(documents(spark, rows), labels)
    often = crf.fit(documents(spark, rows + rows[:1] * 200), labels)
    for a, b in zip(once, often):
        assert np.array_equal(a, b)


def test_stages_on_their_own_input(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = queries.table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = write_table(stage(spark, before, SF))
        kept[name] = (before, docs)
        if name != names[-1]:
            assert docs.schema == before.schema
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    before, after = kept["quality_classifier"]
    scored = {r.doc_id: r.predicted for r in queries.line_crf(spark, SF).collect()}
    assert rows(after) == [x for x in rows(before) if scored[x[0]]]

    before, after = kept["line_dedup"]
    gone = plain_lines(rows(before))
    assert rows(after) == sorted(
        ((d, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((True, d), ()))) for d, t in rows(before)), key=str)

    before, after = kept["simhash_near_dedup"]
    texts = sorted(rows(before))
    root = groups(len(texts), close_pairs([plain_fingerprint(t) for _, t in texts], 3))
    assert rows(after) == sorted((x for i, x in enumerate(texts) if root[i] == i), key=str)

    before, after = kept["benchmark_decontamination"]
    items = [s for x in read("benchmark") if (s := shingles(x["text"]))]
    clean = [x for x in rows(before) if not any(5 * len(s & shingles(x[1])) >= 4 * len(s) for s in items)]
    assert rows(after) == clean

    before, after = kept["packing"]
    encoder = packing.WordEncoder(packing.default_vocabulary())
    ids = {}
    for r in sorted(after.collect(), key=lambda r: r.start):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    assert ids == {d: [*np.frombuffer(encoder.encode(t), "<u4").tolist(), 2] for d, t in rows(before)}

    run = corpus_pipeline.run(spark, SF).drop("sequence_id")
    assert collected(run.select("doc_id", "start", "ids_crc32")) == collected(after.select("doc_id", "start", "ids_crc32"))
    assert low("Ä A") == "Ä a"
