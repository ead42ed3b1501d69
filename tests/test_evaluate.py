import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from goldens import rows
from skyroute.functions.scratch import write_table
from skyroute.operators import evaluate


def tallied(spark, triples):
    return evaluate.tally(spark.createDataFrame(triples, "label DOUBLE, prediction DOUBLE, score DOUBLE"))


def test_class_that_is_never_predicted(spark):
    t = tallied(spark, [(0.0, 0.0, 0.1), (1.0, 0.0, 0.2), (0.0, 0.0, 0.3)])
    row = evaluate.class_metrics(t).first()
    assert row.precision == pytest.approx(1 / 3) and row.recall == 0.5
    assert row.fpr == 0.5 and row.f1 == pytest.approx(0.4)
    assert row.accuracy == pytest.approx(2 / 3)
    assert rows(evaluate.confusion_matrix(t)) == [(0.0, 0.0, 2), (1.0, 0.0, 1)]
    assert rows(evaluate.confusion_table(t)) == [(0.0, 2, 0), (1.0, 1, 0)]


def test_no_rows(spark):
    row = evaluate.class_metrics(tallied(spark, [])).first()
    assert (row.precision, row.recall, row.fpr, row.f1, row.accuracy) == (0, 0, 0, 0, 0)


def test_small_curve(spark):
    t = tallied(spark, [(1.0, 1.0, 0.9), (0.0, 1.0, 0.8), (1.0, 1.0, 0.7), (0.0, 0.0, 0.1)])
    points = evaluate.thresholds(t)
    area = evaluate.areas(points).first()
    assert area.auroc == 0.75 and area.auprc == pytest.approx(0.791667, abs=1e-6)
    roc = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(points).collect())
    assert roc == [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 1), (1, 1), (1, 1)]
    pr = [(r.recall, r.precision) for r in evaluate.pr_curve(points).collect() if r.threshold is None]
    assert pr == [(0.0, 1.0)]
    by = {r.threshold: r for r in evaluate.threshold_metrics(points).collect()}
    assert by[0.8].precision == 0.5 and by[0.8].recall == 0.5 and by[0.8].f1 == 0.5
    assert by[0.9].f05 == pytest.approx(1.25 * 0.5 / (0.25 + 0.5))


@pytest.fixture(scope="module")
def noisy(spark):
    draw = random.Random(11)
    rows = []
    for _ in range(6000):
        label = float(draw.random() < 0.3)
        score = 0.5 if draw.random() < 0.3 else round(0.3 * label + 0.7 * draw.random(), 4)
        rows.append((label, float(score > 0.5), score))
    return spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE, score DOUBLE").cache()


def test_areas_equal_the_ml_evaluator(noisy):
    area = evaluate.areas(evaluate.thresholds(evaluate.tally(noisy))).first()
    for metric, ours in (("areaUnderROC", area.auroc), ("areaUnderPR", area.auprc)):
        exact = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0)
        assert ours == pytest.approx(exact.evaluate(noisy), abs=1e-12)


def test_binned_curve_keeps_all_counts(noisy):
    tally = evaluate.tally(noisy)
    exact, binned = evaluate.thresholds(tally), evaluate.thresholds(tally, bins=100)
    assert exact.count() > 1000 and 100 <= binned.count() <= 200
    last = binned.orderBy("threshold").first()
    assert last.tp == last.all_positives and last.fp == last.all_negatives
    kept = {(r.threshold, r.tp, r.fp) for r in binned.collect()}
    assert kept <= {(r.threshold, r.tp, r.fp) for r in exact.collect()}


def test_sketched_bins_are_even_and_areas_close(spark):
    """Many scores, skewed, in more rows than the sketch holds."""
    wide = spark.range(60_000, numPartitions=7).select(
        F.when(F.rand(3) < 0.3 + F.col("id") / 200_000, 1.0).otherwise(0.0).alias("label"),
        F.lit(0.0).alias("prediction"), F.pow(F.col("id") / 60_000, 3).alias("score"),
    )
    tally = write_table(evaluate.tally(wide))
    bins = 200
    exact, binned = evaluate.thresholds(tally), evaluate.thresholds(tally, bins)
    sizes = [r.positives + r.negatives for r in binned.collect()]
    assert sum(sizes) == 60_000 and len(sizes) == bins
    most = 60_000 * (1 / bins + 2 * evaluate.SKETCH_ERROR)
    assert max(sizes) <= most
    one, other = evaluate.areas(exact).first(), evaluate.areas(binned).first()
    # Inside a bin the ROC curve is replaced by its chord: less than the bin's square.
    assert abs(one.auroc - other.auroc) <= bins * (2 * most / 60_000) ** 2
    assert abs(one.auprc - other.auprc) <= 0.02


def test_identities_for_two_classes(noisy):
    row = evaluate.class_metrics(evaluate.tally(noisy)).first()
    assert row.fpr == pytest.approx(1 - row.recall)
    assert row.balanced_accuracy == pytest.approx(row.recall)
    hard = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(noisy)
    assert row.balanced_accuracy == pytest.approx(hard)


def test_report_text(spark):
    t = tallied(spark, [(0.0, 0.0, 0.1), (1.0, 0.0, 0.2), (0.0, 0.0, 0.3)])
    report = {r.Name: r["Score%"] for r in evaluate.metrics_report(t).collect()}
    assert (report["Precision"], report["Recall"], report["FPR"], report["F1-Score"]) == (
        "33.33", "50.00", "50.00", "40.00",
    )
