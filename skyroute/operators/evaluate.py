"""Scores of a binary classifier as DataFrame aggregates.

Everything starts from a tally, (label, prediction, score, n): the scored rows are
counted once, with map-side combining, and all figures derive from the counts.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroute.functions.ordered import running_totals
from skyroute.functions.scratch import folder_bytes, new_folder, write_table

CLASSES = (0.0, 1.0)

# Fixed value: points a curve is reduced to, where the caller asks for it.
CURVE_BINS = 1000

# Of the sketch: its accuracy parameter, and the rank error that 99 % of its quantiles keep.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.0013


def tally(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label", "prediction", "score").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(tallied: DataFrame) -> DataFrame:
    """(label, prediction, n)."""
    return tallied.groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_table(tallied: DataFrame) -> DataFrame:
    """One row a label, one column a prediction; absent pairs count 0."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{int(c)}")
        for c in CLASSES
    ]
    return tallied.groupBy("label").agg(*counts)


def _ratio(over: Column, under: Column) -> Column:
    return F.coalesce(F.try_divide(over.cast("double"), under.cast("double")), F.lit(0.0))


def class_metrics(tallied: DataFrame) -> DataFrame:
    """One row: precision, recall, fpr and f1, each a macro average over both classes;
    accuracy; and balanced_accuracy, the ROC area of the 0/1 prediction."""
    n = F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    label, prediction = F.col("label"), F.col("prediction")
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias("all"), total(label == prediction).alias("right")]
    for c in CLASSES:
        k = int(c)
        sums += [
            total((label == c) & (prediction == c)).alias(f"tp{k}"),
            total(label == c).alias(f"actual{k}"),
            total(prediction == c).alias(f"predicted{k}"),
        ]
    row = tallied.agg(*sums)
    precision, recall, fpr, f1 = [], [], [], []
    for c in CLASSES:
        k = int(c)
        tp, actual, predicted = (F.col(f"{x}{k}") for x in ("tp", "actual", "predicted"))
        p, r = _ratio(tp, predicted), _ratio(tp, actual)
        precision.append(p)
        recall.append(r)
        fpr.append(_ratio(predicted - tp, F.col("all") - actual))
        f1.append(_ratio(2 * p * r, p + r))

    def macro(values: list[Column]) -> Column:
        return (values[0] + values[1]) / 2

    return row.select(
        macro(precision).alias("precision"),
        macro(recall).alias("recall"),
        macro(fpr).alias("fpr"),
        macro(f1).alias("f1"),
        _ratio(F.col("right"), F.col("all")).alias("accuracy"),
        ((1 + recall[1] - fpr[1]) / 2).alias("balanced_accuracy"),
    )


def _bounds(tallied: DataFrame, bins: int) -> list[float] | None:
    """Infinity and the bounds between bins; None where each score keeps its point."""
    sketch = F.kll_sketch_agg_double(F.col("score").cast("double"), F.lit(SKETCH_SIZE))
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    sketched = tallied.agg(sketch.alias("sketch"), F.count("score").alias("n"))
    row = sketched.select(
        "n", F.when(F.col("n") > 2 * bins, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("bounds")
    ).first()
    inner = sorted(set(row["bounds"] or ()))
    return [-math.inf, *inner, math.inf] if inner else None


def thresholds(tallied: DataFrame, bins: int = 0) -> DataFrame:
    """(threshold, positives, negatives, tp, fp, all_positives, all_negatives) a score.

    ``tp`` and ``fp`` count the rows that score the threshold or more. With ``bins`` and
    more than twice as many rows of the tally, the scores between two bounds share a
    point, named by the lowest of them. The bounds are quantiles of a mergeable sketch:
    each bin has its share of the tally's rows but for twice ``SKETCH_ERROR`` of all.
    """
    positive = F.sum(F.when(F.col("label") > 0.5, F.col("n")).otherwise(0)).alias("positives")
    negative = F.sum(F.when(F.col("label") > 0.5, 0).otherwise(F.col("n"))).alias("negatives")
    bounds = _bounds(tallied, bins) if bins else None
    if bounds:
        cut = Bucketizer(splits=bounds, inputCol="score", outputCol="bin", handleInvalid="keep")
        by_bin = cut.transform(tallied.withColumn("score", F.col("score").cast("double"))).groupBy("bin")
        by_score = by_bin.agg(F.min("score").alias("threshold"), positive, negative).drop("bin")
    else:
        by_score = tallied.groupBy(F.col("score").alias("threshold")).agg(positive, negative)
    spark = tallied.sparkSession
    folder = new_folder(spark)
    by_score = write_table(by_score, folder)
    points = running_totals(
        by_score, [F.col("threshold").desc()], {"tp": "positives", "fp": "negatives"}, folder_bytes(spark, folder)
    )
    whole = by_score.agg(
        F.coalesce(F.sum("positives"), F.lit(0)), F.coalesce(F.sum("negatives"), F.lit(0))
    ).first()
    return points.withColumn("all_positives", F.lit(whole[0])).withColumn(
        "all_negatives", F.lit(whole[1])
    )


def _precision() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return _ratio(F.col("tp"), F.col("all_positives"))


def _fpr() -> Column:
    return _ratio(F.col("fp"), F.col("all_negatives"))


def _f_measure(beta: float) -> Column:
    weight = beta * beta
    p, r = _precision(), _recall()
    return _ratio((1 + weight) * p * r, weight * p + r)


def areas(points: DataFrame) -> DataFrame:
    """One row: auroc and auprc by trapezoids.

    A point's predecessor is the point less its own counts, so no row looks at another.
    The first point of the precision-recall curve extends left at its own precision.
    """
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "positives", "negatives"))
    before = F.when(tp + fp == p + n, _precision()).otherwise(_ratio(tp - p, tp + fp - p - n))
    roc = n * (tp - p / 2)
    pr = p * (before + _precision()) / 2
    return points.agg(
        F.sum(roc).alias("roc"),
        F.sum(pr).alias("pr"),
        F.max("all_positives").alias("all_positives"),
        F.max("all_negatives").alias("all_negatives"),
    ).select(
        _ratio(F.col("roc"), F.col("all_positives") * F.col("all_negatives").cast("double")).alias("auroc"),
        _ratio(F.col("pr"), F.col("all_positives")).alias("auprc"),
    )


def roc_curve(points: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr), with the corners (0, 0) and (1, 1), which have no threshold."""
    curve = points.select("threshold", _fpr().alias("fpr"), _recall().alias("tpr"))
    corners = points.sparkSession.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], curve.schema)
    return curve.unionByName(corners)


def pr_curve(points: DataFrame) -> DataFrame:
    """(threshold, recall, precision), with the first point extended to recall 0."""
    curve = points.select("threshold", _recall().alias("recall"), _precision().alias("precision"))
    first = F.col("tp") + F.col("fp") == F.col("positives") + F.col("negatives")
    start = points.filter(first).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"),
        _precision().alias("precision"),
    )
    return curve.unionByName(start)


def threshold_metrics(points: DataFrame) -> DataFrame:
    """(threshold, precision, recall, f1, f05)."""
    return points.select(
        "threshold",
        _precision().alias("precision"),
        _recall().alias("recall"),
        _f_measure(1.0).alias("f1"),
        _f_measure(0.5).alias("f05"),
    )


def metrics_report(tallied: DataFrame, bins: int = 0) -> DataFrame:
    """(Name, Score%, score): the macro metrics, both areas and both accuracies."""
    macro = class_metrics(tallied).first()
    area = areas(thresholds(tallied, bins)).first()
    rows = [
        ("Precision", macro["precision"]),
        ("Recall", macro["recall"]),
        ("FPR", macro["fpr"]),
        ("F1-Score", macro["f1"]),
        ("areaUnderPR", area["auprc"]),
        ("areaUnderROC", area["auroc"]),
        ("BalancedAccuracy", macro["balanced_accuracy"]),
        ("Accuracy", macro["accuracy"]),
    ]
    report = tallied.sparkSession.createDataFrame(rows, "Name STRING, score DOUBLE")
    return report.select(
        "Name", F.format_string("%.2f", F.col("score") * 100).alias("Score%"), "score"
    )
