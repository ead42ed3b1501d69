"""The batch job: read flights, label, sample, train, write the reports.

    python -m skyroute FLIGHTS.csv OUT [--learner NAME] [--tune] [--skip-bad-delays] [--skip-missing]

Run it by spark-submit on a cluster. OUT gets the folders metrics, confusion, splits,
predictions, left_out and, where the learner has them, importances and grid, as CSV with
headers. left_out counts the lines that are malformed and the flights of the sample that
are not learned from. A missing number fails the job unless --skip-missing is given, as a
bad delay does without --skip-bad-delays.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.functions.scratch import scope, write_table
from skyroute.operators import learn, prep
from skyroute.sources import flights as source

REPORTS = ("metrics", "confusion", "splits", "predictions", "importances", "grid")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skyroute", description=__doc__.splitlines()[0])
    parser.add_argument("flights")
    parser.add_argument("out")
    parser.add_argument("--learner", default="Decision Tree", choices=sorted(learn.LEARNERS))
    parser.add_argument("--tune", action="store_true", help="cross-validate the learner's tuning grid")
    parser.add_argument("--skip-bad-delays", action="store_true", help="leave out negative and NaN delays")
    parser.add_argument("--skip-missing", action="store_true", help="leave out and count flights with missing numbers")
    return parser.parse_args(argv)


def left_out(read: DataFrame, labelled: DataFrame, sample: DataFrame) -> DataFrame:
    """(reason, n): lines and flights that are not, or not whole, among the learned ones."""
    lines = write_table(source.csv_report(read))
    bad = prep.rejected_delays(source.project(read))
    missing = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in prep.NUMERIC_COLUMNS]))
    counts = [
        lines.select(F.lit("malformed lines").alias("reason"), F.col("malformed").alias("n")),
        lines.select(F.lit("of these short lines"), "short_lines"),
        bad.select(F.lit("negative delays"), "negative"),
        bad.select(F.lit("delays that are no number"), "nan"),
        labelled.agg(F.count_if(F.col("label").isNull())).select(F.lit("flights without a delay"), "*"),
        sample.agg(missing).select(F.lit("sampled flights with missing numbers"), "*"),
    ]
    return reduce(DataFrame.union, counts)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    with scope(spark):  # the reports are written inside
        _run(spark, options)


def _run(spark: SparkSession, options: argparse.Namespace) -> None:
    read = source.read_csv(spark, options.flights, corrupt=True)
    rows = source.project(read)
    invalid = "skip" if options.skip_bad_delays else "error"
    labelled = write_table(prep.label_delays(rows, invalid))
    sample = prep.stratified_by_key(labelled, prep.content_key(labelled))
    whole = sample.na.drop(subset=[*prep.NUMERIC_COLUMNS]) if options.skip_missing else sample
    trained = learn.train(
        options.learner, whole, tune=options.tune,
        keys=[c for c in ("UniqueCarrier", "FlightNum", "TailNum") if c in rows.columns],
        # Another draw than the sample's.
        draw=F.xxhash64(F.lit("split"), prep.content_key(labelled)),
    )
    left_out(read, labelled, sample).write.option("header", True).mode("overwrite").csv(f"{options.out}/left_out")
    for name in REPORTS:
        table = getattr(trained, name)
        if table is not None:
            table.write.option("header", True).mode("overwrite").csv(f"{options.out}/{name}")


if __name__ == "__main__":
    options = arguments()
    session = SparkSession.builder.appName("skyroute").getOrCreate()
    run(session, options)
    session.stop()
