"""Labels, samples, splits and features for the delay classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroute.functions.ordered import number_rows

# The delay that counts as late, the seed, the shares of the split.
LATE_FROM = 40.0
SEED = 36
TRAIN_SHARE = 0.7
# Of cross-validation, the learning library's default.
FOLDS = 3
DRAWS = 1 << 53

# The columns the classifiers learn from.
STRING_COLUMNS = ("FlightNum", "TailNum")
NUMERIC_COLUMNS = ("DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime")
NUMERIC_COLUMNS_BATCH = ("DepTime", "CRSDepTime", "ArrTime", "CRSArrTime")


def label_delays(flights: DataFrame, invalid: str = "error") -> DataFrame:
    """Add ``label``: 0 for a delay in [0, 40), 1 from 40 on, null for null.

    A negative or NaN delay has no bucket and fails the job. With ``invalid="skip"`` such
    rows go; ``rejected_delays`` counts them.
    """
    delay = F.col("DepDelay")
    valid = _has_bucket(delay)
    label = F.when(delay < LATE_FROM, 0.0).when(delay >= LATE_FROM, 1.0)
    if invalid == "error":
        failed = F.raise_error(F.lit("DepDelay is negative or NaN"))
        return flights.withColumn("label", F.when(~valid, failed).otherwise(label))
    if invalid != "skip":
        raise ValueError(f"invalid must be skip or error, not {invalid!r}")
    return flights.filter(valid | delay.isNull()).withColumn("label", label)


def _has_bucket(delay: Column) -> Column:
    return (delay >= 0) & ~F.isnan(delay)


def rejected_delays(flights: DataFrame) -> DataFrame:
    """One row: how many delays are negative, NaN, and missing, and how many rows there are."""
    delay = F.col("DepDelay")
    return flights.agg(
        F.count_if((delay < 0) & ~F.isnan(delay)).alias("negative"),
        F.count_if(F.isnan(delay)).alias("nan"),
        F.count_if(delay.isNull()).alias("missing"),
        F.count(F.lit(1)).alias("total"),
    )


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows by label; a null label is a group of its own."""
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def class_balance(labelled: DataFrame) -> DataFrame:
    """Late and all rows, their ratio late / others, and the sampled fraction.

    Rows without a label count as others. The ratio is infinite if all rows are late.
    """
    late = F.count_if(F.col("label") == 1.0)
    counts = labelled.agg(late.alias("late"), F.count(F.lit(1)).alias("total"))
    ratio = F.try_divide(F.col("late").cast("double"), (F.col("total") - F.col("late")).cast("double"))
    return counts.withColumn(
        "ratio", F.coalesce(ratio, F.when(F.col("late") > 0, float("inf")))
    ).withColumn("fraction", F.least(F.lit(1.0), F.coalesce("ratio", F.lit(0.0))))


def _fraction(labelled: DataFrame) -> float:
    return class_balance(labelled).first()["fraction"]


def stratified_sample(labelled: DataFrame, seed: int = SEED) -> DataFrame:
    """Keep both classes at the same fraction, the class ratio; null labels go."""
    fraction = _fraction(labelled)
    return labelled.sampleBy("label", {0.0: fraction, 1.0: fraction}, seed)


def balanced_sample(labelled: DataFrame, seed: int = SEED) -> DataFrame:
    """Keep all late rows and the others at the class ratio, so the classes even out."""
    return labelled.sampleBy("label", {0.0: _fraction(labelled), 1.0: 1.0}, seed)


def draw_below(key: Column, share: float, values: int | None) -> Column:
    """Whether a row is among the ``share`` that its integer key draws; a null key draws 0.

    The key's hash draws one of ``DRAWS`` values. With ``values`` the key itself does,
    modulo so many: for keys that SQL has to follow.
    """
    draw = F.pmod(F.xxhash64(key), F.lit(DRAWS)) if values is None else F.pmod(key, F.lit(values))
    return F.coalesce(F.when(key.isNotNull(), draw), F.lit(0)) < F.lit(share * (values or DRAWS))


def spread_key(key: Column, factor: int, values: int = DRAWS) -> Column:
    """``key * factor`` modulo ``values``, exact also where the product is no 64-bit integer."""
    product = key.cast("decimal(19,0)") * F.lit(factor).cast("decimal(10,0)")
    return F.pmod(product, F.lit(values).cast("decimal(19,0)")).cast("long")


def balanced_by_key(labelled: DataFrame, key: Column, values: int | None = None) -> DataFrame:
    """``balanced_sample`` that draws by an integer key, the same on every run and layout."""
    drawn = draw_below(key, _fraction(labelled), values)
    return labelled.filter((F.col("label") == 1.0) | ((F.col("label") == 0.0) & drawn))


def stratified_by_key(labelled: DataFrame, key: Column, values: int | None = None) -> DataFrame:
    """``stratified_sample`` that draws by an integer key, the same on every run and layout."""
    return labelled.filter(F.col("label").isNotNull() & draw_below(key, _fraction(labelled), values))


def content_key(rows: DataFrame) -> Column:
    """An integer that depends on a row's values alone."""
    return F.xxhash64(*rows.columns)


def random_split(rows: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    train, test = rows.randomSplit([TRAIN_SHARE, 1 - TRAIN_SHARE], seed)
    return train, test


def split_by_key(
    rows: DataFrame, key: Column, train_share: float = TRAIN_SHARE, values: int | None = None
) -> DataFrame:
    """Add ``part``, train or test, drawn by an integer key."""
    drawn = draw_below(key, train_share, values)
    return rows.withColumn("part", F.when(drawn, "train").otherwise("test"))


def fold_by_key(rows: DataFrame, key: Column, folds: int = FOLDS, values: int | None = None) -> DataFrame:
    """Add ``fold``, 0 to ``folds`` - 1, drawn by an integer key; a null key is in fold 0.

    Like ``split_by_key``, so neither file layout nor a seed changes a row's fold.
    """
    draw = F.xxhash64(F.lit("fold"), key) if values is None else F.floor(F.pmod(key, F.lit(values)) * folds / values)
    return rows.withColumn("fold", F.coalesce(F.pmod(draw, F.lit(folds)), F.lit(0)).cast("int"))


def index_values(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, position): the most frequent value is 0, ties go by value."""
    counts = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbered = number_rows(counts, [F.col("n").desc(), "value"], unique=True)
    return numbered.select("value", "n", (F.col("number") - 1).cast("double").alias("position"))


def index_column(
    rows: DataFrame, column: str, values: DataFrame | None = None, size: int | None = None
) -> DataFrame:
    """Add ``Indexed<column>`` by a join; unseen and null values get the number of values.

    The dictionary stays a table, so it may grow with the data. ``size`` is its number of
    values, counted here if it is not given.
    """
    values = index_values(rows, column) if values is None else values
    unseen = float(values.count() if size is None else size)
    lookup = values.select(F.col("value").alias(column), F.col("position").alias("_position"))
    return (
        rows.join(lookup, column, "left")
        .withColumn(f"Indexed{column}", F.coalesce("_position", F.lit(unseen)))
        .drop("_position")
    )


def assembler(
    string_columns: Sequence[str] = STRING_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
) -> VectorAssembler:
    inputs = [f"Indexed{c}" for c in string_columns] + list(numeric_columns)
    return VectorAssembler(inputCols=inputs, outputCol="features")


def assemble_features(
    rows: DataFrame,
    string_columns: Sequence[str] = STRING_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """Index the text columns and add ``features``; a null number fails the job."""
    for column in string_columns:
        rows = index_column(rows, column)
    return assembler(string_columns, numeric_columns).transform(rows)


def feature_array(features: str = "features") -> Column:
    return vector_to_array(F.col(features))
