import pytest
from pyspark.sql import functions as F

from goldens import rows
from skyroute.operators import prep

INF = float("inf")


def delays(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id LONG, DepDelay DOUBLE")


def test_labels(spark):
    df = delays(spark, [0.0, 39.9, 40.0, 1e9, INF, None])
    assert [r.label for r in prep.label_delays(df).orderBy("id").collect()] == [0, 0, 1, 1, 1, None]


@pytest.mark.parametrize("bad", [-3.0, float("nan")])
def test_invalid_delays(spark, bad):
    df = delays(spark, [5.0, bad, None])
    assert prep.label_delays(df, invalid="skip").count() == 2
    with pytest.raises(Exception, match="negative or NaN"):
        prep.label_delays(df).collect()
    with pytest.raises(ValueError, match="skip or error"):
        prep.label_delays(df, invalid="drop")
    assert prep.label_delays(delays(spark, [5.0, None])).count() == 2
    assert rows(prep.rejected_delays(df)) == [(int(bad < 0), int(bad != bad), 1, 3)]


def test_balance_counts_null_labels_as_others(spark):
    df = prep.label_delays(delays(spark, [50.0, 60.0, 1.0, 2.0, 3.0, None]))
    assert rows(prep.class_balance(df)) == [(2, 6, 0.5, 0.5)]
    assert {(r.label, r.n) for r in prep.label_counts(df).collect()} == {(0.0, 3), (1.0, 2), (None, 1)}


def test_balance_extremes(spark):
    all_late = prep.label_delays(delays(spark, [50.0, 60.0]))
    assert rows(prep.class_balance(all_late)) == [(2, 2, INF, 1.0)]
    none_late = prep.label_delays(delays(spark, [1.0]))
    assert rows(prep.class_balance(none_late)) == [(0, 1, 0.0, 0.0)]


@pytest.fixture(scope="module")
def many(spark):
    return prep.label_delays(
        spark.range(20_000).select(
            "id", F.when(F.col("id") % 4 == 0, 50.0).when(F.col("id") % 4 == 1, None).otherwise(1.0).alias("DepDelay")
        )
    ).cache()


def test_stratified_sample_keeps_the_imbalance_and_drops_nulls(many):
    sample = dict(rows(prep.label_counts(prep.stratified_sample(many))))
    assert set(sample) == {0.0, 1.0}
    assert abs(sample[0.0] / 10_000 - 1 / 3) < 0.03 and abs(sample[1.0] / 5_000 - 1 / 3) < 0.03


def test_balanced_samples_keep_the_minority_whole(many):
    for sample in (prep.balanced_sample(many), prep.balanced_by_key(many, F.col("id") * 7919)):
        counts = dict(rows(prep.label_counts(sample)))
        assert counts[1.0] == 5_000
        assert abs(counts[0.0] / 10_000 - 1 / 3) < 0.03


def test_splits_are_disjoint_and_whole(many):
    train, test = prep.random_split(many)
    assert train.count() + test.count() == 20_000
    assert train.join(test, "id").count() == 0
    assert abs(train.count() / 20_000 - 0.7) < 0.02
    parts = dict(rows(prep.split_by_key(many, F.col("id") * 7919).groupBy("part").count()))
    assert sum(parts.values()) == 20_000 and abs(parts["train"] / 20_000 - 0.7) < 0.02
    no_key = prep.split_by_key(many, F.lit(None).cast("long"))
    assert no_key.count() == 20_000


def test_small_shares_are_drawn(spark):
    """A class share far below a thousandth keeps its share, not a thousandth."""
    few = spark.range(400_000).select("id", F.when(F.col("id") % 5000 == 0, 50.0).otherwise(1.0).alias("DepDelay"))
    labelled = prep.label_delays(few)
    sample = dict(rows(prep.label_counts(prep.balanced_by_key(labelled, F.col("id")))))
    assert sample[1.0] == 80 and 50 <= sample[0.0] <= 115


def test_folds_cover_all_rows(many):
    folds = dict(rows(prep.fold_by_key(many, F.col("id"), 5).groupBy("fold").count()))
    assert sum(folds.values()) == 20_000 and set(folds) == set(range(5))
    assert all(abs(n / 20_000 - 0.2) < 0.02 for n in folds.values())
    assert dict(rows(prep.fold_by_key(many, F.lit(None).cast("long")).groupBy("fold").count())) == {0: 20_000}
    both = prep.split_by_key(prep.fold_by_key(many, F.col("id")), F.col("id"))
    shares = rows(both.groupBy("fold", "part").count())
    assert all(abs(n / 20_000 - (0.7 if part == "train" else 0.3) / 3) < 0.02 for _, part, n in shares)


def test_index_values_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s STRING")
    values = prep.index_values(train, "s")
    assert rows(values, "position", "value", "n") == [(0.0, "c", 2), (1.0, "a", 1), (2.0, "b", 1)]
    probe = spark.createDataFrame([("c",), ("zz",), (None,), ("",)], "s STRING")
    indexed = prep.index_column(probe, "s", values)
    assert {(r.s, r.Indexeds) for r in indexed.collect()} == {("c", 0.0), ("zz", 3.0), (None, 3.0), ("", 3.0)}


def test_index_equals_the_ml_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(500).select((F.col("id") * F.col("id") % 37).cast("string").alias("s"))
    ours = prep.index_column(df, "s")
    both = StringIndexer(inputCol="s", outputCol="ml", handleInvalid="keep").fit(df).transform(ours)
    assert both.filter("ml <> Indexeds").count() == 0 and both.count() == 500


def test_null_number_fails_assembly(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "s STRING, x DOUBLE")
    with pytest.raises(Exception, match="null"):
        prep.assemble_features(df, ["s"], ["x"]).collect()
    good = prep.assemble_features(df.na.fill(2.0), ["s"], ["x"])
    assert rows(good.select(prep.feature_array().alias("f"))) == [([0.0, 1.0],), ([1.0, 2.0],)]


def test_spread_keys_beyond_64_bits(spark):
    keys = [0, 1, 9_223_372_036, 9_223_372_037, 285_000_000_000, -9_223_372_038, 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(k,) for k in keys], "key LONG")
    spread = df.select("key", prep.spread_key(F.col("key"), 999_999_937).alias("s")).collect()
    assert all(r.s == (None if r.key is None else r.key * 999_999_937 % prep.DRAWS) for r in spread)
    assert len(spread) == len(keys)
