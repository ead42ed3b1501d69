import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from goldens import rows
from skyroute.operators import learn, prep


@pytest.fixture(scope="module")
def labelled(spark):
    """Late flights leave in the evening and mostly carry two flight numbers."""
    draw = random.Random(9)
    data = []
    for i in range(1500):
        late = draw.random() < 0.4
        dep = draw.uniform(900, 1400) if late else draw.uniform(0, 1000)
        number = draw.choice(["7", "8"]) if late and draw.random() < 0.9 else str(draw.randrange(30))
        data.append((number, f"N{draw.randrange(20)}", draw.randrange(1, 8), dep, dep, dep + 60, dep + 55, float(late)))
    return spark.createDataFrame(
        data,
        "FlightNum STRING, TailNum STRING, DayOfWeek INT, DepTime DOUBLE, CRSDepTime DOUBLE,"
        " ArrTime DOUBLE, CRSArrTime DOUBLE, label DOUBLE",
    ).repartition(2).cache()


SMALL_GRIDS = {
    "Naive Bayes": None,
    "Decision Tree": {"maxBins": (64,), "maxDepth": (2,)},
    "Linear SVC": {"maxIter": (5,), "regParam": (0.01,)},
    "Random Forest": {"maxBins": (64,), "numTrees": (5,)},
}


@pytest.mark.parametrize("name", SMALL_GRIDS)
def test_learner_reports(labelled, name):
    result = learn.train(name, labelled, grid=SMALL_GRIDS[name])
    report = {r.Name: r.score for r in result.metrics.collect()}
    assert set(report) == {
        "Precision", "Recall", "FPR", "F1-Score", "areaUnderPR", "areaUnderROC",
        "BalancedAccuracy", "Accuracy",
    }
    assert report["BalancedAccuracy"] > 0.55, "better than the majority class"
    tested = sum(r.n for r in result.confusion.collect())
    assert abs(tested / 1500 - 0.3) < 0.06
    if name == "Naive Bayes":
        parts = {(r.part, r.label): r.n for r in result.splits.collect()}
        assert len(parts) == 4 and sum(parts.values()) == 1500
        assert parts["test", 0.0] + parts["test", 1.0] == tested
    if name in ("Decision Tree", "Random Forest"):
        values = [r.importance for r in result.importances.collect()]
        assert len(values) == 7 and min(values) >= 0 and sum(values) == pytest.approx(1)
        assert values == sorted(values, reverse=True)
    else:
        assert result.importances is None
    if SMALL_GRIDS[name]:
        assert 0 <= result.grid.first().metric <= 1


def test_boosted_trees_without_day_of_week(labelled):
    fitted = learn.fit("Gradient-Boosted Tree", labelled, numeric_columns=prep.NUMERIC_COLUMNS_BATCH)
    scored = learn.score(fitted, labelled)
    assert scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.8
    assert scored.columns == ["label", "prediction", "score"]


def test_grid_points(labelled):
    model = learn.fit("Decision Tree", labelled, grid={"maxBins": (10,), "maxDepth": (1, 2)})
    points = rows(learn.grid_scores(model, labelled), "params")
    # 30 flight numbers and one for the unseen: ten bins would not hold them.
    assert points == [("maxBins=31, maxDepth=1",), ("maxBins=31, maxDepth=2",)]


def test_tuned_grids_have_the_reference_sizes():
    sizes = {}
    for name, learner in learn.LEARNERS.items():
        if learner.tuned_grid:
            sizes[name] = 1
            for values in learner.tuned_grid.values():
                sizes[name] *= len(values)
    assert sizes == {"Decision Tree": 12, "Linear SVC": 9, "Random Forest": 12}


@pytest.mark.parametrize("name", ["Decision Tree", "Linear SVC", "Random Forest"])
def test_tuned_grids_run(labelled, name):
    result = learn.train(name, labelled.limit(200), tune=True)
    assert result.grid.count() == {"Linear SVC": 9}.get(name, 12)


def test_predictions_carry_keys_and_don_t_depend_on_layout(labelled):
    keyed = labelled.withColumn("id", F.xxhash64(*labelled.columns))
    one = learn.train("Naive Bayes", keyed.repartition(1), keys=["id"]).predictions
    many = learn.train("Naive Bayes", keyed.repartition(7), keys=["id"]).predictions
    assert one.columns == ["id", "label", "prediction", "score"]
    assert rows(one.select("id", "label", "prediction"), "id") == rows(many.select("id", "label", "prediction"), "id")
    assert one.count() == learn.train("Naive Bayes", keyed, keys=["id"]).splits.filter("part = 'test'").agg(F.sum("n")).first()[0]


def test_tuning_doesn_t_depend_on_layout(labelled):
    """The folds are drawn by a hash of the row, not by where a file puts it."""
    grid = {"maxBins": (64,), "maxDepth": (1, 3)}
    found = []
    for parts in (1, 32):
        model = learn.fit("Decision Tree", labelled.repartition(parts), grid=grid)
        found.append(rows(learn.grid_scores(model, labelled)))
    assert found[0] == found[1] and len(found[0]) == 2
    folds = prep.fold_by_key(labelled, prep.content_key(labelled)).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2} and all(400 < r["count"] < 600 for r in folds)


def test_folds_split_the_rows_of_a_validation(labelled):
    """The validation scores each fold with a model of the other two."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    grid = {"maxBins": (64,), "maxDepth": (2,)}
    fitted = learn.fit("Decision Tree", labelled, grid=grid)
    inputs = [*prep.STRING_COLUMNS, *prep.NUMERIC_COLUMNS, "label"]
    folded = prep.fold_by_key(labelled, prep.content_key(labelled.select(inputs)))
    vectors = fitted.assembler.transform(learn.indexed_rows(fitted, folded)).select("label", "fold", "features")
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction")
    scores = []
    for fold in range(3):
        model = learn.LEARNERS["Decision Tree"].estimator(labelCol="label", featuresCol="features", maxBins=64, maxDepth=2)
        scores.append(area.evaluate(model.fit(vectors.filter(f"fold <> {fold}")).transform(vectors.filter(f"fold = {fold}"))))
    assert fitted.model.avgMetrics[0] == pytest.approx(sum(scores) / 3)


def test_the_validator_reads_assembled_rows(labelled, monkeypatch):
    """Vectors are assembled once, before the validation."""
    seen = []
    from pyspark.ml.tuning import CrossValidator

    plain = CrossValidator.fit
    monkeypatch.setattr(CrossValidator, "fit", lambda self, df, *a: seen.append(df) or plain(self, df, *a))
    learn.fit("Linear SVC", labelled, grid=SMALL_GRIDS["Linear SVC"])
    assert seen[0].columns == ["label", "fold", "features"]


FEATURES = ("IndexedFlightNum", "IndexedTailNum", *prep.NUMERIC_COLUMNS)


def test_parameters_as_columns_equal_the_model(labelled):
    keyed = labelled.withColumn("id", F.monotonically_increasing_id()).cache()
    model = learn.fit("Naive Bayes", keyed)
    expected = {r.id: (r.prediction, r.score) for r in learn.score(model, keyed, ["id"]).collect()}
    parameters = learn.naive_bayes_parameters(model, keyed)
    scored = learn.score_by_parameters(learn.indexed_rows(model, keyed), parameters, FEATURES)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    found = {r.id: (r.prediction, r.score) for r in scored.collect()}
    assert found.keys() == expected.keys()
    for i, (prediction, value) in expected.items():
        assert found[i][0] == prediction and found[i][1] == pytest.approx(value)


@pytest.mark.parametrize("depth", [0, 1, 5])
def test_node_table_equals_the_model(labelled, depth):
    keyed = labelled.withColumn("id", F.monotonically_increasing_id()).cache()
    model = learn.fit("Decision Tree", keyed, params={"maxDepth": depth})
    nodes = learn.tree_nodes(model)
    assert nodes.count() == model.stages[-1].numNodes
    assert nodes.filter("feature IS NOT NULL AND (threshold IS NULL) = (left_categories IS NULL)").count() == 0
    expected = rows(learn.score(model, keyed, ["id"]), "id", "prediction")
    found = learn.score_by_nodes(learn.indexed_rows(model, keyed), nodes, FEATURES)
    assert rows(found, "id", "prediction") == expected
    assert set(keyed.columns) < set(found.columns)


def test_saved_pipeline_scores_alike(labelled, tmp_path):
    from pyspark.ml import PipelineModel

    model = learn.fit("Decision Tree", labelled, params={"maxDepth": 3})
    model.pipeline.write().overwrite().save(f"{tmp_path}/tree")
    again = PipelineModel.load(f"{tmp_path}/tree").transform(learn.indexed_rows(model, labelled))
    assert again.groupBy("prediction").count().collect() == model.transform(labelled).groupBy("prediction").count().collect()


def test_same_tree_as_with_labels_on_the_driver(labelled):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import StringIndexer

    columns = list(prep.STRING_COLUMNS)
    indexer = StringIndexer(inputCols=columns, outputCols=[f"Indexed{c}" for c in columns], handleInvalid="keep")
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", maxBins=learn.TREE_BINS)
    plain = Pipeline(stages=[indexer, prep.assembler(), tree]).fit(labelled).stages[-1]
    ours = learn.best_stages(learn.fit("Decision Tree", labelled, grid={"maxBins": (learn.TREE_BINS,)}))[-1]
    assert ours.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("name", ["Naive Bayes", "Linear SVC", "Decision Tree"])
def test_many_categories(spark, name):
    wide = spark.range(200_000).select(
        F.col("id").cast("string").alias("FlightNum"), (F.col("id") % 7).cast("string").alias("TailNum"),
        *[(F.col("id") % 1440).cast("double").alias(c) for c in prep.NUMERIC_COLUMNS],
        (F.col("id") % 2).cast("double").alias("label"),
    )
    params = {"Linear SVC": {"maxIter": 2}, "Decision Tree": {"maxDepth": 2}}.get(name)
    fitted = learn.fit(name, wide, params=params)
    if name == "Decision Tree":  # bins don't grow with a column's values
        assert fitted.nominal == ("TailNum",) and fitted.stages[-1].getMaxBins() == learn.TREE_BINS
    assert fitted.dictionaries["FlightNum"].size == 200_000
    assert learn.score(fitted, wide).filter("prediction IN (0, 1)").count() == 200_000


def test_plain_positions_instead_of_categories(labelled):
    fitted = learn.fit("Decision Tree", labelled, grid={"maxBins": (8,), "maxDepth": (2,)}, nominal=())
    assert learn.score(fitted, labelled).count() == 1500


def test_unknown_learner(labelled):
    with pytest.raises(ValueError, match="unknown learner"):
        learn.fit("Perceptron", labelled)


def test_unseen_categories_are_scored(spark, labelled):
    model = learn.fit("Naive Bayes", labelled)
    unseen = labelled.limit(5).withColumn("FlightNum", F.lit("new")).withColumn("TailNum", F.lit(None).cast("string"))
    assert learn.score(model, unseen).count() == 5


@pytest.mark.parametrize("name", ["Linear SVC", "Random Forest"])
def test_learning_in_a_session_that_observed_a_metric(spark, name):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 5}
    table = spark.range(60).selectExpr("id % 2 = 0 AS late", "CAST(id % 2 AS DOUBLE) AS x", "CAST(id % 7 AS STRING) AS s")
    rows = table.selectExpr("s", "x", "IF(late, 1.0D, 0.0D) AS label")
    grid = {"maxIter": (3,)} if name == "Linear SVC" else {"numTrees": (2,), "maxDepth": (2,)}
    model = learn.fit(name, rows, ["s"], ["x"], grid=grid)
    assert learn.score(model, rows).filter("label IN (0, 1)").count() == 60
    assert learn.score(model, rows).agg(F.count("score")).first()[0] == 60
    assert spark.getActiveSession() is None or spark.getActiveSession()._jsparkSession.equals(spark._jsparkSession)


def test_tree_grid_grows_a_tree_once_for_all_depths(labelled, monkeypatch):
    """One tree a fold and impurity, and the figures of trees that are grown for each depth."""
    fits, plain = [], learn.DecisionTreeClassifier._fit
    monkeypatch.setattr(learn.DecisionTreeClassifier, "_fit", lambda self, rows: fits.append(1) or plain(self, rows))
    grid = {"maxBins": (64,), "maxDepth": (1, 6, 3), "impurity": ("gini", "entropy")}
    found = learn.fit("Decision Tree", labelled, grid=grid).model
    assert len(fits) == 2 * learn.FOLDS + 1
    points = [{p.name: v for p, v in point.items()} for point in found.getEstimatorParamMaps()]
    assert [p["maxDepth"] for p in points] == [1, 1, 6, 6, 3, 3]
    for point, metric in list(zip(points, found.avgMetrics))[::2]:
        alone = learn.fit("Decision Tree", labelled, grid={k: (v,) for k, v in point.items()}).model
        assert alone.avgMetrics == [metric], point
    assert len(set(found.avgMetrics[::2])) > 1


def test_trees_of_a_grid_share_a_failure(labelled):
    trees = learn.NestedTrees(labelCol="label", featuresCol="features")
    points = [{trees.maxDepth: d} for d in (2, 4)]
    models = trees.fitMultiple(labelled, points)  # there are no vectors
    for _ in points:
        with pytest.raises(Exception, match="features"):
            next(models)
