"""The five delay classifiers: pipelines, tuning, scoring and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product
from threading import Lock

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.functions.scratch import new_folder, write_table
from skyroute.operators import evaluate
from skyroute.operators.prep import (
    FOLDS,
    NUMERIC_COLUMNS,
    STRING_COLUMNS,
    assembler,
    content_key,
    fold_by_key,
    index_column,
    index_values,
    label_counts,
    split_by_key,
)

# Bins, iterations, penalties, depths and impurities to train and tune with,
# and the learners' names below.
TREE_BINS = 10_000
TREE_BINS_TUNED = (10_000, 11_000)
TREE_DEPTHS_TUNED = (2, 5, 10)
FOREST_DEPTHS_TUNED = (5, 10, 20)
IMPURITIES_TUNED = ("entropy", "gini")
SVC_ITERATIONS = 100
SVC_PENALTY = 0.01
SVC_ITERATIONS_TUNED = (100, 200, 300)
SVC_PENALTIES_TUNED = (0.1, 0.01, 0.001)


class NestedTrees(DecisionTreeClassifier):
    """A decision tree that is grown once for all depths of a grid.

    Trees grow level by level, from all rows and features, and no split depends on the
    levels below: a shallower tree is the top of a deeper one with the same settings.
    Points that differ in depth alone share the deepest tree, and the others' models
    predict what its nodes at their depth do.
    """

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> _Models:
        points = [{p.name: v for p, v in point.items()} for point in paramMaps]
        depth = [point.pop("maxDepth", self.getMaxDepth()) for point in points]
        alike = [repr(sorted(point.items())) for point in points]
        deepest: dict[str, int] = {}
        for i, name in enumerate(alike):
            if name not in deepest or depth[i] > depth[deepest[name]]:
                deepest[name] = i
        trees = {i: Future() for i in deepest.values()}

        def model(i: int) -> DecisionTreeClassificationModel | TopOfTree:
            if i not in trees:
                return TopOfTree(trees[deepest[alike[i]]].result(), depth[i])
            try:
                trees[i].set_result(self.fit(dataset, paramMaps[i]))
            except BaseException as error:
                trees[i].set_exception(error)
            return trees[i].result()

        # Whoever waits for a tree comes after all that are grown, so none waits for ever.
        return _Models([*trees, *(i for i in range(len(points)) if i not in trees)], model)


class _Models:
    """(point, its model) for threads that ask for the next one."""

    def __init__(self, points: Iterable[int], model: Callable[[int], Model]):
        self._points, self._model, self._lock = iter(points), model, Lock()

    def __iter__(self) -> _Models:
        return self

    def __next__(self) -> tuple[int, Model]:
        with self._lock:
            point = next(self._points)
        return point, self._model(point)


class TopOfTree:
    """The first ``depth`` levels of a tree, as a model that predicts."""

    def __init__(self, tree: DecisionTreeClassificationModel, depth: int):
        self.tree, self.depth = tree, depth

    def leaf_predictions(self) -> list[float]:
        """For each leaf, from the left, what the node above it at ``depth`` predicts."""
        found, waiting = [], [(self.tree._java_obj.rootNode(), 0)]
        while waiting:  # at most 2 ** (depth + 1) nodes
            node, level = waiting.pop()
            below = node.numDescendants()
            if level == self.depth or not below:
                found += [node.prediction()] * (below // 2 + 1)
            else:
                waiting += [(node.rightChild(), level + 1), (node.leftChild(), level + 1)]
        return found

    def transform(self, rows: DataFrame, params: dict | None = None) -> DataFrame:
        """``rows`` with the ``prediction``; ``params`` are those the model has."""
        known = F.split(F.lit(",".join(map(str, self.leaf_predictions()))), ",").cast("array<double>")
        scored = self.tree.transform(rows, {self.tree.leafCol: "_leaf"})
        return scored.select(*rows.columns, F.get(known, F.col("_leaf").cast("int")).alias("prediction"))


@dataclass(frozen=True)
class Learner:
    """How to make an estimator, and its grids; without grids it is fitted once."""

    estimator: Callable[..., Estimator]
    categorical: bool = False
    grid: dict[str, Sequence] | None = None
    tuned_grid: dict[str, Sequence] | None = None


LEARNERS: dict[str, Learner] = {
    "Naive Bayes": Learner(NaiveBayes),
    "Decision Tree": Learner(
        NestedTrees,
        categorical=True,
        grid={"maxBins": (TREE_BINS,), "impurity": ("gini",)},
        tuned_grid={
            "maxBins": TREE_BINS_TUNED,
            "maxDepth": TREE_DEPTHS_TUNED,
            "impurity": IMPURITIES_TUNED,
        },
    ),
    "Linear SVC": Learner(
        LinearSVC,
        grid={"maxIter": (SVC_ITERATIONS,), "regParam": (SVC_PENALTY,)},
        tuned_grid={"maxIter": SVC_ITERATIONS_TUNED, "regParam": SVC_PENALTIES_TUNED},
    ),
    "Random Forest": Learner(
        RandomForestClassifier,
        categorical=True,
        grid={"maxBins": (TREE_BINS,)},
        tuned_grid={
            "maxBins": TREE_BINS_TUNED,
            "maxDepth": FOREST_DEPTHS_TUNED,
            "impurity": IMPURITIES_TUNED,
        },
    ),
    "Gradient-Boosted Tree": Learner(GBTClassifier, categorical=True),
}


@dataclass(frozen=True)
class Indexed:
    """The dictionary of a text column: a table, and its number of values."""

    values: DataFrame
    size: int


@dataclass(frozen=True)
class Fitted:
    """A fitted classifier behind its assembler and the dictionaries of its text columns.

    The dictionaries are tables that rows are joined with. Trees are told only how many
    values a ``nominal`` column has.
    """

    dictionaries: dict[str, Indexed]
    nominal: tuple[str, ...]
    assembler: VectorAssembler
    model: Model

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.pipeline.transform(_with_indexes(rows, self.dictionaries, self.nominal))

    @property
    def stages(self) -> list:
        return [self.assembler, getattr(self.model, "bestModel", self.model)]

    @property
    def pipeline(self) -> PipelineModel:
        """Assembler and classifier; it takes rows with indexed text columns and can be saved."""
        return PipelineModel(self.stages)


@dataclass(frozen=True)
class Trained:
    """A fitted model with its reports, each made when it is first asked for.

    ``predictions`` holds the scored test rows with the caller's key columns.
    """

    model: Fitted
    fitting: DataFrame
    testing: DataFrame
    keys: tuple[str, ...]
    input_columns: tuple[str, ...]
    curve_bins: int

    @cached_property
    def splits(self) -> DataFrame:
        """(part, label, n)."""
        return label_counts(self.fitting).select(F.lit("train").alias("part"), "*").unionByName(
            label_counts(self.testing).select(F.lit("test").alias("part"), "*")
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """The keys, label, prediction and score of the test rows."""
        return score(self.model, self.testing, self.keys)

    @cached_property
    def tally(self) -> DataFrame:
        return write_table(evaluate.tally(score(self.model, self.testing)))

    @cached_property
    def metrics(self) -> DataFrame:
        return evaluate.metrics_report(self.tally, bins=self.curve_bins)

    @cached_property
    def confusion(self) -> DataFrame:
        return evaluate.confusion_matrix(self.tally)

    @cached_property
    def importances(self) -> DataFrame | None:
        if not hasattr(best_stages(self.model)[-1], "featureImportances"):
            return None
        return importances(self.model, self.input_columns, self.fitting)

    @cached_property
    def grid(self) -> DataFrame | None:
        return grid_scores(self.model, self.fitting) if hasattr(self.model.model, "avgMetrics") else None


def _with_indexes(rows: DataFrame, dictionaries: dict[str, Indexed], nominal: Sequence[str]) -> DataFrame:
    for column, known in dictionaries.items():
        rows = index_column(rows, column, known.values, known.size)
        if column in nominal:
            name = f"Indexed{column}"
            about = {"ml_attr": {"type": "nominal", "num_vals": known.size + 1, "name": name}}
            rows = rows.withColumn(name, F.col(name).alias(name, metadata=about))
    return rows


def _param_grid(estimator: Estimator, grid: dict[str, Sequence], bins: int) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        if name == "maxBins":
            values = sorted({max(v, bins) for v in values})
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def fit(
    name: str,
    train: DataFrame,
    string_columns: Sequence[str] = STRING_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
    tune: bool = False,
    grid: dict[str, Sequence] | None = None,
    parallelism: int = 4,
    nominal: Sequence[str] | None = None,
    params: dict[str, object] | None = None,
    fold_key: Column | None = None,
) -> Fitted:
    """Fit the learner called ``name``, by cross-validation if it has a grid.

    Text columns become the positions of their values by frequency in ``train``. Trees
    take the ``nominal`` ones as categories and get at least as many bins as one of them
    has values; of other columns they take the positions as numbers. By default columns
    of fewer than ``TREE_BINS`` values are nominal, so bins don't grow with the data. The
    metric of the validation is the ROC area of the 0/1 prediction.

    Vectors are assembled once and stored with the label and the fold; all fits of a
    validation read those, in a session of their own. A row's fold is drawn by
    ``fold_key``, by default a hash of its values. With ``params`` the learner is fitted
    once with these, without a grid.
    """
    if name not in LEARNERS:
        raise ValueError(f"unknown learner {name!r}; known are {', '.join(LEARNERS)}")
    learner = LEARNERS[name]
    dictionaries = {}
    for column in string_columns:
        values = write_table(index_values(train, column))
        dictionaries[column] = Indexed(values, values.count())
    if nominal is None:
        nominal = [c for c in string_columns if dictionaries[c].size < TREE_BINS]
    nominal = tuple(nominal) if learner.categorical else ()
    bins = max((dictionaries[c].size for c in nominal), default=0) + 1
    estimator = learner.estimator(labelCol="label", featuresCol="features")
    if learner.categorical:
        estimator = estimator.setMaxBins(max(TREE_BINS, bins))
    if params:
        estimator = estimator.copy({estimator.getParam(param): value for param, value in params.items()})
    grid = None if params is not None else grid or (learner.tuned_grid if tune else learner.grid)
    fitted = estimator
    if grid is not None:
        fitted = CrossValidator(
            estimator=estimator,
            evaluator=BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction"),
            estimatorParamMaps=_param_grid(estimator, grid, bins),
            parallelism=parallelism,
            numFolds=FOLDS,
            foldCol="fold",
        )
    inputs = [*string_columns, *numeric_columns, "label"]
    folded = fold_by_key(train, content_key(train.select(inputs)) if fold_key is None else fold_key)
    vectors = assembler(string_columns, numeric_columns)
    rows = vectors.transform(_with_indexes(folded, dictionaries, nominal))
    rows = _in_own_session(rows.select("label", "fold", "features"))
    return Fitted(dictionaries, nominal, vectors, fitted.fit(rows))


def _in_own_session(rows: DataFrame) -> DataFrame:
    """``rows``, stored and read by a new session of the same settings.

    Some models keep the session of their training rows and are sent to tasks with it,
    which fails if that session has ever observed a metric.
    """
    spark = rows.sparkSession
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    folder = new_folder(spark)
    return session.read.schema(write_table(rows, folder).schema).parquet(folder)


def best_stages(model: Fitted) -> list:
    return model.stages


def score(model: Fitted, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, label, prediction, score); the score is the probability of class 1, or the
    prediction of a learner that has no probabilities."""
    scored = model.transform(rows)
    known = "probability" in scored.columns
    value = vector_to_array(F.col("probability"))[1] if known else F.col("prediction")
    return scored.select(*keys, "label", "prediction", value.alias("score"))


def importances(model: Fitted, input_columns: Sequence[str], rows: DataFrame) -> DataFrame:
    """(name, importance), the most important feature first."""
    values = best_stages(model)[-1].featureImportances.toArray()
    pairs = [(c, float(v)) for c, v in zip(input_columns, values)]
    named = rows.sparkSession.createDataFrame(pairs, "name STRING, importance DOUBLE")
    return named.orderBy(F.col("importance").desc(), "name")


def grid_scores(model: Fitted, rows: DataFrame) -> DataFrame:
    """(params, metric) for each point of a cross-validated grid."""
    points = [
        ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda i: i[0].name))
        for point in model.model.getEstimatorParamMaps()
    ]
    return rows.sparkSession.createDataFrame(
        list(zip(points, map(float, model.model.avgMetrics))), "params STRING, metric DOUBLE"
    )


def train(
    name: str,
    dataset: DataFrame,
    string_columns: Sequence[str] = STRING_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
    tune: bool = False,
    grid: dict[str, Sequence] | None = None,
    parallelism: int = 4,
    keys: Sequence[str] = (),
    draw: Column | None = None,
    curve_bins: int = 0,
    nominal: Sequence[str] | None = None,
    draw_values: int | None = None,
) -> Trained:
    """Split labelled rows 70 to 30, fit on the larger part and report on the smaller.

    ``draw`` is the integer that decides a row's part, by default a hash of the row, so
    the parts don't depend on how files are cut; ``draw_values`` is as in ``split_by_key``.
    ``keys`` are handed on to the predictions. Curves are exact unless ``curve_bins`` asks
    for so many points.
    """
    inputs = [*dict.fromkeys([*keys, *string_columns, *numeric_columns, "label"])]
    draw = content_key(dataset.select(inputs)) if draw is None else draw
    stored = write_table(split_by_key(dataset, draw, values=draw_values).select(*inputs, "part"))
    fitting, testing = (stored.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    model = fit(name, fitting, string_columns, numeric_columns, tune, grid, parallelism, nominal)
    columns = [f"Indexed{c}" for c in string_columns] + list(numeric_columns)
    return Trained(model, fitting, testing, tuple(keys), tuple(columns), curve_bins)


def naive_bayes_parameters(model: Fitted, rows: DataFrame) -> DataFrame:
    """(label, feature, log_theta, log_pi) of a fitted naive Bayes, features from 0 on."""
    bayes = best_stages(model)[-1]
    theta, pi = bayes.theta.toArray(), bayes.pi.toArray()
    parameters = [
        (float(c), f, float(theta[c, f]), float(pi[c]))
        for c, f in product(range(theta.shape[0]), range(theta.shape[1]))
    ]
    return rows.sparkSession.createDataFrame(
        parameters, "label DOUBLE, feature INT, log_theta DOUBLE, log_pi DOUBLE"
    )


def indexed_rows(model: Fitted, rows: DataFrame) -> DataFrame:
    """``rows`` with the positions of their text columns, as the model sees them."""
    return _with_indexes(rows, model.dictionaries, model.nominal)


def score_by_parameters(rows: DataFrame, parameters: DataFrame, features: Sequence[str]) -> DataFrame:
    """``rows`` with ``prediction`` and ``score`` of a naive Bayes, as plain columns.

    ``parameters`` is the table of ``naive_bayes_parameters``: as many rows as classes
    times ``features``. A class's value is its log prior plus the features weighted by
    its log likelihoods; the largest is predicted, the smallest class among equals. The
    score is the probability of class 1.
    """
    found = parameters.collect()  # classes x features
    priors = {r["label"]: r["log_pi"] for r in found}
    weights = {(r["label"], r["feature"]): r["log_theta"] for r in found}
    values = []
    for label in sorted(priors):
        terms = [F.col(c) * F.lit(weights[label, i]) for i, c in enumerate(features)]
        values.append((label, reduce(lambda a, b: a + b, terms, F.lit(priors[label]))))
    best = F.greatest(*[v for _, v in values]) if len(values) > 1 else values[0][1]
    prediction = F.coalesce(*[F.when(v == best, F.lit(label)) for label, v in values])
    one = [v for label, v in values if label == 1.0]
    total = reduce(lambda a, b: a + b, [F.exp(v - best) for _, v in values])
    score = F.exp(one[0] - best) / total if one else F.lit(0.0)
    return rows.withColumns({"prediction": prediction, "score": score})


def tree_nodes(model: Fitted) -> DataFrame:
    """The fitted decision tree as a table, one row a node, the root's ``node`` being 0.

    An inner node has a ``feature`` (from 0 on), its ``threshold`` or the sorted
    ``left_categories``, its children ``low`` and ``high``, and its ``gain``; a leaf has
    no feature. A row goes to ``low`` if its value is at most the threshold, or one of the
    categories.
    """
    tree = best_stages(model)[-1]
    session = SparkSession.getActiveSession()
    rows, waiting = [], [(0, tree._java_obj.rootNode())]
    while waiting:  # as many steps as the tree has nodes
        node, it = waiting.pop()
        if it.subtreeDepth() == 0:
            rows.append((node, None, None, None, None, None, None, it.prediction(), it.impurity()))
            continue
        split, low, high = it.split(), 2 * node + 1, 2 * node + 2
        continuous = split.getClass().getSimpleName() == "ContinuousSplit"
        threshold = split.threshold() if continuous else None
        left = None if continuous else sorted(split.leftCategories())
        rows.append((node, split.featureIndex(), threshold, left, low, high, it.gain(), it.prediction(), it.impurity()))
        waiting += [(low, it.leftChild()), (high, it.rightChild())]
    schema = (
        "node LONG, feature INT, threshold DOUBLE, left_categories ARRAY<DOUBLE>, low LONG, high LONG,"
        " gain DOUBLE, prediction DOUBLE, impurity DOUBLE"
    )
    return session.createDataFrame(rows, schema)


def score_by_nodes(rows: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``rows`` with the ``prediction`` of a node table, level by level through joins.

    The nodes are broadcast; they come from a model, which is in the driver's memory.
    """
    table = write_table(nodes)
    last = table.agg(F.max("node")).first()[0]
    depth = (last + 1).bit_length() - 1
    columns = rows.columns
    values = F.array(*[F.col(c).cast("double") for c in features])
    at = rows.withColumns({"_node": F.lit(0).cast("long"), "_values": values})
    small = F.broadcast(table.select(F.col("node").alias("_node"), "feature", "threshold", "left_categories", "low", "high"))
    for _ in range(depth):
        met = at.join(small, "_node")
        value = F.get(F.col("_values"), F.col("feature"))
        goes_low = F.coalesce(value <= F.col("threshold"), F.array_contains("left_categories", value))
        following = F.when(F.col("feature").isNull(), F.col("_node")).when(goes_low, F.col("low")).otherwise(F.col("high"))
        at = met.select(*columns, "_values", following.alias("_next")).withColumnRenamed("_next", "_node")
    leaves = F.broadcast(table.select(F.col("node").alias("_node"), F.col("prediction").alias("_prediction")))
    return at.join(leaves, "_node").select(*columns, F.col("_prediction").alias("prediction"))
