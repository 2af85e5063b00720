"""Preparation, training, evaluation and persistence of ``pyspark.ml`` models."""

from __future__ import annotations

import statistics
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.stat import Summarizer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    boolean_columns,
    number,
    numeric_columns,
    ref,
    require,
    require_numeric,
    rounded,
    text_columns,
)
from ..plans.quantiles import exact_quantiles
from ..plans.scratch import written
from .cleansing import _modes
from .splitting import assign_folds, split_features_target, train_test

IMPUTATIONS = ("median", "mean", "most_frequent")
FEATURES = "features"
LABEL = "label_index"
# Tree depth unless the caller sets maxDepth; Spark's own limit is 30.
FOREST = {"numTrees": 100, "maxDepth": 12}
BOOSTED = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}
# Models that read the training rows many times; they learn from distinct rows and how often each occurs.
TREES = ("random_forest", "gradient_boosting")
# With these settings a row is not the same as its copies, so all rows are read.
BY_ROW = ("weightCol", "subsamplingRate", "minInstancesPerNode", "validationIndicatorCol")
WEIGHT = "__row_weight"
# Rows of a forest that stand for the copies of one: each is drawn on its own for each tree.
DRAWN = 1_000


# ---------------------------------------------------------------- preparation


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value) -> str:
    # The statement is parsed again by Spark, so quotes and backslashes are escaped.
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class PrepareColumns(Estimator):
    """Learn exact surrogates and population scaling from the training rows.

    Fitting gives a ``SQLTransformer``: missing numbers become the surrogate, scaled
    numbers are ``numeric__<name>``, and categories (text and booleans, missing ones as
    the most frequent) ``category__<name>``.  A numeric column without any value is left
    out.  As a built-in stage the result is saved and loaded without this package.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], strategy: str, scale: bool):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.strategy, self.scale = strategy, scale

    def _surrogates(self, df: DataFrame) -> dict:
        names = self.numeric
        if not names:
            return {}
        if self.strategy == "mean":
            row = df.agg(*[F.avg(number(df, c)) for c in names]).first()
        elif self.strategy == "median":
            row = [q[0] if q else None for q in exact_quantiles(df, names, [0.5]).first()]
        else:
            row = self._most_frequent(df, names)
        return {c: float(v) for c, v in zip(names, row) if v is not None}

    @staticmethod
    def _most_frequent(df: DataFrame, names: Sequence[str]) -> list:
        modes = _modes(df, names)
        one = df.sparkSession.range(1)
        return list(one.select(*[modes[c].alias(f"m{i}") for i, c in enumerate(names)]).first())

    def _fit(self, df: DataFrame) -> SQLTransformer:
        fills = self._surrogates(df)
        terms = []
        scales = {c: (0.0, 1.0) for c in fills}
        if self.scale and fills:
            imputed = {c: F.coalesce(number(df, c), F.lit(v)) for c, v in fills.items()}
            moments = df.agg(
                *[f(x).alias(f"{side}{i}") for i, x in enumerate(imputed.values()) for side, f in (("m", F.avg), ("s", F.stddev_pop))]
            ).first()
            scales = {c: (moments[f"m{i}"], moments[f"s{i}"] or 1.0) for i, c in enumerate(fills)}
        for c, fill in fills.items():
            mean, sd = scales[c]
            plain = f"CAST({_quoted(c)} AS DOUBLE)"
            known = f"COALESCE(CASE WHEN isnan({plain}) THEN NULL ELSE {plain} END, {fill!r}D)"
            terms.append(f"({known} - {mean!r}D) / {sd!r}D AS {_quoted('numeric__' + c)}")
        as_text = df.select(*[ref(c).cast("string").alias(c) for c in self.categorical])
        if self.categorical:
            for c, mode in zip(self.categorical, self._most_frequent(as_text, self.categorical)):
                known = f"COALESCE(CAST({_quoted(c)} AS STRING), {_text(mode if mode is not None else '')})"
                terms.append(f"{known} AS {_quoted('category__' + c)}")
        return SQLTransformer(statement=f"SELECT {', '.join(['*', *terms])} FROM __THIS__")


class EncodeColumns(Estimator):
    """One-hot encode the prepared categories and assemble ``features``.

    Numbers come first.  A category unseen in training encodes as all zeros.
    """

    def _fit(self, df: DataFrame) -> PipelineModel:
        numbers = [c for c in df.columns if c.startswith("numeric__")]
        names = [c for c in df.columns if c.startswith("category__")]
        coded = [c.replace("category__", "categorical__", 1) for c in names]
        stages: list = []
        if names:
            codes = [f"{c}__code" for c in names]
            stages.append(
                StringIndexer(inputCols=names, outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep")
            )
            # The extra index for unseen values is the last one, which is dropped.
            stages.append(OneHotEncoder(inputCols=codes, outputCols=coded, dropLast=True))
        stages.append(VectorAssembler(inputCols=[*numbers, *coded], outputCol=FEATURES))
        return Pipeline(stages=stages).fit(df)


def build_preprocessor(
    df: DataFrame, features: Sequence[str] | None = None, *, numeric_strategy: str = "median", scale: bool = True
) -> Pipeline:
    """Unfitted stages from raw columns to ``features``; other column classes are left out."""
    if numeric_strategy not in IMPUTATIONS:
        raise ValueError(f"numeric_strategy must be one of {IMPUTATIONS}, not {numeric_strategy!r}")
    names = require(df, features) if features is not None else df.columns
    numeric = [c for c in names if c in numeric_columns(df)]
    classes = {*text_columns(df), *boolean_columns(df)}
    categorical = [c for c in names if c in classes]
    if not numeric and not categorical:
        raise ValueError("No numeric or categorical feature to model with")
    return Pipeline(stages=[PrepareColumns(numeric, categorical, numeric_strategy, scale), EncodeColumns()])


def build_model_pipeline(estimator: Estimator, preprocessor: Pipeline) -> Pipeline:
    """Preparation, then the model; fitting uses the training rows only."""
    return Pipeline(stages=[*preprocessor.getStages(), estimator])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(train)


def save_model(model: Model, path: str) -> str:
    """Write a fitted model (replacing one at the same path) and return the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- evaluation


def regression_metrics(df: DataFrame, *, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``r2, mae, rmse`` at four digits."""
    y, p = number(df, require_numeric(df, label)), number(df, require_numeric(df, prediction))
    sums = df.agg(
        F.avg((y - p) ** 2).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("spread")
    )
    return sums.select(
        rounded(1 - F.try_divide(F.col("mse"), F.col("spread")), 4).alias("r2"),
        rounded(F.col("mae"), 4).alias("mae"),
        rounded(F.sqrt("mse"), 4).alias("rmse"),
    )


def classification_metrics(df: DataFrame, *, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and precision, recall and F1 weighted by class size, at four digits.

    A class that is never predicted has precision 0.
    """
    cells = _cells(df, label, prediction)
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    # One pass over the few cells: a cell counts for its true and for its guessed class.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("class"), F.col("n").alias("is"), F.lit(0).alias("said"), hit.alias("hit")),
                F.struct(F.col("guess").alias("class"), F.lit(0).alias("is"), F.col("n").alias("said"), F.lit(0).alias("hit")),
            )
        ).alias("c")
    ).select("c.*")
    classes = sides.groupBy("class").agg(F.sum("is").alias("is"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    hits, size = F.col("hit").cast("double"), F.col("is").cast("double")
    precision = F.coalesce(F.try_divide(hits, F.col("said")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(hits, size), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(metric):
        return rounded(F.try_divide(F.sum(metric * size), F.sum(size)), 4)

    return classes.agg(
        rounded(F.try_divide(F.sum(hits), F.sum(size)), 4).alias("accuracy"),
        weighted(precision).alias("precision_weighted"),
        weighted(recall).alias("recall_weighted"),
        weighted(f1).alias("f1_weighted"),
    )


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    require(df, [label, prediction])
    pairs = df.select(ref(label).cast("string").alias("truth"), ref(prediction).cast("string").alias("guess"))
    return pairs.na.drop().groupBy("truth", "guess").agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, *, label: str, prediction: str = "prediction", zeros: bool = True
) -> DataFrame:
    """Counts by ``true`` and ``predicted`` class over all classes seen.

    Long form; classes are compared as text, so both columns should spell them alike.
    With ``zeros`` every class meets every other, which squares the number of classes;
    without, only the cells that occur are there.
    """
    cells = _cells(df, label, prediction)
    counts = cells.select(F.col("truth").alias("true"), F.col("guess").alias("predicted"), "n")
    if not zeros:
        return counts.withColumnRenamed("n", "count").orderBy("true", "predicted")
    classes = cells.select(F.explode(F.array("truth", "guess")).alias("true")).distinct()
    # The list is the root of the rows asked for.
    listed = classes.agg(F.sort_array(F.collect_set("true"))).scalar()
    grid = classes.withColumn("predicted", F.explode(listed))
    return grid.join(counts, ["true", "predicted"], "left").select(
        "true", "predicted", F.coalesce("n", F.lit(0)).alias("count")
    ).orderBy("true", "predicted")


SCORES = {
    "r2": (regression_metrics, "r2", 1),
    "neg_mean_absolute_error": (regression_metrics, "mae", -1),
    "neg_root_mean_squared_error": (regression_metrics, "rmse", -1),
    "accuracy": (classification_metrics, "accuracy", 1),
    "precision_weighted": (classification_metrics, "precision_weighted", 1),
    "recall_weighted": (classification_metrics, "recall_weighted", 1),
    "f1_weighted": (classification_metrics, "f1_weighted", 1),
}


def cross_validate(
    pipeline: Pipeline,
    df: DataFrame,
    target: str,
    *,
    order_by: str | Sequence[str],
    cv: int = 5,
    scoring: str = "r2",
    prediction: str = "prediction",
) -> dict:
    """``scores`` per fold, their ``mean`` and population ``std`` at four digits.

    Folds are contiguous in ``order_by``, and per class for classification scores.
    """
    if scoring not in SCORES:
        raise ValueError(f"Unknown scoring {scoring!r}; choose one of {list(SCORES)}")
    metrics, name, sign = SCORES[scoring]
    by_class = target if metrics is classification_metrics else None
    folded = assign_folds(df, cv=cv, order_by=order_by, label=by_class)
    if by_class is not None:
        folded = written(folded)  # read once per fold and fitting stage
    scores = []
    for k in range(cv):
        model = pipeline.fit(folded.where(F.col("fold") != k).drop("fold"))
        scored = model.transform(folded.where(F.col("fold") == k).drop("fold"))
        scores.append(sign * metrics(scored, label=target, prediction=prediction).first()[name])
    return {"scores": scores, "mean": round(statistics.fmean(scores), 4), "std": round(statistics.pstdev(scores), 4)}


# ---------------------------------------------------------------- training


def _counted(train: DataFrame, preparation: Pipeline, target: str, model: str) -> DataFrame:
    """The distinct training rows, as far as the model sees them, with ``__row_weight``: the copies each stands for.

    Boosting sums over the rows, so that a weight is as good as copies.  A forest draws rows, so up to
    ``DRAWN`` copies stay rows of their own and more share their weight evenly among so many.
    """
    seen = preparation.getStages()[0]
    columns = list(dict.fromkeys([*seen.numeric, *seen.categorical, target]))
    counted = train.groupBy(*[ref(c) for c in columns]).agg(F.count("*").cast("double").alias(WEIGHT))
    if model == "random_forest":
        kept = F.least(F.col(WEIGHT), F.lit(float(DRAWN)))
        each = F.explode(F.sequence(F.lit(1), kept.cast("int"))).alias("__copy")
        counted = counted.select(*[ref(c) for c in columns], (F.col(WEIGHT) / kept).alias(WEIGHT), each).drop("__copy")
    return written(counted.repartition(train.sparkSession.sparkContext.defaultParallelism))


def regressor(model: str, target: str, seed: int, params: Mapping | None = None) -> Estimator:
    columns = {"featuresCol": FEATURES, "labelCol": target}
    extra = dict(params or {})
    if model == "linear":
        return LinearRegression(**columns, **({"regParam": 0.0} | extra))
    if model == "random_forest":
        return RandomForestRegressor(**columns, seed=seed, **(FOREST | {"featureSubsetStrategy": "all"} | extra))
    if model == "gradient_boosting":
        return GBTRegressor(**columns, seed=seed, **(BOOSTED | extra))
    raise ValueError(f"{model!r} names none of the regression models")


def classifier(model: str, rows: int, classes: int, seed: int, params: Mapping | None = None) -> Estimator:
    columns = {"featuresCol": FEATURES, "labelCol": LABEL}
    extra = dict(params or {})
    if model == "logistic":
        # The penalty of the usual C = 1, which Spark scales by the number of rows.
        ridge = {"maxIter": 1000, "regParam": 1.0 / max(rows, 1), "standardization": False}
        return LogisticRegression(**columns, **(ridge | extra))
    if model == "random_forest":
        return RandomForestClassifier(**columns, seed=seed, **(FOREST | extra))
    if model == "gradient_boosting":
        boosted = GBTClassifier(**columns, seed=seed, **(BOOSTED | extra))
        return boosted if classes <= 2 else OneVsRest(classifier=boosted, **columns)
    raise ValueError(f"{model!r} names none of the classification models")


REGRESSORS = ("linear", "random_forest", "gradient_boosting")
CLASSIFIERS = ("logistic", "random_forest", "gradient_boosting")


def train_regressor(
    df: DataFrame,
    target: str,
    *,
    model: str = "random_forest",
    test_size: float = 0.2,
    random_state: int = 42,
    drop: Sequence[str] | None = None,
    key: str | Sequence[str] | None = None,
    order_hash: Column | None = None,
    params: Mapping | None = None,
) -> dict:
    """Split, prepare, fit and score a regression.

    Returns ``pipeline`` (fitted), ``metrics`` (one row), and ``predictions``, the test
    rows with ``prediction``.  ``key`` identifies rows for the split, which ``order_hash`` may
    order; list it in ``drop`` unless it is a feature as well.
    """
    if model not in REGRESSORS:
        raise ValueError(f"{model!r} names none of the regression models")
    parts = split_features_target(df, target, drop=drop)
    train, test = train_test(df, test_size=test_size, random_state=random_state, key=key, order_hash=order_hash)
    train = written(train)  # every fitting stage scans it
    estimator = regressor(model, target, random_state, params)
    preparation = build_preprocessor(df, parts.features)
    if model in TREES and not {*BY_ROW} & {*(params or {})}:
        prepared = preparation.fit(train)
        learned = estimator.copy({estimator.weightCol: WEIGHT}).fit(
            prepared.transform(_counted(train, preparation, target, model))
        )
        fitted = PipelineModel([*prepared.stages, learned])
    else:
        fitted = build_model_pipeline(estimator, preparation).fit(train)
    predictions = fitted.transform(test)
    return {
        "pipeline": fitted,
        "metrics": regression_metrics(predictions, label=target),
        "predictions": predictions,
    }


def train_classifier(
    df: DataFrame,
    target: str,
    *,
    model: str = "random_forest",
    test_size: float = 0.2,
    random_state: int = 42,
    drop: Sequence[str] | None = None,
    key: str | Sequence[str] | None = None,
    order_hash: Column | None = None,
    params: Mapping | None = None,
) -> dict:
    """Like :func:`train_regressor`, split by class, for a categorical target.

    ``predictions`` carries ``predicted_label``; ``confusion_matrix`` is in long form.
    """
    if model not in CLASSIFIERS:
        raise ValueError(f"{model!r} names none of the classification models")
    parts = split_features_target(df, target, drop=drop)
    train, test = train_test(
        df, test_size=test_size, random_state=random_state, stratify=target, key=key, order_hash=order_hash
    )
    train = written(train)  # every fitting stage scans it
    sizes = train.agg(F.count("*").alias("n"), F.count_distinct(ref(target)).alias("k")).first()
    indexer = StringIndexer(inputCol=target, outputCol=LABEL, stringOrderType="alphabetAsc").fit(df)
    estimator = classifier(model, sizes["n"], sizes["k"], random_state, params)
    preparation = build_preprocessor(df, parts.features)
    prepared = preparation.fit(train)
    if model in TREES and not {*BY_ROW} & {*(params or {})}:
        rows, estimator = _counted(train, preparation, target, model), estimator.copy({estimator.weightCol: WEIGHT})
    else:
        rows = train
    learned = estimator.fit(indexer.transform(prepared.transform(rows)))
    # New rows have no target, so the fitted pipeline leaves its indexer out.
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer.labels)
    pipeline = PipelineModel([*prepared.stages, learned, back])
    predictions = pipeline.transform(test)
    return {
        "pipeline": pipeline,
        "metrics": classification_metrics(predictions, label=target, prediction="predicted_label"),
        "confusion_matrix": confusion_matrix(predictions, label=target, prediction="predicted_label"),
        "predictions": predictions,
    }


def cluster_kmeans(
    df: DataFrame, *, n_clusters: int = 3, features: Sequence[str] | None = None, random_state: int = 42
) -> dict:
    """Standardise, then k-means over the rows without gaps.

    ``labels`` is the table with ``cluster``; ``inertia`` the within-cluster sum of
    squares; ``silhouette_squared_euclidean`` Spark's silhouette, which averages squared
    distances so that it needs no pairs of rows (None unless 1 < clusters < rows).
    """
    names = [require_numeric(df, c) for c in features] if features is not None else numeric_columns(df)
    complete = df.na.drop("any", subset=names)
    prepared = Pipeline(stages=[PrepareColumns(names, [], "mean", True), EncodeColumns()]).fit(complete)
    scaled = prepared.transform(complete)
    if n_clusters == 1:
        return _one_cluster(df, prepared, scaled)
    kmeans = KMeans(featuresCol=FEATURES, predictionCol="cluster", k=n_clusters, seed=random_state, maxIter=300, tol=1e-4)
    model = kmeans.fit(scaled)
    labelled = model.transform(scaled)
    silhouette = None
    if 1 < n_clusters < complete.count():
        evaluator = ClusteringEvaluator(featuresCol=FEATURES, predictionCol="cluster")
        silhouette = round(evaluator.evaluate(labelled), 4)
    return {
        "labels": labelled.select(*[ref(c) for c in df.columns], "cluster"),
        "model": PipelineModel([*prepared.stages, model]),
        "inertia": round(model.summary.trainingCost, 4),
        "silhouette_squared_euclidean": silhouette,
    }


def _one_cluster(df: DataFrame, prepared: PipelineModel, scaled: DataFrame) -> dict:
    """Everything in one cluster, which Spark's k-means does not accept: squares around the mean."""
    spread = scaled.agg(F.count("*").alias("n"), Summarizer.variance(F.col(FEATURES)).alias("v")).first()
    inertia = float(spread["v"].toArray().sum()) * (spread["n"] - 1) if spread["n"] else 0.0
    return {
        "labels": scaled.select(*[ref(c) for c in df.columns], F.lit(0).alias("cluster")),
        "model": prepared,
        "inertia": round(inertia, 4),
        "silhouette_squared_euclidean": None,
    }


def get_feature_importance(result: Mapping) -> DataFrame | None:
    """``feature, importance`` of a training result, largest first; None if the model has none.

    Tree importances, or absolute coefficients (averaged over the classes).  Features
    are named after preparation: ``numeric__<name>``, ``categorical__<name>_<value>``.
    """
    predictions = result["predictions"]
    model = next((s for s in result["pipeline"].stages if _weights(s) is not None), None)
    if model is None:
        return None
    groups = predictions.schema[FEATURES].metadata["ml_attr"]["attrs"].values()
    names = {a["idx"]: a["name"] for group in groups for a in group}
    rows = [(names[i], float(w)) for i, w in enumerate(_weights(model))]
    table = predictions.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def _weights(stage):
    if hasattr(stage, "featureImportances"):
        return stage.featureImportances.toArray()
    if hasattr(stage, "coefficientMatrix"):
        return abs(stage.coefficientMatrix.toArray()).mean(axis=0)
    if hasattr(stage, "coefficients"):
        return abs(stage.coefficients.toArray())
    return None
