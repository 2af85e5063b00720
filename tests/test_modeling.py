import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from quarrystone.operators import modeling, splitting
from quarrystone.operators.prescriptive import scenario_analysis

SMALL = {"random_forest": {"numTrees": 10, "maxDepth": 5}, "gradient_boosting": {"maxIter": 5}}


@pytest.fixture(scope="module")
def classes_df(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, 200), rng.normal(6, 1, 200)]
    return spark.createDataFrame([(float(v), int(i >= 200)) for i, v in enumerate(x)], "x double, label int")


def test_split_features_target(regression_df):
    parts = splitting.split_features_target(regression_df, "y", drop=["x2"])
    assert parts.X.columns == ["x1", "group"] and parts.y.columns == ["y"]
    with pytest.raises(ValueError, match="Unknown column"):
        splitting.split_features_target(regression_df, "nope")


@pytest.mark.parametrize("key", [None, ["x1", "x2"]])
def test_split_is_exact_disjoint_and_repeatable(regression_df, key):
    train, test = splitting.train_test(regression_df, test_size=0.25, random_state=7, key=key)
    assert (train.count(), test.count()) == (150, 50)
    assert train.intersect(test).count() == 0
    again = splitting.train_test(regression_df.repartition(7), test_size=0.25, random_state=7, key=key)[1]
    assert {r["y"] for r in again.collect()} == {r["y"] for r in test.collect()}
    other = splitting.train_test(regression_df, test_size=0.25, random_state=8, key=key)[1]
    assert {r["y"] for r in other.collect()} != {r["y"] for r in test.collect()}


def test_split_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(splitting, "BUCKET_ROWS", 10)
    train, test = splitting.train_test(spark.range(1000), test_size=0.3, key="id")
    assert (train.count(), test.count()) == (700, 300) and train.intersect(test).count() == 0


def test_stratified_split_keeps_proportions(spark):
    df = spark.range(101).select("id", F.when(F.col("id") < 71, "a").when(F.col("id") < 92, "b").otherwise("c").alias("k"))
    train, test = splitting.train_test(df, test_size=0.2, stratify="k", key="id")
    assert test.count() == 21 and train.count() == 80
    sizes = {r["k"]: r["count"] for r in test.groupBy("k").count().collect()}
    assert sizes == {"a": 15, "b": 4, "c": 2}
    with pytest.raises(ValueError, match="two rows"):
        splitting.train_test(df.where("id > 99 or id < 3"), stratify="k", key="id")


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_split_of_identical_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(splitting, "CHUNK", chunk)
    df = spark.range(90).select(F.when(F.col("id") < 60, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    train, test = splitting.train_test(df, test_size=0.3)
    assert (train.count(), test.count()) == (63, 27)
    together = train.union(test).groupBy("k").count().where("k = 'hot'").first()
    assert together["count"] == 60


def test_split_rejects_bad_sizes(regression_df):
    with pytest.raises(ValueError, match="test_size"):
        splitting.train_test(regression_df, test_size=1.5)


def test_folds_are_contiguous(spark):
    rows = splitting.assign_folds(spark.range(23), cv=5, order_by="id").orderBy("id").collect()
    sizes = [5, 5, 5, 4, 4]
    assert [r["fold"] for r in rows] == [f for f, n in enumerate(sizes) for _ in range(n)]


def test_stratified_folds_are_even(spark):
    df = spark.range(40).select("id", (F.col("id") % 3).alias("k"))
    folds = splitting.assign_folds(df, cv=4, order_by="id", label="k")
    assert {r["count"] for r in folds.groupBy("fold").count().collect()} == {10}
    per_class = folds.groupBy("k", "fold").count().collect()
    assert {r["count"] for r in per_class} <= {3, 4} and len(per_class) == 12


def test_preparation_imputes_scales_and_encodes(spark):
    df = spark.createDataFrame(
        [(1.0, "u", True), (None, "v", False), (3.0, None, None), (8.0, "u", True)], "n double, c string, b boolean"
    )
    fitted = modeling.build_preprocessor(df).fit(df)
    out = fitted.transform(df).collect()
    filled = np.array([1.0, 3.0, 3.0, 8.0])
    assert [r["numeric__n"] for r in out] == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert [list(r["features"].toArray())[1:] for r in out] == [[1, 0, 0, 1], [0, 1, 1, 0], [1, 0, 0, 1], [1, 0, 0, 1]]
    new = spark.createDataFrame([(0.0, "w'\\", True)], "n double, c string, b boolean")
    assert list(fitted.transform(new).first()["features"].toArray())[1:] == [0, 0, 0, 1]
    with pytest.raises(ValueError, match="numeric_strategy"):
        modeling.build_preprocessor(df, numeric_strategy="zero")


@pytest.mark.parametrize("model", ["linear", "random_forest", "gradient_boosting"])
def test_train_regressor(regression_df, model):
    result = modeling.train_regressor(regression_df, "y", model=model, params=SMALL.get(model))
    metrics = result["metrics"].first()
    assert result["predictions"].count() == 40
    assert metrics["r2"] > (0.8 if model == "linear" else 0.5) and metrics["rmse"] >= metrics["mae"] > 0
    table = modeling.get_feature_importance(result)
    assert table.first()["feature"] == "numeric__x1"
    assert {r["feature"] for r in table.collect()} >= {"categorical__group_A", "categorical__group_B"}


def test_regression_metrics_agree_with_spark(regression_df):
    from pyspark.ml.evaluation import RegressionEvaluator

    predictions = modeling.train_regressor(regression_df, "y", model="linear")["predictions"]
    ours = modeling.regression_metrics(predictions, label="y").first()
    for name in ("r2", "mae", "rmse"):
        theirs = RegressionEvaluator(labelCol="y", metricName=name).evaluate(predictions)
        assert ours[name] == pytest.approx(theirs, abs=1e-4)


@pytest.mark.parametrize("model", ["logistic", "random_forest", "gradient_boosting"])
def test_train_classifier(classes_df, model):
    result = modeling.train_classifier(classes_df, "label", model=model, params=SMALL.get(model))
    assert result["metrics"].first()["accuracy"] > 0.9
    cells = result["confusion_matrix"].collect()
    assert len(cells) == 4 and sum(r["count"] for r in cells) == 80
    unlabelled = classes_df.select("x").limit(1)
    assert result["pipeline"].transform(unlabelled).first()["predicted_label"] in ("0", "1")


def test_boosted_classifier_with_three_classes(spark):
    rows = [(float(10 * (i % 3) + i / 100), "abc"[i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "x double, k string")
    result = modeling.train_classifier(df, "k", model="gradient_boosting", params={"maxIter": 2})
    assert result["metrics"].first()["accuracy"] == 1.0


def test_classification_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "y string, p string")
    row = modeling.classification_metrics(df, label="y", prediction="p").first()
    assert tuple(row) == pytest.approx((0.5, 0.375, 0.5, 0.4167), abs=1e-4)


def test_unknown_models(regression_df):
    with pytest.raises(ValueError, match="regression"):
        modeling.train_regressor(regression_df, "y", model="magic")
    with pytest.raises(ValueError, match="classification"):
        modeling.train_classifier(regression_df, "group", model="magic")


def test_kmeans(spark):
    rng = np.random.default_rng(2)
    points = np.r_[rng.normal(0, 0.5, (50, 2)), rng.normal(10, 0.5, (50, 2))]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in points], "f1 double, f2 double")
    result = modeling.cluster_kmeans(df, n_clusters=2)
    labels = [r["cluster"] for r in result["labels"].collect()]
    assert len(labels) == 100 and len(set(labels)) == 2
    assert result["silhouette_squared_euclidean"] > 0.7 and result["inertia"] > 0
    one = modeling.cluster_kmeans(df, n_clusters=1)
    assert one["silhouette_squared_euclidean"] is None and one["inertia"] == pytest.approx(200.0)
    assert {r["cluster"] for r in one["labels"].collect()} == {0}


def test_cross_validation(regression_df):
    stages = modeling.build_model_pipeline(
        modeling.regressor("linear", "y", 42), modeling.build_preprocessor(regression_df, ["x1", "x2", "group"])
    )
    result = modeling.cross_validate(stages, regression_df, "y", cv=3, order_by=["x2"])
    assert len(result["scores"]) == 3 and result["mean"] > 0.8 and result["std"] >= 0
    with pytest.raises(ValueError, match="scoring"):
        modeling.cross_validate(stages, regression_df, "y", cv=3, order_by=["x2"], scoring="luck")


def test_saved_models_predict_the_same(regression_df, tmp_path):
    result = modeling.train_regressor(regression_df, "y", model="linear")
    again = modeling.load_model(modeling.save_model(result["pipeline"], str(tmp_path / "model")))
    plain = regression_df.orderBy("x1")
    before = [r["prediction"] for r in result["pipeline"].transform(plain).collect()]
    assert [r["prediction"] for r in again.transform(plain).collect()] == before


def test_other_estimators_and_scenarios(regression_df):
    stages = modeling.build_model_pipeline(
        DecisionTreeRegressor(labelCol="y"), modeling.build_preprocessor(regression_df, ["x1", "group"])
    )
    fitted = modeling.fit(stages, regression_df)
    sweep = scenario_analysis(fitted, regression_df.limit(1), variable="x1", values=[30.0, 50.0, 70.0])
    got = [r["prediction"] for r in sweep.orderBy("x1").collect()]
    assert got == sorted(got) and got[0] < got[-1]


def _copied(spark, copies):
    """A few distinct rows, each many times, with keys of their own."""
    kinds = spark.range(12).select(F.col("id").alias("kind"), (F.col("id") % 4).cast("double").alias("a"),
                                   F.when(F.col("id") < 6, "low").otherwise("high").alias("b"))
    rows = kinds.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("kind").cast("int") % 3 * copies + copies)))
    return rows.select((F.col("kind") * 100_000 + F.col("copy")).alias("key"), "a", "b",
                       (F.col("a") * 3 + F.when(F.col("b") == "low", 5.0).otherwise(0.0)).alias("y"))


@pytest.mark.parametrize("model, most", [("gradient_boosting", 12), ("random_forest", 12 * 50)])
def test_trees_learn_from_distinct_rows_and_their_number(spark, monkeypatch, model, most):
    monkeypatch.setattr(modeling, "DRAWN", 50)
    df, seen = _copied(spark, 100), []
    counted = modeling._counted

    def watched(*args):
        seen.append(counted(*args))
        return seen[-1]

    monkeypatch.setattr(modeling, "_counted", watched)
    result = modeling.train_regressor(df, "y", model=model, drop=["key"], key="key", params=SMALL[model])
    assert seen[0].count() <= most
    train = df.count() - result["predictions"].count()
    assert abs(seen[0].agg(F.sum(modeling.WEIGHT)).first()[0] - train) < 1e-6


def test_boosting_on_counted_rows_is_boosting_on_all(spark):
    df = _copied(spark, 20)
    own = modeling.train_regressor(df, "y", model="gradient_boosting", drop=["key"], key="key", params={"maxIter": 5})
    # A setting that reads all rows, at its default.
    rows = modeling.train_regressor(
        df, "y", model="gradient_boosting", drop=["key"], key="key", params={"maxIter": 5, "minInstancesPerNode": 1}
    )
    both = own["predictions"].select("key", F.col("prediction").alias("p")).join(rows["predictions"], "key")
    assert both.count() == own["predictions"].count()
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9
