import numpy as np
import pytest

from quarrystone.operators import charts
from quarrystone.plans import kernels


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(6)
    v, w, g = rng.normal(10, 3, 400), rng.random(400), rng.choice(["a", "b"], 400)
    rows = [(float(x), float(y), str(k)) for x, y, k in zip(v, w, g)] + [(None, 1.0, "a"), (2.0, None, None)]
    return np.r_[v, 2.0], spark.createDataFrame(rows, "v double, w double, g string")


def test_histogram_equals_numpy(numbers):
    v, df = numbers
    counts, edges = np.histogram(v, bins=30)
    rows = charts.histogram_bins(df, "v").collect()
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    rows = charts.histogram_bins(df, "v", bins=4).collect()
    assert [r["count"] for r in rows] == np.histogram([5.0] * 4, bins=4)[0].tolist()
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (4.5, 5.5)


def test_automatic_bins_equal_numpy(numbers):
    v, df = numbers
    tables = charts.distribution(df, "v")
    assert [r["count"] for r in tables["histogram"].collect()] == np.histogram(v, bins="auto")[0].tolist()
    curve = tables["curve"].toPandas()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = curve["x"].to_numpy()
    expected = np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert len(x) == 200 and np.allclose(curve["density"], expected)


def test_box_and_outliers(numbers):
    v, df = numbers
    row = charts.box_stats(df, y="v").first()
    q1, q3 = np.quantile(v, [0.25, 0.75])
    inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
    assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
    assert row["n_outliers"] == len(v) - len(inside)
    assert charts.box_outliers(df, y="v").count() == row["n_outliers"]
    groups = charts.box_stats(df, y="v", x="g").collect()
    assert {r["g"] for r in groups} == {"a", "b"}


def test_violin(numbers):
    _, df = numbers
    tables = charts.violin_stats(df, y="v", x="g")
    assert tables["boxes"].count() == 2 and tables["curves"].count() == 200


def test_counts_scatter_pairs_patterns(numbers):
    v, df = numbers
    assert [r["g"] for r in charts.category_counts(df, "g", top_n=1).collect()] in (["a"], ["b"])
    cells = charts.scatter_grid(df, x="v", y="w", hue="g", bins=10).toPandas()
    assert cells["count"].sum() == 400 and cells["x_bin"].max() == 9
    pairs = charts.pair_grid(df, hue="g", bins=5).toPandas()
    assert pairs.loc[(pairs.feature_x == "v") & (pairs.feature_y == "v"), "count"].sum() == len(v)
    assert pairs.loc[(pairs.feature_x == "v") & (pairs.feature_y == "w"), "count"].sum() == 400
    patterns = [(r["pattern"], r["count"]) for r in charts.missing_patterns(df).collect()]
    assert patterns == [("000", 400), ("011", 1), ("100", 1)]


def test_series_and_importances(spark, clean_df):
    bars = charts.category_series(clean_df, x="region", y="sales")
    assert bars.columns == ["region", "sales"] and bars.count() == 6
    assert [r["sales"] for r in charts.line_series(clean_df, x="sales", y="cost").collect()][0] == 50.0
    table = spark.createDataFrame([("a", 0.5), ("c", 0.2), ("b", 0.3)], "feature string, importance double")
    assert [r["feature"] for r in charts.top_importances(table, top_n=3).collect()] == ["a", "b", "c"]


def test_bad_arguments(clean_df):
    with pytest.raises(ValueError, match="numeric"):
        charts.histogram_bins(clean_df, "region")
    with pytest.raises(ValueError, match="bins"):
        charts.histogram_bins(clean_df, "sales", bins=0)


@pytest.mark.parametrize("held", [10_000, 1])
def test_kernel_sums_of_many_batches(spark, monkeypatch, held):
    monkeypatch.setattr(kernels, "HELD_GROUPS", held)
    rng = np.random.default_rng(6)
    values = np.r_[rng.normal(0, 1, 3000), rng.normal(40, 0.2, 500), [7.0] * 700]  # tight, far apart, one hot value
    rows = [("a" if k % 2 else None, float(v)) for k, v in enumerate(values)] + [("b", 1.0), ("b", 1.0), ("c", 3.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    curve = charts.density_curve(df, "v", group_by=["k"], points=150, cut=1.0).toPandas()
    assert set(curve["k"].unique()) == {"a", None}  # no spread, no curve
    for key, own in (("a", values[1::2]), (None, values[0::2])):
        got = curve[curve["k"].isna() if key is None else curve["k"] == key].sort_values("x")
        h = own.std(ddof=1) * len(own) ** -0.2
        x = np.linspace(own.min() - h, own.max() + h, 150)
        plain = np.exp(-0.5 * ((x[:, None] - own) / h) ** 2).sum(1) / (len(own) * h * np.sqrt(2 * np.pi))
        assert np.allclose(got["x"], x) and np.allclose(got["density"], plain, rtol=1e-12, atol=1e-15)
    plan = charts.density_curve(df, "v", points=150)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # of the sums of a task, not of its values


def test_kernel_sums_reach():
    values = np.random.default_rng(1).uniform(0, 1000, 4000)
    found = kernels.kernel_sums(values, -5.0, 5.1, 0.7, 200)
    x = -5.0 + 5.1 * np.arange(200)
    plain = np.exp(-0.5 * ((x[:, None] - values) / 0.7) ** 2).sum(1)
    assert np.abs(found - plain).max() <= 4000 * 3e-16
    assert kernels.kernel_sums(values[:0], 0.0, 1.0, 1.0, 3).tolist() == [0, 0, 0]
