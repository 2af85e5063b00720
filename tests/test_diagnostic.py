import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.functions import pvalues
from quarrystone.operators import correlation, diagnostic


def test_correlation_with_target(clean_df):
    rows = correlation.correlation_with_target(clean_df, "profit").collect()
    assert {r["feature"] for r in rows} == {"sales", "cost"}
    with pytest.raises(ValueError, match="numeric"):
        correlation.correlation_with_target(clean_df, "region")


def test_group_comparison_is_sorted_by_mean(spark, clean_df):
    rows = diagnostic.group_comparison(clean_df, group_column="region", value_column="sales").collect()
    assert [r["region"] for r in rows] == ["South", "East", "North"]
    assert rows[0]["std"] == pytest.approx(35.3553)
    df = spark.createDataFrame([("a", None), (None, 1.0)], "g string, v double")
    rows = diagnostic.group_comparison(df, group_column="g", value_column="v").collect()
    assert [(r["g"], r["count"], r["mean"]) for r in rows] == [(None, 1, 1.0), ("a", 0, None)]


def test_ttest_finds_a_clear_difference(spark):
    rows = [("A", i) for i in range(20)] + [("B", i) for i in range(100, 120)] + [("C", None)]
    df = spark.createDataFrame(rows, "grp string, val bigint")
    row = diagnostic.ttest_two_groups(df, group_column="grp", value_column="val", group_a="A", group_b="B").first()
    assert (row["n_a"], row["n_b"], row["significant_at_0.05"]) == (20, 20, True)
    assert (row["mean_a"], row["mean_b"]) == (9.5, 109.5) and row["p_value"] == 0.0
    lone = df.where("grp = 'C'")
    row = diagnostic.ttest_two_groups(lone, group_column="grp", value_column="val", group_a="A", group_b="B").first()
    assert row["t_statistic"] is None and row["significant_at_0.05"] is False


@pytest.mark.parametrize("equal_var", [True, False])
def test_t_p_value_matches_commons_math(spark, equal_var):
    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.normal(0, 1, 30)] + [("b", float(v)) for v in rng.normal(0.6, 2, 45)]
    df = spark.createDataFrame(rows, "g string, v double")
    row = diagnostic.ttest_two_groups(
        df, group_column="g", value_column="v", group_a="a", group_b="b", equal_var=equal_var
    ).first()
    gateway = spark.sparkContext._gateway
    sides = []
    for label in "ab":
        values = [v for g, v in rows if g == label]
        array = gateway.new_array(gateway.jvm.double, len(values))
        for i, v in enumerate(values):
            array[i] = v
        sides.append(array)
    test = gateway.jvm.org.apache.commons.math3.stat.inference.TTest()
    if equal_var:
        t, p = test.homoscedasticT(*sides), test.homoscedasticTTest(*sides)
    else:
        t, p = test.t(*sides), test.tTest(*sides)
    assert row["t_statistic"] == pytest.approx(t, abs=1e-4) and row["p_value"] == pytest.approx(p, abs=1e-6)


def test_tail_kernels_match_commons_math(spark):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    cases = [(t, d) for t in (0.0, 0.3, 1.96, 5.0, 40.0) for d in (1.0, 2.5, 30.0, 1000.0, 1e6)]
    got = pvalues._t_two_sided(np.array([t for t, _ in cases]), np.array([d for _, d in cases]))
    for (t, d), p in zip(cases, got):
        expected = 2 * jvm.TDistribution(d).cumulativeProbability(-t)
        assert p == pytest.approx(expected, rel=1e-7, abs=1e-14)
    cases = [(x, d) for x in (0.01, 1.0, 10.0, 200.0, 5000.0) for d in (1.0, 3.0, 50.0, 5000.0)]
    got = pvalues._chi_square_tail(np.array([x for x, _ in cases]), np.array([d for _, d in cases]))
    for (x, d), p in zip(cases, got):
        expected = 1 - jvm.ChiSquaredDistribution(d).cumulativeProbability(x)
        assert p == pytest.approx(expected, rel=1e-6, abs=1e-12)


def test_chi_square_of_a_2x2_table_applies_yates(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), ("y", "q")] * 10, "a string, b string")
    row = diagnostic.chi_square_independence(df, column_a="a", column_b="b").first()
    # All expected counts are 10, every cell deviates by 10 less the correction of 0.5.
    assert row["chi2"] == pytest.approx(4 * 9.5**2 / 10) and row["degrees_of_freedom"] == 1
    assert row["significant_at_0.05"] is True


def test_chi_square_counts_empty_cells(spark):
    counts = {("a", "x"): 7, ("a", "y"): 3, ("b", "y"): 9, ("b", "z"): 4, ("c", "x"): 2, ("c", "z"): 8}
    rows = [k for k, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame([*rows, (None, "x"), ("a", None)], "a string, b string")
    observed = np.array([[counts.get((a, b), 0) for b in "xyz"] for a in "abc"], float)
    expected = observed.sum(1)[:, None] * observed.sum(0)[None] / observed.sum()
    row = diagnostic.chi_square_independence(df, column_a="a", column_b="b").first()
    assert row["chi2"] == pytest.approx(((observed - expected) ** 2 / expected).sum(), abs=1e-4)
    assert row["degrees_of_freedom"] == 4


def test_chi_square_of_one_level(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "a string, b string")
    row = diagnostic.chi_square_independence(df, column_a="a", column_b="b").first()
    assert (row["chi2"], row["p_value"], row["degrees_of_freedom"]) == (0.0, 1.0, 0)


def test_contingency_table(clean_df):
    wide = diagnostic.contingency_table(clean_df, column_a="region", column_b="channel")
    assert {tuple(r) for r in wide.collect()} == {("East", 1, 1), ("North", 2, 0), ("South", 0, 2)}


def test_contribution_to_change(spark):
    rows = [("N", 2022, 100), ("S", 2022, 100), ("N", 2023, 150), ("S", 2023, 80), ("N", 2021, 999), (None, 2023, 5)]
    df = spark.createDataFrame(rows, "region string, year int, sales bigint")
    out = diagnostic.contribution_to_change(
        df, dimension="region", value="sales", period_column="year", period_from=2022, period_to=2023
    ).collect()
    assert [(r["region"], r["delta"]) for r in out] == [("N", 50.0), ("S", -20.0), (None, 5.0)]
    assert sum(r["pct_contribution_to_change"] for r in out) == pytest.approx(100, abs=0.1)
    same = diagnostic.contribution_to_change(
        df.where("year = 2022"), dimension="region", value="sales", period_column="year", period_from=2022,
        period_to=2022,
    ).collect()
    assert {r["pct_contribution_to_change"] for r in same} == {0.0}


def test_nan_does_not_poison_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", 3.0)], "g string, v double")
    rows = {r["g"]: r for r in diagnostic.group_comparison(df, group_column="g", value_column="v").collect()}
    assert rows["a"]["count"] == 1 and rows["a"]["mean"] == 1.0
    assert df.where(F.isnan("v")).count() == 1
