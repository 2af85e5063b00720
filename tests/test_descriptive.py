import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import descriptive, timeseries


def test_aggregate_single_and_many(clean_df):
    single = {r["region"]: r["sales"] for r in
              descriptive.aggregate(clean_df, group_by="region", metrics={"sales": "sum"}).collect()}
    assert single["North"] == 250.0
    many = descriptive.aggregate(clean_df, group_by="region", metrics={"sales": ["sum", "mean"], "cost": "max"})
    assert many.columns == ["region", "sales_sum", "sales_mean", "cost_max"]


def test_aggregate_vocabulary_against_pandas(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"k": rng.choice(["a", "b", None], 60), "i": range(60), "v": rng.normal(1, 0.3, 60).round(2)})
    frame.loc[::7, "v"] = np.nan
    names = ["sum", "mean", "median", "min", "max", "count", "size", "nunique", "std", "var", "first", "last",
             "prod", "sem", "skew"]
    expected = frame.groupby("k", dropna=False)["v"].agg(names)
    got = descriptive.aggregate(
        spark.createDataFrame(frame.astype({"k": object}).where(frame["k"].notna(), None).assign(i=frame["i"], v=frame["v"])),
        group_by="k", metrics={"v": names}, order_by=["i"],
    ).toPandas()
    for _, row in got.iterrows():
        key = row["k"]
        side = expected[expected.index.isna()].iloc[0] if key is None else expected.loc[key]
        for n in names:
            assert float(row[f"v_{n}"]) == pytest.approx(float(side[n])), n


def test_aggregate_of_nothing_and_bad_names(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    row = descriptive.aggregate(df, group_by="k", metrics={"v": ["sum", "prod", "mean", "count"]}).first()
    assert (row["v_sum"], row["v_prod"], row["v_mean"], row["v_count"]) == (0.0, 1.0, None, 0)
    with pytest.raises(ValueError, match="Unknown aggregate"):
        descriptive.aggregate(df, group_by="k", metrics={"v": "mid"})
    with pytest.raises(ValueError, match="order_by"):
        descriptive.aggregate(df, group_by="k", metrics={"v": "first"})


def test_custom_aggregates(clean_df):
    def spread(column):
        return F.max(column) - F.min(column)

    out = descriptive.aggregate(clean_df, group_by="region", metrics={"sales": spread})
    assert {r["region"]: r["sales"] for r in out.collect()} == {"North": 50.0, "South": 50.0, "East": 250.0}


def test_grouped_pandas_udf_as_aggregate(clean_df):
    @F.pandas_udf("double")
    def middle(v: pd.Series) -> float:
        return float((v.min() + v.max()) / 2)

    out = descriptive.aggregate(clean_df, group_by="region", metrics={"sales": middle})
    assert {r["region"]: r["sales"] for r in out.collect()}["East"] == 175.0


def test_top_n_puts_missing_last(spark, clean_df):
    assert [r["sales"] for r in descriptive.top_n(clean_df, by="sales", n=2).collect()] == [300.0, 250.0]
    df = spark.createDataFrame([(None,), (2.0,), (1.0,), (float("nan"),)], "v double")
    assert [r["v"] for r in descriptive.top_n(df, by="v", n=2, ascending=True).collect()] == [1.0, 2.0]
    assert [r["v"] for r in descriptive.top_n(df, by="v", n=2).collect()] == [2.0, 1.0]


def test_shares_sum_to_100(spark, clean_df):
    rows = descriptive.share_of_total(clean_df, group_by="region", value="sales").collect()
    assert sum(r["pct_of_total"] for r in rows) == pytest.approx(100, abs=0.1)
    assert rows[0]["region"] == "South"
    zero = spark.createDataFrame([("a", 0.0), ("b", None)], "k string, v double")
    assert {r["pct_of_total"] for r in descriptive.share_of_total(zero, group_by="k", value="v").collect()} == {0.0}


def test_pivot(clean_df):
    wide = descriptive.pivot_summary(clean_df, index="region", columns="channel", values="sales")
    rows = {r["region"]: (r["Online"], r["Retail"]) for r in wide.collect()}
    assert rows == {"East": (300.0, 50.0), "North": (250.0, 0.0), "South": (0.0, 450.0)}


def test_pivot_mean_drops_a_column_without_values(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", None), (None, "x", 5.0)], "i string, c string, v double")
    assert descriptive.pivot_summary(df, index="i", columns="c", values="v", aggfunc="mean").columns == ["i", "x"]
    total = descriptive.pivot_summary(df, index="i", columns="c", values="v")
    assert {tuple(r) for r in total.collect()} == {("a", 1.0, 0.0), ("b", 0.0, 0.0)}


def test_monthly_trend_and_moving_average(timeseries_df):
    trend = timeseries.trend_over_time(timeseries_df, date_column="order_date", value="sales", freq="MS")
    rows = trend.collect()
    assert len(rows) == 12 and rows[0]["order_date"] == datetime.datetime(2023, 1, 1)
    smooth = timeseries.moving_average(trend, value="sales", order_by="order_date")
    got = [r["sales_ma3"] for r in smooth.orderBy("order_date").collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(110.0)


@pytest.mark.parametrize("freq, pandas_freq", [
    ("D", "D"), ("W", "W"), ("M", "ME"), ("MS", "MS"), ("Q", "QE"), ("Y", "YE"), ("QS", "QS"), ("YS", "YS"),
])
@pytest.mark.parametrize("agg", ["sum", "mean", "count"])
def test_buckets_match_pandas(spark, freq, pandas_freq, agg):
    frame = pd.DataFrame({
        "d": pd.to_datetime(["2023-12-31 23:00", "2024-01-01", "2024-02-29 12:00", "2024-03-03", "2024-07-15", "2025-01-05"], format="mixed"),
        "v": [1.0, 2.0, 4.0, np.nan, 16.0, 32.0],
    })
    df = spark.createDataFrame([(d.to_pydatetime(), None if np.isnan(v) else v) for d, v in frame.itertuples(index=False)],
                               "d timestamp_ntz, v double")
    got = timeseries.trend_over_time(df, date_column="d", value="v", freq=freq, agg=agg).toPandas()
    expected = frame.set_index("d")["v"].resample(pandas_freq).agg(agg).reset_index()
    assert got["d"].tolist() == expected["d"].tolist()
    assert np.allclose(got["v"].astype(float), expected["v"].astype(float), equal_nan=True)


def test_trend_reads_text_dates_and_refuses_unknown_buckets(spark):
    df = spark.createDataFrame([("2024-01-03", 1.0), ("never", 2.0), ("2024-01-05", 3.0)], "d string, v double")
    rows = timeseries.trend_over_time(df, date_column="d", value="v", freq="D").collect()
    assert [r["v"] for r in rows] == [1.0, 0.0, 3.0]
    with pytest.raises(ValueError, match="freq"):
        timeseries.trend_over_time(df, date_column="d", value="v", freq="fortnight")


def _classical(v, period, multiplicative):
    """Reference decomposition of one series with plain loops."""
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    half = period // 2
    trend = np.full(len(v), np.nan)
    for i in range(half, len(v) - half):
        trend[i] = (v[i - half : i + half + 1] * weights).sum() / period
    flat = v / trend if multiplicative else v - trend
    means = np.array([np.nanmean(flat[i::period]) for i in range(period)])
    means = means / means.mean() if multiplicative else means - means.mean()
    seasonal = np.resize(means, len(v))
    return trend, seasonal, v / trend / seasonal if multiplicative else v - trend - seasonal


@pytest.mark.parametrize("period", [4, 7, 12])
@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_seasonal_decomposition(spark, period, model):
    rng = np.random.default_rng(8)
    v = 100 + np.arange(60) + 10 * np.sin(np.arange(60) * 2 * np.pi / period) + rng.normal(0, 1, 60)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "t int, v double")
    got = timeseries.seasonal_decompose(df, value="v", order_by="t", period=period, model=model).toPandas()
    got = got.sort_values("t")
    for name, expected in zip(("trend", "seasonal", "resid"), _classical(v, period, model == "multiplicative")):
        assert np.allclose(got[name].astype(float), expected, equal_nan=True), name


def test_decomposition_refuses_short_gappy_or_negative_series(spark):
    short = spark.createDataFrame([(i, 1.0) for i in range(10)], "t int, v double")
    with pytest.raises(ValueError, match="two full cycles"):
        timeseries.seasonal_decompose(short, value="v", order_by="t", period=12)
    gap = spark.createDataFrame([(i, None if i == 3 else 1.0) for i in range(30)], "t int, v double")
    with pytest.raises(ValueError, match="missing"):
        timeseries.seasonal_decompose(gap, value="v", order_by="t", period=12)
    with pytest.raises(ValueError, match="positive"):
        timeseries.seasonal_decompose(
            short.withColumn("v", F.col("v") - 5), value="v", order_by="t", period=4, model="multiplicative"
        )


def test_pivot_headings_that_coincide_on_different_rows(spark):
    rows = [("r1", "a_b", "c", 1.0), ("r2", "a", "b_c", 10.0)]
    df = spark.createDataFrame(rows, "r string, p string, q string, v double")
    with pytest.raises(ValueError, match="a_b_c"):
        descriptive.pivot_summary(df, index="r", columns=["p", "q"], values="v")
    wide = descriptive.pivot_summary(df, index="r", columns="p", values="v").collect()
    assert [tuple(r) for r in wide] == [("r1", 0.0, 1.0), ("r2", 10.0, 0.0)]
