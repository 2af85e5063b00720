"""The distributed shapes, forced onto small data and compared with brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import correlation, timeseries
from quarrystone.plans import inversions, ordering, quantiles, ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and another third one value."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(np.arange(n) % 3 == 0, "hot", rng.choice(list("abcdefgh"), n))
    x = np.where(rng.random(n) < 0.33, 7.0, rng.normal(0, 100, n).round(3))
    frame = pd.DataFrame({"id": np.arange(n), "key": key, "x": x, "y": rng.integers(0, 40, n).astype(float)})
    frame.loc[frame.index % 50 == 1, "x"] = np.nan
    return frame, spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))


PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("native_rows", [None, 700, 5])
def test_quantiles_are_exact_on_every_path(skewed, native_rows):
    frame, df = skewed
    row = quantiles.exact_quantiles(df, ["x", "y"], PROBABILITIES, native_rows=native_rows).first()
    for c in ("x", "y"):
        assert row[c] == pytest.approx(frame[c].quantile(PROBABILITIES).tolist())


@pytest.mark.parametrize("native_rows", [None, 500, 5])
def test_grouped_quantiles_split_hot_groups(skewed, native_rows):
    frame, df = skewed
    rows = quantiles.exact_quantiles(df, ["x"], PROBABILITIES, ["key"], native_rows=native_rows).collect()
    assert len(rows) == frame["key"].nunique()
    for r in rows:
        assert r["x"] == pytest.approx(frame.loc[frame["key"] == r["key"], "x"].quantile(PROBABILITIES).tolist())


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, x double")
    got = {r["k"]: r["x"] for r in quantiles.exact_quantiles(df, ["x"], [0.5], ["k"]).collect()}
    assert got["b"] == [1.0] and (got["a"] is None or got["a"] == [None])


@pytest.mark.parametrize("along", [False, True])
def test_hot_groups_without_values_are_kept(spark, along):
    df = spark.range(300).select(
        F.when(F.col("id") < 100, "empty").when(F.col("id") < 290, "full").otherwise("few").alias("k"),
        F.when(F.col("id") >= 100, F.col("id").cast("double")).alias("x"),
    )
    extra = {"n": F.count("*")} if along else None
    rows = {r["k"]: r for r in quantiles.exact_quantiles(df, ["x"], [0.5], ["k"], native_rows=20, along=extra).collect()}
    assert rows["full"]["x"] == [194.5] and rows["few"]["x"] == [294.5]
    assert rows["empty"]["x"] is None or rows["empty"]["x"] == [None]
    assert not along or {k: r["n"] for k, r in rows.items()} == {"empty": 100, "full": 190, "few": 10}


def test_numbered_is_the_sorted_position(skewed):
    frame, df = skewed
    got = ordering.numbered(df, ["key", "id"], "at").toPandas().sort_values("at")
    expected = frame.sort_values(["key", "id"])
    assert got["id"].tolist() == expected["id"].tolist()
    assert got["at"].tolist() == list(range(len(frame)))


@pytest.mark.parametrize("native_rows", [None, 10])
def test_running_total_per_hot_key(skewed, native_rows):
    frame, df = skewed
    got = ordering.running_total(df, ["id"], "y", "upto", ["key"], native_rows).toPandas().sort_values("id")
    expected = frame.sort_values("id").groupby("key")["y"].cumsum()
    assert np.allclose(got["upto"], expected)


@pytest.fixture
def ranges(spark):
    """As many range partitions as asked for, however short."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}

    def use(count):
        spark.conf.set(names[0], str(count))
        spark.conf.set(names[1], "false")

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("count,window", [(1, 5), (4, 5), (4, 1), (40, 5), (40, 150), (120, 9)])
@pytest.mark.parametrize("series", [[], ["key"]])
def test_moving_average_over_rims(skewed, ranges, count, window, series):
    frame, df = skewed
    ranges(count)
    frame, df = frame.iloc[:900], df.where("id < 900")
    out = timeseries.moving_average(df, value="x", order_by="id", window=window, partition_by=series)
    assert out.columns == [*df.columns, f"x_ma{window}"]
    got = out.toPandas().sort_values([*series, "id"])[f"x_ma{window}"].astype(float)
    ordered = frame.sort_values([*series, "id"])
    rolling = ordered.groupby("key")["x"] if series else ordered["x"]
    assert len(got) == len(frame)
    assert np.allclose(got, rolling.rolling(window).mean(), equal_nan=True)


def test_moving_average_sorts_once(skewed):
    """The rows are dealt once; what comes after reads the written table."""
    _, df = skewed
    out = timeseries.moving_average(df, value="x", order_by="id", window=5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan
    assert timeseries.moving_average(df.limit(0), value="x", order_by="id").collect() == []
    again = timeseries.moving_average(out, value="x", order_by="id", window=5)
    assert again.columns == out.columns


@pytest.mark.parametrize("period,model", [(12, "additive"), (7, "additive"), (5, "multiplicative")])
def test_decomposition_in_many_partitions_equals_one(skewed, ranges, period, model):
    _, df = skewed
    df = df.where("id < 1200").withColumn("y", F.col("y") + 1)
    tables = []
    for count in (1, 50):
        ranges(count)
        parts = timeseries.seasonal_decompose(df, value="y", order_by="id", period=period, partition_by="key", model=model)
        tables.append(parts.toPandas().sort_values("id"))
    columns = ["trend", "seasonal", "resid"]
    a, b = (t[columns].astype(float).to_numpy() for t in tables)
    assert np.allclose(a, b, equal_nan=True)
    one = tables[1][tables[1]["key"] == "hot"]
    weights = np.r_[0.5, np.ones(period - 1), 0.5] if period % 2 == 0 else np.ones(period)
    plain = np.convolve(one["observed"], weights / weights.sum(), "valid")
    half = period // 2
    assert np.allclose(one["trend"].astype(float).to_numpy()[half:-half], plain)
    assert one["trend"].isna().sum() == 2 * half


@pytest.mark.parametrize("native", [None, 5])
def test_average_ranks(skewed, native):
    frame, df = skewed
    got = {r["value"]: r["rank"] for r in ranks.average_ranks(df.where("x is not null"), "x", native).collect()}
    expected = dict(zip(frame["x"].dropna(), frame["x"].rank().dropna()))
    assert got == expected


def test_column_ranks(skewed):
    frame, df = skewed
    got = {(r["column"], r["value"]): r["rank"] for r in ranks.column_ranks(df, ["x", "y"]).collect()}
    for i, c in enumerate(("x", "y")):
        expected = dict(zip(frame[c].dropna(), frame[c].rank().dropna()))
        assert {v: r for (k, v), r in got.items() if k == i} == expected


def _rising(x, y, w):
    """The weight of concordant pairs, row by row."""
    order = np.lexsort((-y, x))
    y, w, total = y[order], w[order], 0.0
    for j in range(len(y)):
        total += w[j] * w[:j][y[:j] < y[j]].sum()
    return total


def _cells(spark, x, y, w):
    frame = pd.DataFrame({"pair": 0, "x": x, "y": y, "n": w})
    frame["rank"] = np.unique(frame["y"], return_inverse=True)[1]
    return spark.createDataFrame(frame[["pair", "x", "rank", "n"]]), int(frame["rank"].max()) + 1


@pytest.mark.parametrize("tasks,bits", [(1, 12), (7, 12), (50, 12), (7, 3), (50, 2)])
def test_concordant_pairs_in_any_number_of_tasks(spark, tasks, bits):
    rng = np.random.default_rng(tasks + bits)
    x, y = rng.integers(0, 40, 3000).astype(float), rng.normal(0, 1, 3000).round(2 if bits > 2 else 1)
    x[:1000] = 7.0  # a hot value
    x, y = np.unique(np.stack([x, y]), axis=1)
    w = rng.integers(1, 9, len(x))
    cells, distinct = _cells(spark, x, y, w)
    got = inversions.concordant(cells, distinct, tasks=tasks, bits=bits).first()["concordant"]
    assert got == _rising(x, y, w)


@pytest.mark.parametrize("tasks", [1, 7, 50])
def test_concordant_pairs_of_many_cells(spark, tasks):
    rng = np.random.default_rng(3)
    x, y = rng.permutation(100_000).astype(float), rng.permutation(100_000).astype(float)
    cells, distinct = _cells(spark, x, y, np.ones(100_000, int))
    order, total = y[np.argsort(x)].astype(int), 0
    for first in range(0, 100_000, 2000):
        block = order[first : first + 2000]
        total += int((np.searchsorted(np.sort(order[:first]), block)).sum())
        total += int(np.triu(block[:, None] < block[None], 1).sum())
    assert inversions.concordant(cells, distinct, tasks=tasks).first()["concordant"] == total


def test_no_round_outgrows_its_tasks(spark, monkeypatch):
    """Later rounds hold the totals of the outer groups only, however many there are."""
    monkeypatch.setattr(inversions, "TASK_ROWS", 400)
    rng = np.random.default_rng(9)
    x, y = np.unique(rng.integers(0, 300, (2, 20_000)), axis=1).astype(float)
    cells, distinct = _cells(spark, x, y, np.ones(len(x), int))
    assert inversions.concordant(cells, distinct, bits=5).first()["concordant"] == _rising(x, y, np.ones(len(x)))


def test_rising_pairs_kernel():
    run, digit, w = np.array([0, 0, 0, 1, 1]), np.array([1, 0, 2, 0, 3]), np.array([2.0, 1, 3, 5, 7])
    assert inversions.rising_pairs(run, digit, w, 2).tolist() == [0, 0, 3, 0, 5]
    assert inversions.rising_pairs(run[:0], digit[:0], w[:0]).tolist() == []


def test_places_of_values(spark):
    rows = [(0, 2.5), (0, 1.0), (0, 2.5), (1, 7.0), (0, 9.0)]
    got = inversions.value_places(spark.createDataFrame(rows, "pair int, value double")).collect()
    assert {tuple(r) for r in got} == {(0, 1.0, 0), (0, 2.5, 1), (0, 9.0, 2), (1, 7.0, 3)}


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_uses_pairwise_complete_rows(skewed, method):
    frame, df = skewed
    columns = ["id", "x", "y"]
    matrix = correlation.correlation_matrix(df.select(*columns), method=method, digits=None)
    wide = correlation.as_matrix(matrix, columns).toPandas().set_index("feature").loc[columns, columns]
    assert np.allclose(wide.astype(float), frame[columns].corr(method=method))


def test_kendall_matches_the_definition(skewed):
    frame, df = skewed
    pair = frame[["x", "y"]].dropna()
    x, y = pair["x"].to_numpy(), pair["y"].to_numpy()
    sx, sy = np.sign(x[:, None] - x[None]), np.sign(y[:, None] - y[None])
    expected = (sx * sy).sum() / np.sqrt((sx != 0).sum() * (sy != 0).sum())
    got = correlation.correlate_pairs(df, [("x", "y")], "kendall").first()["correlation"]
    assert got == pytest.approx(expected)


def test_kendall_of_pairs_without_rows_or_spread(spark):
    rows = [(1.0, 5.0, None), (2.0, 5.0, None), (3.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = correlation.correlate_pairs(df, [("a", "b"), ("a", "c"), ("a", "a")], "kendall").collect()
    assert {(r[0], r[1]): r[2] for r in got} == {
        ("a", "b"): None, ("a", "c"): None, ("a", "a"): pytest.approx(1.0)
    }
    assert [r[2] for r in correlation.correlate_pairs(df.limit(0), [("a", "b")], "kendall").collect()] == [None]
