"""Aggregates written in Python, in two phases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrystone.functions.aggregates import UserAggregate
from quarrystone.operators import descriptive, timeseries
from quarrystone.plans import partial

GEOMETRIC = UserAggregate(
    "geometric",
    lambda: (0, 0.0),
    lambda s, v: (s[0] + len(v), s[1] + float(np.log(v).sum())),
    lambda a, b: (a[0] + b[0], a[1] + b[1]),
    lambda s: float(np.exp(s[1] / s[0])) if s[0] else None,
)
SPAN = UserAggregate(
    "span",
    lambda: None,
    lambda s, v: (v.min(), v.max()) if s is None else (min(s[0], v.min()), max(s[1], v.max())),
    lambda a, b: a if b is None else b if a is None else (min(a[0], b[0]), max(a[1], b[1])),
    lambda s: None if s is None else float(s[1] - s[0]),
)


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows have one key, some have none; some values are missing."""
    rng = np.random.default_rng(2)
    key = np.where(np.arange(4000) % 2 == 0, "hot", rng.choice(["a", "b", "c", None], 4000))
    frame = pd.DataFrame({"k": key, "n": rng.integers(0, 3, 4000), "v": rng.uniform(1, 9, 4000)})
    frame.loc[frame.index % 37 == 0, "v"] = np.nan
    frame.loc[frame["k"] == "c", "v"] = np.nan
    return frame, spark.createDataFrame(frame).repartition(16)


@pytest.mark.parametrize("held,slots", [(50_000, 64), (2, 3)])
def test_groups_of_any_size(hot, monkeypatch, held, slots):
    monkeypatch.setattr(partial, "HELD_KEYS", held)
    monkeypatch.setattr(partial, "MERGE_SLOTS", slots)
    frame, df = hot
    found = descriptive.aggregate(df, group_by="k", metrics={"v": [GEOMETRIC, SPAN, "count"]}).collect()
    assert len(found) == 5
    for row in found:
        own = frame[frame["k"].isna() if row.k is None else frame["k"] == row.k]["v"].dropna()
        assert row.v_count == len(own)
        if len(own):
            assert row.v_geometric == pytest.approx(np.exp(np.log(own).mean()))
            assert row.v_span == pytest.approx(own.max() - own.min())
        else:
            assert row.v_geometric is None and row.v_span is None


def test_no_task_takes_a_whole_group(hot):
    """A hot key leaves each task as one state; the merge sees states, not rows."""
    frame, df = hot
    sizes = UserAggregate("sizes", list, lambda s, v: [*s, len(v)], lambda a, b: a + b, lambda s: float(max(s, default=0)))
    steps = UserAggregate("steps", list, lambda s, v: [*s, len(v)], lambda a, b: a + b, lambda s: float(len(s)))
    rows = {r.k: r for r in descriptive.aggregate(df, group_by="k", metrics={"v": [sizes, steps]}).collect()}
    assert rows["hot"].v_steps >= 16 and rows["hot"].v_sizes < 400


def test_keys_of_several_types_and_none_at_all(hot):
    frame, df = hot
    both = descriptive.aggregate(df, group_by=["n", "k"], metrics={"v": SPAN}).collect()
    expected = frame.groupby(["n", "k"], dropna=False)["v"].agg(lambda v: v.max() - v.min())
    assert len(both) == len(expected)
    assert all(isinstance(r.n, int) for r in both)
    whole = partial.two_phase(df, [], [("v", SPAN, "s")]).first()
    assert whole.s == pytest.approx(frame["v"].max() - frame["v"].min())
    assert descriptive.aggregate(df.limit(0), group_by="k", metrics={"v": SPAN}).collect() == []


def test_trends_and_pivots_take_them(hot, spark):
    _, df = hot
    dated = df.withColumn("day", F.expr("date_add(date'2024-01-01', cast(n * 40 as int))"))
    trend = timeseries.trend_over_time(dated, date_column="day", value="v", freq="MS", agg=SPAN).collect()
    assert len(trend) == 3 and all(r.v > 7 for r in trend)
    wide = descriptive.pivot_summary(df, index="k", columns="n", values="v", aggfunc=GEOMETRIC).collect()
    assert {r.k for r in wide} == {"hot", "a", "b"}
