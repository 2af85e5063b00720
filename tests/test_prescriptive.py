import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import prescriptive


def test_first_matching_rule_wins(spark):
    df = spark.createDataFrame([(0.9,), (0.6,), (0.1,), (None,)], "risk double")
    rules = [(lambda d: d["risk"] > 0.8, "call"), ("risk > 0.5", "discount")]
    out = prescriptive.recommend_by_rules(df, rules, default_action="none").collect()
    assert [r["recommended_action"] for r in out] == ["call", "discount", "none", "none"]


def test_rule_as_pandas_udf(spark):
    @F.pandas_udf("boolean")
    def odd(x: pd.Series) -> pd.Series:
        return x % 2 == 1

    out = prescriptive.recommend_by_rules(spark.range(3), [(lambda d: odd(d["id"]), "odd")]).collect()
    assert [r["recommended_action"] for r in out] == ["no_action", "odd", "no_action"]


def test_scenario_sweep(spark):
    base = spark.createDataFrame([(1, 10)], "x bigint, other bigint")

    def model(rows):
        return rows.withColumn("prediction", F.col("x"))

    out = prescriptive.scenario_analysis(model, base, variable="x", values=[1, 2, 3])
    assert [(r["x"], r["prediction"]) for r in out.collect()] == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(ValueError, match="one row"):
        prescriptive.scenario_analysis(model, base.union(base), variable="x", values=[1])
    assert prescriptive.scenario_analysis(
        model, base.union(base), variable="x", values=[1, 2], allow_many=True
    ).count() == 4


def allocate(spark, rows, budget, **kwargs):
    df = spark.createDataFrame(rows, "option string, r double, lo double, hi double")
    out = prescriptive.optimize_allocation(
        df, option="option", returns="r", total_budget=budget, min_alloc="lo", max_alloc="hi", **kwargs
    )
    return {r["option"]: r for r in out.collect()}


def test_budget_goes_to_the_best_option(spark):
    df = spark.createDataFrame([("A", 0.1), ("B", 0.5), ("C", 0.2)], "option string, r double")
    out = prescriptive.optimize_allocation(df, option="option", returns="r", total_budget=1000)
    got = {r["option"]: r["allocation"] for r in out.collect()}
    assert got == {"A": 0.0, "B": 1000.0, "C": 0.0}


def test_caps_and_bounds(spark):
    got = allocate(spark, [("A", 0.1, 0.0, 1000.0), ("B", 0.5, 0.0, 400.0), ("C", 0.2, 0.0, 1000.0)], 1000)
    assert (got["A"]["allocation"], got["B"]["allocation"], got["C"]["allocation"]) == (0.0, 400.0, 600.0)
    assert got["B"]["expected_return"] == 200.0 and got["B"]["status"] == "optimal"


def test_infeasible_allocates_nothing(spark):
    got = allocate(spark, [("A", 0.1, 600.0, 1000.0), ("B", 0.5, 600.0, 1000.0)], 1000)
    assert all(r["allocation"] == 0.0 and not r["success"] for r in got.values())
    crossed = allocate(spark, [("A", 0.1, 10.0, 5.0)], 1000)
    assert crossed["A"]["status"] == "infeasible"


@pytest.mark.parametrize("native_rows", [None, 2])
def test_allocation_is_optimal(spark, native_rows):
    rng = np.random.default_rng(1)
    rows, best = [], {}
    for p in range(12):
        r, lo, hi = rng.integers(-3, 6, 4), rng.integers(0, 3, 4), rng.integers(2, 6, 4)
        rows += [(p, f"o{i}", float(r[i]), float(lo[i]), float(hi[i]), 9.0) for i in range(4)]
        feasible = [
            sum(a * b for a, b in zip(x, r))
            for x in itertools.product(*[range(lo[i], hi[i] + 1) for i in range(4)])
            if sum(x) <= 9
        ]
        best[p] = max(feasible) if feasible else 0
    df = spark.createDataFrame(rows, "p int, option string, r double, lo double, hi double, budget double")
    out = prescriptive.optimize_allocation(
        df, option="option", returns="r", total_budget="budget", min_alloc="lo", max_alloc="hi", problem="p",
        native_rows=native_rows,
    ).toPandas()
    assert out.groupby("p")["expected_return"].sum().to_dict() == {p: float(v) for p, v in best.items()}
    assert (out.groupby("p")["allocation"].sum() <= 9).all()
