"""Prescriptive analytics: rules, what-if sweeps and budget allocation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach, ref, require, rounded
from ..plans.ordering import running_total
from ..plans.scratch import written

Rule = Column | str | Callable[[DataFrame], Column]


def recommend_by_rules(
    df: DataFrame,
    rules: Sequence[tuple[Rule, str]],
    *,
    default_action: str = "no_action",
    action_column: str = "recommended_action",
) -> DataFrame:
    """Label each row with the action of the first rule that holds, else the default.

    A rule is a Column, a SQL condition or a function from the table to a Column (which
    may call a boolean pandas UDF).  A condition on a missing value does not hold.
    """

    def condition(rule: Rule) -> Column:
        if isinstance(rule, str):
            return F.expr(rule)
        return rule(df) if callable(rule) and not isinstance(rule, Column) else rule

    # CASE WHEN takes the first condition that is true and skips those that are NULL.
    action = F.lit(default_action)
    for rule, label in reversed(list(rules)):
        action = F.when(condition(rule), F.lit(label)).otherwise(action)
    return df.withColumn(action_column, action)


def scenario_analysis(
    model,
    base: DataFrame,
    *,
    variable: str,
    values: Sequence,
    allow_many: bool = False,
) -> DataFrame:
    """Predict with one input swept over ``values``; one distributed pass for the sweep.

    ``model`` is a fitted ``pyspark.ml`` model (anything with ``transform`` that adds
    ``prediction``) or a function from a table to a table with ``prediction``.  ``base``
    must hold one row unless ``allow_many``, which keeps its other columns.
    """
    require(base, variable)
    if not allow_many and base.limit(2).count() != 1:
        raise ValueError("base must hold exactly one row")
    kind = base.schema[variable].dataType
    sweep = F.array(*[F.lit(v).cast(kind) for v in values])
    scenarios = base.drop(variable).withColumn(variable, F.explode(sweep))
    scenarios = scenarios.select(*[ref(c) for c in base.columns])
    predicted = model.transform(scenarios) if hasattr(model, "transform") else model(scenarios)
    kept = base.columns if allow_many else [variable]
    return predicted.select(*[ref(c) for c in kept], "prediction")


def optimize_allocation(
    options: DataFrame,
    *,
    option: str,
    returns: str,
    total_budget: float | str,
    min_alloc: str | None = None,
    max_alloc: str | None = None,
    problem: str | Sequence[str] = (),
    native_rows: int | None = None,
) -> DataFrame:
    """Spread a budget over options to maximise the total return, for every ``problem``.

    ``maximise sum(r x)`` subject to ``sum(x) <= budget`` and bounds per option: with a
    single budget row the optimum starts every option at its lower bound and fills the
    best positive returns first.  ``returns``, ``min_alloc`` (default 0), ``max_alloc``
    (default the budget) and, if given by name, ``total_budget`` are columns.

    Output: problem keys, ``option, allocation, expected_return`` at four digits,
    ``success`` and ``status``; an infeasible problem allocates nothing.

    The fill is a running total per problem, which also spreads one huge problem.
    """
    keys = require(options, problem)
    require(options, [c for c in (option, returns, min_alloc, max_alloc) if c])
    groups = [ref(k) for k in keys]
    budget = ref(total_budget) if isinstance(total_budget, str) else F.lit(float(total_budget))
    table = options.select(
        *groups,
        ref(option).alias("option"),
        ref(returns).cast("double").alias("__r"),
        budget.cast("double").alias("__budget"),
        (ref(min_alloc) if min_alloc else F.lit(0.0)).cast("double").alias("__lo"),
        (ref(max_alloc) if max_alloc else budget).cast("double").alias("__hi"),
    )
    room = F.when(F.col("__r") > 0, F.col("__hi") - F.col("__lo")).otherwise(0.0)
    table = table.withColumns({"__room": room, "__rank": -F.col("__r")})
    limits = table.groupBy(*groups).agg(
        F.sum("__lo").alias("__floor"), F.bool_or(F.col("__lo") > F.col("__hi")).alias("__crossed")
    )
    filled = running_total(table, ["__rank", "option"], "__room", "__upto", keys, native_rows)
    solved = attach(filled, written(limits), keys)
    spent = F.col("__upto") - F.col("__room")
    left = F.greatest(F.col("__budget") - F.col("__floor") - spent, F.lit(0.0))
    feasible = ~F.col("__crossed") & (F.col("__floor") <= F.col("__budget"))
    amount = F.col("__lo") + F.least(F.col("__room"), left)
    solved = solved.withColumns({"success": feasible, "__x": amount})
    allocated = F.when(F.col("success"), F.col("__x")).otherwise(0.0)
    return solved.select(
        *groups,
        "option",
        rounded(allocated, 4).alias("allocation"),
        rounded(allocated * F.col("__r"), 4).alias("expected_return"),
        "success",
        F.when(F.col("success"), "optimal").otherwise("infeasible").alias("status"),
    )
