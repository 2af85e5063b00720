"""Diagnostic analytics: group comparison, significance tests, change decomposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import grouped
from ..functions.columns import (
    attach,
    is_missing,
    number,
    percent,
    ref,
    require,
    require_numeric,
    rounded,
)
from ..functions.pvalues import chi_square_tail, t_two_sided


def group_comparison(df: DataFrame, *, group_column: str, value_column: str) -> DataFrame:
    """Per group ``count, mean, median, std, min, max`` at four digits, highest mean first."""
    require(df, group_column)
    require_numeric(df, value_column)
    statistics = ("count", "mean", "median", "std", "min", "max")
    table = df.withColumn("__value", number(df, value_column))
    groups = grouped(table, [group_column], [("__value", s, s) for s in statistics])
    groups = groups.orderBy(F.desc_nulls_last("mean"), ref(group_column).asc_nulls_last())
    return groups.select(
        ref(group_column), "count", *[rounded(F.col(s), 4).alias(s) for s in statistics if s != "count"]
    )


def ttest_two_groups(
    df: DataFrame,
    *,
    group_column: str,
    value_column: str,
    group_a,
    group_b,
    equal_var: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Two-sample t-test (Welch's unless ``equal_var``), one row, or one per ``by`` segment.

    ``t_statistic, p_value, mean_a, mean_b, n_a, n_b, significant_at_0.05``.
    """
    require(df, [group_column, *by])
    require_numeric(df, value_column)
    x = number(df, value_column)
    label = ref(group_column)

    def side(group, suffix: str) -> list[Column]:
        own = F.when(label == F.lit(group), x)
        return [
            F.count(own).alias(f"n_{suffix}"),
            F.avg(own).alias(f"mean_{suffix}"),
            F.var_samp(own).alias(f"var_{suffix}"),
        ]

    wanted = df.where(label.isin(group_a, group_b))
    sums = wanted.groupBy(*[ref(c) for c in by]).agg(*side(group_a, "a"), *side(group_b, "b"))
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    v_a, v_b = F.col("var_a"), F.col("var_b")
    if equal_var:
        dof = n_a + n_b - 2
        pooled = F.try_divide((n_a - 1) * v_a + (n_b - 1) * v_b, dof)
        error = pooled * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b))
    else:
        s_a, s_b = F.try_divide(v_a, n_a), F.try_divide(v_b, n_b)
        error = s_a + s_b
        dof = F.try_divide(
            error * error, F.try_divide(s_a * s_a, n_a - 1) + F.try_divide(s_b * s_b, n_b - 1)
        )
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(error))
    tested = sums.withColumns({"t": t, "dof": dof}).withColumn("p", t_two_sided("t", "dof"))
    return tested.select(
        *[ref(c) for c in by],
        rounded(F.col("t"), 4).alias("t_statistic"),
        rounded(F.col("p"), 6).alias("p_value"),
        rounded(F.col("mean_a"), 4).alias("mean_a"),
        rounded(F.col("mean_b"), 4).alias("mean_b"),
        "n_a",
        "n_b",
        F.coalesce(F.col("p") < 0.05, F.lit(False)).alias("significant_at_0.05"),
    )


def joint_counts(df: DataFrame, column_a: str, column_b: str) -> DataFrame:
    """Observed combinations of two columns and their counts ``n``; missing values left out."""
    require(df, [column_a, column_b])
    present = df.where(~is_missing(df, column_a) & ~is_missing(df, column_b))
    return present.groupBy(ref(column_a), ref(column_b)).agg(F.count("*").alias("n"))


def contingency_table(
    df: DataFrame, *, column_a: str, column_b: str, column_values: Sequence | None = None
) -> DataFrame:
    """Cross-tabulated counts, one output column per level of ``column_b``; 0 where absent."""
    counts = joint_counts(df, column_a, column_b).groupBy(ref(column_a))
    wide = counts.pivot(column_b, list(column_values)) if column_values is not None else counts.pivot(column_b)
    return wide.agg(F.sum("n")).na.fill(0).orderBy(ref(column_a))


def chi_square_independence(df: DataFrame, *, column_a: str, column_b: str) -> DataFrame:
    """One row ``chi2, p_value, degrees_of_freedom, significant_at_0.05``.

    Only the observed combinations are visited: an empty cell adds its expected count,
    and these add up to the total less the expected counts of the observed cells.  With
    one degree of freedom Yates' correction applies; all four cells of a 2 x 2 table
    deviate equally, so one of them gives the corrected deviation.
    """
    cells = joint_counts(df, column_a, column_b).select(
        ref(column_a).alias("a"), ref(column_b).alias("b"), F.col("n").cast("double").alias("n")
    )
    rows = cells.groupBy("a").agg(F.sum("n").alias("row_total"))
    columns = cells.groupBy("b").agg(F.sum("n").alias("column_total"))
    sizes = cells.agg(F.sum("n").alias("total"), F.count("*").alias("seen")).crossJoin(
        F.broadcast(rows.agg(F.count("*").alias("r"), F.sum(1 / F.col("row_total")).alias("inv_r")))
    ).crossJoin(F.broadcast(columns.agg(F.count("*").alias("c"), F.sum(1 / F.col("column_total")).alias("inv_c"))))
    total = cells.agg(F.sum("n")).scalar()
    expected = F.col("row_total") * F.col("column_total") / total
    deviations = attach(attach(cells, rows, ["a"]), columns, ["b"]).withColumn("e", expected)
    terms = deviations.agg(
        F.sum((F.col("n") - F.col("e")) ** 2 / F.col("e")).alias("observed_part"),
        F.sum("e").alias("expected_seen"),
        F.max(F.abs(F.col("n") - F.col("e"))).alias("gap"),
    )
    joined = sizes.crossJoin(F.broadcast(terms))  # one row each
    empty = F.when(F.col("seen") == F.col("r") * F.col("c"), 0.0).otherwise(
        F.greatest(F.col("total") - F.col("expected_seen"), F.lit(0.0))
    )
    corrected = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    yates = corrected * corrected * F.col("total") * F.col("inv_r") * F.col("inv_c")
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    chi2 = F.when(dof == 0, 0.0).when(dof == 1, yates).otherwise(F.col("observed_part") + empty)
    tested = joined.where("r > 0").select(chi2.alias("x"), dof.alias("degrees_of_freedom"))
    tested = tested.withColumn("p", chi_square_tail("x", F.col("degrees_of_freedom").cast("double")))
    return tested.select(
        rounded(F.col("x"), 4).alias("chi2"),
        rounded(F.col("p"), 6).alias("p_value"),
        "degrees_of_freedom",
        (F.col("p") < 0.05).alias("significant_at_0.05"),
    )


def contribution_to_change(
    df: DataFrame, *, dimension: str, value: str, period_column: str, period_from, period_to
) -> DataFrame:
    """Who drove the change between two periods, largest movement first.

    Per level of ``dimension``: ``value_from, value_to, delta`` and
    ``pct_contribution_to_change`` of the total delta (0 when nothing changed overall).
    """
    require(df, [dimension, period_column])
    require_numeric(df, value)
    period = ref(period_column)
    both = df.where(period.isin(period_from, period_to))
    amount = number(df, value)

    def total(label) -> Column:
        return F.coalesce(F.sum(F.when(period == F.lit(label), amount)), F.lit(0.0))

    sums = both.groupBy(ref(dimension)).agg(total(period_from).alias("value_from"), total(period_to).alias("value_to"))
    levels = sums.withColumn("delta", F.col("value_to") - F.col("value_from"))
    overall = levels.agg(F.sum("delta")).scalar()  # reuses the exchange of the sums
    return levels.withColumn(
        "pct_contribution_to_change", percent(F.col("delta"), F.coalesce(overall, F.lit(0.0)))
    ).orderBy(F.abs("delta").desc(), ref(dimension).asc_nulls_last())

