"""Descriptive analytics: group aggregates, shares, pivots, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import Aggregate, aggregate_name, grouped
from ..functions.columns import as_list, exact_sum, is_missing, percent, ref, require, require_numeric, value
from ..plans.scratch import written


def aggregate(
    df: DataFrame,
    *,
    group_by: str | Sequence[str],
    metrics: Mapping[str, Aggregate | Sequence[Aggregate]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Group and aggregate; a missing key is a group of its own, keys come sorted.

    ``metrics`` maps a column to one aggregate or a list.  With single aggregates the
    outputs keep the column names; as soon as one entry is a list, all outputs are named
    ``<column>_<aggregate>``.  ``first`` and ``last`` refer to ``order_by``.
    """
    keys = as_list(group_by)
    several = any(isinstance(how, (list, tuple)) for how in metrics.values())
    outputs = []
    for column, how in metrics.items():
        for one in how if isinstance(how, (list, tuple)) else [how]:
            alias = f"{column}_{aggregate_name(one)}".strip("_") if several else column
            outputs.append((column, one, alias))
    return grouped(df, keys, outputs, order_by).orderBy(*[ref(k).asc_nulls_last() for k in keys])


def top_n(
    df: DataFrame, *, by: str, n: int = 10, ascending: bool = False, order_by: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) ``by``; missing last either way.

    Rows that tie in ``by`` are taken in the order of ``order_by``.
    """
    require(df, [by, *order_by])
    ranking = value(df, by)
    lead = ranking.asc_nulls_last() if ascending else ranking.desc_nulls_last()
    return df.orderBy(lead, *[ref(c) for c in order_by]).limit(n)


def share_of_total(df: DataFrame, *, group_by: str | Sequence[str], value: str) -> DataFrame:
    """Group sums of ``value`` and their ``pct_of_total`` (0-100), largest share first."""
    keys = require(df, group_by)
    require_numeric(df, value)
    sums = df.groupBy(*[ref(k) for k in keys]).agg(exact_sum(df, value).alias(value))
    # The same aggregate once more: its exchange is reused, so the table is read once.
    total = sums.agg(F.sum(ref(value))).scalar()
    shares = sums.withColumn("pct_of_total", percent(ref(value), F.coalesce(total, F.lit(0))))
    return shares.orderBy(F.desc("pct_of_total"), *[ref(k).asc_nulls_last() for k in keys])


def pivot_summary(
    df: DataFrame,
    *,
    index: str | Sequence[str],
    columns: str | Sequence[str],
    values: str,
    aggfunc: Aggregate = "sum",
    column_values: Sequence | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Cross-tabulate a metric; absent combinations are 0, missing keys are left out.

    ``column_values`` fixes the output columns and keeps the plan lazy; without it one
    job lists them.  Several pivot columns are joined with ``_``; headings that then coincide raise.
    """
    rows, key = as_list(index), ref("pivot_key")
    cells = _combined(df, rows, as_list(columns), values, aggfunc, order_by)
    if len(as_list(columns)) > 1:
        cells = written(cells)
        parts = ref("pivot_parts")
        spread = cells.groupBy(key).agg(F.min(parts).alias("a"), F.max(parts).alias("b"))
        shared = spread.where("a <> b").first()
        if shared:
            raise ValueError(f"Several combinations of {as_list(columns)} share the heading {shared['pivot_key']!r}")
    groups = cells.groupBy(*[ref(k) for k in rows])
    wide = groups.pivot("pivot_key", list(column_values)) if column_values is not None else groups.pivot("pivot_key")
    return wide.agg(F.first("cell")).na.fill(0).orderBy(*[ref(k) for k in rows])


def pivot_cells(
    df: DataFrame,
    *,
    index: str | Sequence[str],
    columns: str | Sequence[str],
    values: str,
    aggfunc: Aggregate = "sum",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The pivot in long form (index, ``pivot_key``, ``cell``), for any number of columns."""
    rows = as_list(index)
    cells = _combined(df, rows, as_list(columns), values, aggfunc, order_by)
    return cells.select(*[ref(k) for k in rows], "pivot_key", "cell")


def _combined(df: DataFrame, index, columns, values: str, aggfunc: Aggregate, order_by: Sequence[str]) -> DataFrame:
    """One row per combination of index and columns: index, ``pivot_key``, ``cell`` and ``pivot_parts``.

    Grouped by the columns, not by the heading: two combinations may share one.  ``pivot_parts`` tells them apart.
    """
    rows, across = require(df, index), require(df, columns)
    keyed = df
    for k in [*rows, *across]:
        keyed = keyed.where(~is_missing(df, k))
    keys = list(dict.fromkeys([*rows, *across]))
    cells = grouped(keyed, keys, [(values, aggfunc, "cell")], order_by).where(F.col("cell").isNotNull())
    key = ref(across[0]) if len(across) == 1 else F.concat_ws("_", *[ref(c) for c in across])
    parts = F.array(*[ref(c).cast("string") for c in across])
    return cells.select(*[ref(k) for k in rows], key.alias("pivot_key"), "cell", parts.alias("pivot_parts"))
