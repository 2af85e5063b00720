"""Cleansing: names, whitespace, types, duplicates, missing values and outliers."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    canonicalize,
    is_missing,
    number,
    numeric_columns,
    percent,
    ref,
    require,
    require_numeric,
    text_columns,
    unused_name,
    value,
)
from ..plans.distincts import distinct_counts
from ..plans.ordering import numbered
from ..plans.quantiles import exact_quantiles
from ..plans.scratch import written

MISSING_STRATEGIES = ("drop_rows", "drop_cols", "mean", "median", "mode", "constant")


# ---------------------------------------------------------------- diagnosis


def _per_column(df: DataFrame, statistics: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate pass over the table, then one output row per column."""
    names = list(statistics)
    flat = {
        f"c{i}_{stat}": expr.alias(f"c{i}_{stat}")
        for i, name in enumerate(names)
        for stat, expr in statistics[name].items()
    }
    wide = df.agg(*flat.values())
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            *[F.col(f"c{i}_{stat}").alias(stat) for stat in statistics[name]],
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def missing_value_report(df: DataFrame) -> DataFrame:
    """Columns with gaps, worst first: ``column, n_missing, pct_missing`` (0-100, two digits)."""
    statistics = {
        c: {"n_missing": F.count_if(is_missing(df, c)), "n_rows": F.count("*")} for c in df.columns
    }
    counts = _per_column(df, statistics).where("n_missing > 0")
    return counts.select(
        "column", "n_missing", percent(F.col("n_missing"), F.col("n_rows")).alias("pct_missing")
    ).orderBy(F.desc("n_missing"), "column")


def quality_report(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """Scorecard per column: ``dtype, non_null, n_missing, pct_missing, n_unique``.

    ``approx=True`` replaces the exact distinct counts by HyperLogLog sketches.
    """
    if approx:
        counts = _per_column(
            df,
            {
                c: {
                    "non_null": F.count_if(~is_missing(df, c)),
                    "n_missing": F.count_if(is_missing(df, c)),
                    "n_unique": F.approx_count_distinct(value(df, c)),
                }
                for c in df.columns
            },
        )
    else:
        rows = [
            F.struct(
                F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"k{i}").alias("non_null"),
                F.col(f"m{i}").alias("n_missing"), F.col(f"u{i}").alias("n_unique"),
            )
            for i, c in enumerate(df.columns)
        ]
        counts = distinct_counts(df, df.columns).select(F.inline(F.array(*rows)))
    share = F.try_divide(F.col("n_missing").cast("double"), F.col("n_missing") + F.col("non_null"))
    dtype = F.coalesce(*[F.when(F.col("column") == c, F.lit(t)) for c, t in df.dtypes])
    return counts.orderBy("position").select(
        "column",
        dtype.alias("dtype"),
        "non_null",
        "n_missing",
        F.bround(share * 100, 2).alias("pct_missing"),
        "n_unique",
    )


# ---------------------------------------------------------------- text and types


def clean_name(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", str(name).strip().lower()).strip("_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Lower snake_case names.  Names that become empty or equal raise ``ValueError``."""
    names = [clean_name(c) for c in df.columns]
    if "" in names:
        raise ValueError(f"Column {df.columns[names.index('')]!r} has no letter or digit to keep")
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"Columns collide after cleaning: {clashes}")
    return df.toDF(*names)


def strip_whitespace(df: DataFrame) -> DataFrame:
    """Trim every kind of whitespace around every text value; missing stays missing."""
    text = set(text_columns(df))
    return df.select(
        *[
            F.regexp_replace(ref(c), r"(?U)^\s+|\s+$", "").alias(c) if c in text else ref(c)
            for c in df.columns
        ]
    )


def convert_dtypes(
    df: DataFrame,
    *,
    to_numeric: Sequence[str] | None = None,
    to_datetime: Sequence[str] | None = None,
    to_category: Sequence[str] | None = None,
    datetime_formats: Sequence[str] | None = None,
) -> DataFrame:
    """Coerce columns; what cannot be parsed becomes missing.

    ``to_category`` keeps the value and adds ``<column>_code``, its 0-based place
    among the sorted distinct values (missing values have no code).
    """
    numeric, dates, categories = (
        require(df, to_numeric),
        require(df, to_datetime),
        require(df, to_category),
    )
    converted = {}
    for c in numeric:
        if isinstance(df.schema[c].dataType, T.NumericType):
            converted[c] = value(df, c)
            continue
        # A trailing type suffix is a number to the SQL cast but not to a reader of data.
        parsed = F.when(~F.trim(ref(c)).rlike("[dDfF]$"), F.trim(ref(c)).try_cast("double")) \
            if isinstance(df.schema[c].dataType, T.StringType) else ref(c).try_cast("double")
        converted[c] = F.when(~F.isnan(parsed), parsed)
    for c in dates:
        text = ref(c)
        if isinstance(df.schema[c].dataType, T.StringType):
            if datetime_formats:
                attempts = [F.try_to_timestamp(text, F.lit(f)) for f in datetime_formats]
            else:
                attempts = [text.try_cast("timestamp_ntz")]
            text = F.coalesce(*attempts)
        converted[c] = text.cast("timestamp_ntz")
    result = df.withColumns(converted) if converted else df
    for c in categories:
        result = _with_code(result, c)
    return result


def _with_code(df: DataFrame, column: str) -> DataFrame:
    code, key = f"{column}_code", unused_name(df, "__category")
    levels = df.where(~is_missing(df, column)).select(ref(column).alias(key)).distinct()
    coded = numbered(levels, [key], code).withColumn(code, F.col(code).cast("int"))
    joined = df.join(coded, ref(column) == F.col(key), "left")
    return joined.select(*[ref(c) for c in df.columns], ref(code))


# ---------------------------------------------------------------- duplicates


def drop_duplicates(
    df: DataFrame,
    *,
    subset: Sequence[str] | None = None,
    keep: str | bool = "first",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Remove duplicate rows; missing equals missing.

    ``keep`` is ``"first"``, ``"last"`` or ``False`` (drop every member of a
    duplicated key).  With a ``subset``, first and last refer to ``order_by``; rows
    that tie there are ordered by their remaining columns.  Each variant is one
    aggregation, so the copies of a hot key are reduced before the shuffle.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    table = canonicalize(df)
    keys = require(df, subset) if subset is not None else list(df.columns)
    if keep is not False and set(keys) == set(df.columns):
        return table.dropDuplicates()

    rest = [c for c in df.columns if c not in keys]
    if keep is False:
        kept = F.any_value(F.struct(*[ref(c) for c in rest] or [F.lit(1)])).alias("__row")
        groups = table.groupBy(*[ref(k) for k in keys]).agg(F.count("*").alias("__n"), kept)
        single = groups.where("__n = 1")
        return single.select(*[ref(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])

    if not order_by:
        raise ValueError("keep='first'/'last' on a subset needs order_by: Spark rows have no order")
    leading = require(df, order_by)
    sequence = leading + [c for c in rest if c not in leading]
    ranked = F.struct(*[ref(c).alias(f"o{i}") for i, c in enumerate(sequence)])
    pick = F.min(ranked) if keep == "first" else F.max(ranked)
    groups = table.groupBy(*[ref(k) for k in keys]).agg(pick.alias("__row"))
    from_row = {c: F.col("__row")[f"o{i}"] for i, c in enumerate(sequence)}
    return groups.select(*[ref(c) if c in keys else from_row[c].alias(c) for c in df.columns])


def duplicated_row_count(df: DataFrame) -> Column:
    """Scalar: rows beyond the first of each group of identical rows."""
    groups = canonicalize(df).groupBy(*[ref(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0))).scalar()


# ---------------------------------------------------------------- missing values


def handle_missing(
    df: DataFrame,
    *,
    strategy: str = "drop_rows",
    columns: Sequence[str] | None = None,
    fill_value=None,
) -> DataFrame:
    """Drop or impute missing values.

    ``drop_rows``, ``drop_cols`` (one counting pass decides the schema), ``mean`` and
    ``median`` (numeric columns, cast to double), ``mode`` (any type, smallest value on
    ties) or ``constant`` with ``fill_value``.  Medians take several passes, and only
    columns with gaps need one; a table that is costly to compute should be written first.
    """
    if strategy not in MISSING_STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy!r}; choose one of {MISSING_STRATEGIES}")
    names = require(df, columns) if columns is not None else list(df.columns)

    if strategy == "drop_rows":
        return canonicalize(df).na.drop("any", subset=names)
    if strategy == "drop_cols":
        return canonicalize(df).drop(*_with_gaps(df, names))
    if strategy == "constant":
        if fill_value is None:
            raise ValueError("A constant needs its fill_value")
        fills = {c: _constant(df, c, fill_value) for c in names}
    elif strategy == "mode":
        fills = _modes(df, names)
    else:
        numeric = [c for c in names if c in numeric_columns(df)]
        fills = _centres(df, numeric if strategy == "mean" else _with_gaps(df, numeric), strategy)

    def filled(name: str) -> Column:
        centred = strategy in ("mean", "median") and name in numeric
        column = number(df, name) if centred else value(df, name)
        return F.coalesce(column, fills[name]).alias(name) if name in fills else column.alias(name)

    return df.select(*[filled(c) for c in df.columns])


def _with_gaps(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns among ``names`` that hold a missing value, by one pass."""
    if not names:
        return []
    found = df.agg(*[F.bool_or(is_missing(df, c)).alias(f"g{i}") for i, c in enumerate(names)]).first()
    return [c for c, gap in zip(names, found) if gap]


def _centres(df: DataFrame, names: Sequence[str], strategy: str) -> dict[str, Column]:
    """Mean or median of each column as a scalar subquery, all from one row."""
    if not names:
        return {}
    slots = {c: f"s{i}" for i, c in enumerate(names)}
    if strategy == "mean":
        row = df.agg(*[F.avg(number(df, c)).alias(s) for c, s in slots.items()])
    else:
        middle = exact_quantiles(df, names, [0.5])
        row = middle.select(*[F.get(ref(c), F.lit(0)).alias(s) for c, s in slots.items()])
    packed = row.select(F.struct(*slots.values())).scalar()
    return {c: packed[s] for c, s in slots.items()}


def _modes(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """Most frequent value of each column, the smallest on ties.

    Columns of one type are counted together as (column, value) pairs, which combine
    before the shuffle, and the best pair of each column is a struct minimum.
    """
    by_type: dict[T.DataType, list[str]] = {}
    for c in names:
        by_type.setdefault(df.schema[c].dataType, []).append(c)
    modes = {}
    for same in by_type.values():
        entries = [F.struct(F.lit(i).alias("c"), value(df, c).alias("v")) for i, c in enumerate(same)]
        pairs = df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())
        counts = pairs.groupBy("c", "v").agg(F.count("*").alias("n"))
        best = [
            F.min(F.when(F.col("c") == i, F.struct((-F.col("n")).alias("n"), F.col("v")))).alias(f"m{i}")
            for i in range(len(same))
        ]
        packed = counts.agg(*best).select(F.struct(*[f"m{i}" for i in range(len(same))])).scalar()
        modes.update({c: packed[f"m{i}"]["v"] for i, c in enumerate(same)})
    return modes


def _constant(df: DataFrame, name: str, fill) -> Column:
    kind = df.schema[name].dataType
    fits = {
        T.StringType: (str,),
        T.BooleanType: (bool,),
        T.DateType: (datetime.date,),
        T.TimestampType: (datetime.datetime,),
        T.TimestampNTZType: (datetime.datetime,),
    }
    if isinstance(kind, T.IntegralType):
        good = isinstance(fill, int) and not isinstance(fill, bool)
    elif isinstance(kind, T.NumericType):
        good = isinstance(fill, (int, float, decimal.Decimal)) and not isinstance(fill, bool)
    else:
        good = any(isinstance(kind, t) and isinstance(fill, ok) for t, ok in fits.items())
    if not good:
        raise ValueError(f"fill_value {fill!r} does not fit column {name!r} of type {kind.simpleString()}")
    return F.lit(fill).cast(kind)


# ---------------------------------------------------------------- outliers


def iqr_bounds(
    df: DataFrame,
    column: str,
    *,
    factor: float = 1.5,
    group_by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Tukey fences ``lower`` and ``upper`` of a column, one row (or one per group).

    ``approx=True`` takes the quartiles from one bounded sketch pass.
    """
    require_numeric(df, column)
    if approx:
        keyed = df.groupBy(*[ref(k) for k in group_by])
        quartiles = keyed.agg(F.approx_percentile(number(df, column), [0.25, 0.75], 100_000).alias("q"))
    else:
        quartiles = exact_quantiles(df, [column], [0.25, 0.75], group_by).withColumnRenamed(column, "q")
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    reach = (q3 - q1) * factor
    return quartiles.select(*[ref(k) for k in group_by], (q1 - reach).alias("lower"), (q3 + reach).alias("upper"))


def detect_outliers_iqr(
    df: DataFrame,
    column: str,
    *,
    factor: float = 1.5,
    approx: bool = False,
    flag_column: str = "is_outlier",
) -> DataFrame:
    """Add a boolean flag: outside the Tukey fences.  A missing value is no outlier."""
    bounds = iqr_bounds(df, column, factor=factor, approx=approx).select(F.struct("lower", "upper")).scalar()
    x = number(df, column)
    return df.withColumn(flag_column, F.coalesce((x < bounds["lower"]) | (x > bounds["upper"]), F.lit(False)))


def cap_outliers_iqr(df: DataFrame, column: str, *, factor: float = 1.5, approx: bool = False) -> DataFrame:
    """Clip a numeric column to its Tukey fences; missing stays missing."""
    bounds = iqr_bounds(df, column, factor=factor, approx=approx).select(F.struct("lower", "upper")).scalar()
    x = number(df, column)
    capped = F.when(x.isNotNull(), F.greatest(bounds["lower"], F.least(bounds["upper"], x)))
    return df.withColumn(column, capped)


# ---------------------------------------------------------------- the usual sequence


def clean_pipeline(
    df: DataFrame, *, missing_strategy: str = "drop_rows", drop_dupes: bool = True
) -> DataFrame:
    """Names, whitespace, duplicates, missing values, in this order."""
    result = df.transform(standardize_column_names).transform(strip_whitespace)
    if drop_dupes:
        result = drop_duplicates(result)
    if missing_strategy in ("drop_cols", "mean", "median", "mode"):
        result = written(result)  # read for its statistics and again to be filled
    return handle_missing(result, strategy=missing_strategy)
