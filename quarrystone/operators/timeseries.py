"""Calendar trends, moving averages and seasonal decomposition."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import EMPTY, Aggregate, grouped
from ..functions.columns import attach, number, ref, require, require_numeric
from ..plans.frames import frame_means
from ..plans.scratch import written


@dataclass(frozen=True)
class Calendar:
    """A bucket: its first day, the step between first days, and the day that labels it."""

    start: Callable[[Column], Column]
    step: str
    label: Callable[[Column], Column]


def _same(day: Column) -> Column:
    return day


def _ends(months: int) -> Callable[[Column], Column]:
    return lambda start: F.last_day(F.add_months(start, months - 1))


_day = Calendar(_same, "interval 1 day", _same)
# Weeks run Monday to Sunday and carry the Sunday.
_week = Calendar(lambda d: F.trunc(d, "week"), "interval 7 days", lambda start: F.date_add(start, 6))
_month_start, _quarter_start, _year_start = (
    lambda d: F.trunc(d, "month"),
    lambda d: F.trunc(d, "quarter"),
    lambda d: F.trunc(d, "year"),
)
FREQUENCIES = {
    "D": _day,
    "W": _week,
    "M": Calendar(_month_start, "interval 1 month", _ends(1)),
    "ME": Calendar(_month_start, "interval 1 month", _ends(1)),
    "MS": Calendar(_month_start, "interval 1 month", _same),
    "Q": Calendar(_quarter_start, "interval 3 months", _ends(3)),
    "QE": Calendar(_quarter_start, "interval 3 months", _ends(3)),
    "QS": Calendar(_quarter_start, "interval 3 months", _same),
    "Y": Calendar(_year_start, "interval 12 months", _ends(12)),
    "YE": Calendar(_year_start, "interval 12 months", _ends(12)),
    "YS": Calendar(_year_start, "interval 12 months", _same),
}


def trend_over_time(
    df: DataFrame,
    *,
    date_column: str,
    value: str,
    freq: str = "M",
    agg: Aggregate = "sum",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A metric per calendar bucket, empty buckets included.

    ``freq`` is D, W, M/ME, Q/QE, Y/YE (labelled by the last day) or MS, QS, YS (by the
    first).  Rows without a readable date are left out.  An empty bucket has sum and
    count 0; its other aggregates are missing.
    """
    if freq not in FREQUENCIES:
        raise ValueError(f"Unknown freq {freq!r}; choose one of {list(FREQUENCIES)}")
    require(df, [date_column, value])
    calendar = FREQUENCIES[freq]
    when = ref(date_column)
    if isinstance(df.schema[date_column].dataType, T.StringType):
        when = when.try_cast("timestamp_ntz")
    dated = df.withColumn("__bucket", calendar.start(when.cast("date"))).where("__bucket is not null")
    buckets = grouped(dated, ["__bucket"], [(value, agg, "__value")], order_by)
    # Each bucket brings the empty ones up to its successor along.  The buckets are one row
    # per calendar period, few enough for one task to order.
    following = F.lead("__bucket").over(Window.orderBy("__bucket"))
    reach = F.sequence("__bucket", following, F.expr(calendar.step))
    days = F.when(following.isNull(), F.array("__bucket")).otherwise(F.slice(reach, 1, F.size(reach) - 1))
    spread = buckets.withColumn("__days", days).select("__value", F.posexplode("__days").alias("__place", "__day"))
    filled = F.when(F.col("__place") == 0, F.col("__value"))
    if agg in EMPTY:
        empty = F.lit(EMPTY[agg]).cast(buckets.schema["__value"].dataType)
        filled = F.when(F.col("__place") == 0, F.col("__value")).otherwise(empty)
    return spread.select(
        calendar.label(F.col("__day")).cast("timestamp_ntz").alias(date_column), filled.alias(value)
    ).orderBy(ref(date_column))


def moving_average(
    df: DataFrame,
    *,
    value: str,
    order_by: str | Sequence[str],
    window: int = 3,
    partition_by: str | Sequence[str] = (),
) -> DataFrame:
    """Add ``<value>_ma<window>``, the trailing mean over ``window`` rows.

    Missing until the window is full and wherever it holds a missing value.  Rows are sorted
    once; tasks exchange only the rows at their ends, so neither one long
    series nor one dominant ``partition_by`` key ends up in one task.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    require_numeric(df, value)
    times, series = require(df, order_by), require(df, partition_by)
    return frame_means(df, number(df, value), series, times, [1.0] * window, window - 1, f"{value}_ma{window}")


def seasonal_decompose(
    df: DataFrame,
    *,
    value: str,
    order_by: str | Sequence[str],
    period: int = 12,
    model: str = "additive",
    partition_by: str | Sequence[str] = (),
) -> DataFrame:
    """Split each series into ``observed, trend, seasonal, resid``.

    The trend is a centred moving average over one period (half weights at both ends
    when the period is even), the seasonal part the mean of the detrended values at the
    same place in the cycle, centred on 0 (or on 1 for ``multiplicative``).  The ends of
    the trend are missing.  Series with gaps or less than two cycles are refused.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"model must be 'additive' or 'multiplicative', not {model!r}")
    if period < 2:
        raise ValueError("period must be at least 2")
    require_numeric(df, value)
    times, series = require(df, order_by), require(df, partition_by)
    table = df.select(
        *[ref(c) for c in series], *[ref(c) for c in times if c not in series], number(df, value).alias("observed")
    )
    additive = model == "additive"
    stats = table.groupBy(*[ref(c) for c in series]).agg(
        F.count("*").alias("n"), F.count("observed").alias("present"), F.min("observed").alias("least")
    )
    check = stats.agg(F.min("n"), F.bool_or(F.col("present") < F.col("n")), F.min("least")).first()
    if check[0] is None or check[0] < 2 * period:
        raise ValueError(f"Each series needs two full cycles of {period} observations")
    if check[1]:
        raise ValueError("Seasonal decomposition does not handle missing values")
    if not additive and check[2] <= 0:
        raise ValueError("A multiplicative model needs positive values")

    half = period // 2
    ends = [1.0] if period % 2 else [0.5]
    weights = [*ends, *[1.0] * (2 * half - 1), *ends]
    trended = frame_means(table, F.col("observed"), series, times, weights, half, "trend", "__position")
    # Positions are consecutive within a series, so the remainder is a phase up to a shift.
    trended = trended.withColumn("__phase", F.col("__position") % period)

    observed, trend = F.col("observed"), F.col("trend")
    detrended = observed - trend if additive else F.try_divide(observed, trend)
    phases = trended.groupBy(*[ref(c) for c in series], "__phase").agg(F.avg(detrended).alias("__mean"))
    level = F.avg("__mean").over(Window.partitionBy(*[ref(c) for c in series]))
    centred = F.col("__mean") - level if additive else F.try_divide(F.col("__mean"), level)
    phases = phases.withColumn("seasonal", centred).drop("__mean")

    seasonal = F.col("seasonal")
    resid = observed - trend - seasonal if additive else F.try_divide(F.try_divide(observed, trend), seasonal)
    result = attach(trended, written(phases), [*series, "__phase"])
    return result.withColumn("resid", resid).select(
        *[ref(c) for c in series],
        *[ref(c) for c in times if c not in series],
        "observed",
        "trend",
        "seasonal",
        "resid",
    )
