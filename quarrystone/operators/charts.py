"""The small tables behind charts; drawing them is the caller's business."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    attach,
    is_missing,
    number,
    numeric_columns,
    ref,
    require,
    require_numeric,
    value,
)
from ..plans.kernels import grid_sums
from ..plans.quantiles import exact_quantiles
from ..plans.scratch import written
from .correlation import correlation_matrix
from .exploration import value_counts

# Grid points of a density curve: next to a histogram, and inside a violin.
CURVE_POINTS = 200
VIOLIN_POINTS = 100


def _bin_of(x: Column, low: Column, high: Column, bins: Column | int) -> Column:
    """0-based equal-width bin; the last bin includes its upper edge."""
    count = bins if isinstance(bins, Column) else F.lit(bins)
    place = F.floor((x - low) * count / (high - low))
    # greatest and least skip NULLs, which would put a missing value into the first bin.
    return F.when(x.isNotNull(), F.least(F.greatest(place, F.lit(0)), count - 1).cast("int"))


def _edges(low: Column, high: Column) -> list[Column]:
    """Range to bin over; a constant column gets half a unit either side."""
    same = low == high
    return [F.when(same, low - 0.5).otherwise(low), F.when(same, high + 0.5).otherwise(high)]


def _histogram(df: DataFrame, column: str, extent: DataFrame) -> DataFrame:
    """Counts per bin for the one-row ``extent`` (``low, high, bins``), empty bins included."""
    span = extent.select(F.struct("low", "high", "bins")).scalar()
    x = number(df, column)
    placed = df.where(x.isNotNull()).select(_bin_of(x, span["low"], span["high"], span["bins"]).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("count"))
    width = (F.col("high") - F.col("low")) / F.col("bins")
    spine = extent.where("low is not null").select(
        "low", width.alias("width"), F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")
    )
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def histogram_bins(df: DataFrame, column: str, *, bins: int = 30) -> DataFrame:
    """``bin, bin_start, bin_end, count`` over equal widths from min to max."""
    if bins < 1:
        raise ValueError("bins must be at least 1")
    require_numeric(df, column)
    x = number(df, column)
    ends = df.agg(F.min(x).alias("least"), F.max(x).alias("most"))
    low, high = _edges(F.col("least"), F.col("most"))
    extent = ends.select(low.alias("low"), high.alias("high"), F.lit(bins).alias("bins"))
    return _histogram(df, column, extent).orderBy("bin")


def distribution(df: DataFrame, column: str, *, kde: bool = True) -> dict[str, DataFrame]:
    """Histogram with an automatic bin count, and the density curve over it.

    ``histogram`` is like :func:`histogram_bins`; the bin count is the larger of
    Sturges' and Freedman-Diaconis'.  ``curve`` holds ``x, density``.
    """
    require_numeric(df, column)
    x = number(df, column)
    ends = df.agg(F.count(x).alias("n"), F.min(x).alias("least"), F.max(x).alias("most"))
    quartiles = exact_quantiles(df, [column], [0.25, 0.75]).select(ref(column).alias("q"))
    span = F.col("most") - F.col("least")
    sturges = span / (F.log2(F.col("n").cast("double")) + 1)
    spread = F.get("q", F.lit(1)) - F.get("q", F.lit(0))
    diaconis = 2 * spread / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    width = F.when(diaconis > 0, F.least(diaconis, sturges)).otherwise(sturges)
    if isinstance(df.schema[column].dataType, T.IntegralType):
        width = F.greatest(width, F.lit(1.0))
    low, high = _edges(F.col("least"), F.col("most"))
    extent = ends.crossJoin(F.broadcast(quartiles)).select(  # one row either side
        low.alias("low"),
        high.alias("high"),
        F.when(width > 0, F.ceil(span / width).cast("int")).otherwise(1).alias("bins"),
    )
    tables = {"histogram": _histogram(df, column, extent).orderBy("bin")}
    if kde:
        tables["curve"] = density_curve(df, column).orderBy("x")
    return tables


def density_curve(
    df: DataFrame,
    column: str,
    *,
    group_by: Sequence[str] = (),
    points: int = CURVE_POINTS,
    cut: float = 0.0,
) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth) on an even grid: keys, ``x, density``.

    The grid spans the data, widened by ``cut`` bandwidths.  Tasks add the kernels of the values they read
    to the grid points, so values are not shuffled; kernels end after 8.5 bandwidths, where they are below
    3e-16 of their height.
    """
    require_numeric(df, column)
    keys = require(df, group_by)
    groups = [ref(k) for k in keys]
    table = df.select(*groups, number(df, column).alias("__v")).where("__v is not null")
    stats = table.groupBy(*groups).agg(
        F.count("*").cast("double").alias("__n"),
        F.stddev_samp("__v").alias("__sd"),
        F.min("__v").alias("__least"),
        F.max("__v").alias("__most"),
    )
    bandwidth = F.col("__sd") * F.pow(F.col("__n"), F.lit(-0.2))
    stats = stats.withColumn("__h", bandwidth).where("__h > 0")
    start = F.col("__least") - cut * F.col("__h")
    stats = stats.withColumns(
        {"__start": start, "__step": (F.col("__most") + cut * F.col("__h") - start) / (points - 1)}
    )
    stats = written(stats.withColumn("__g", F.monotonically_increasing_id()))
    joined = attach(table, stats, keys).select(
        F.col("__g").alias("g"), F.col("__v").alias("v"), F.col("__start").alias("start"), F.col("__step").alias("step"),
        F.col("__h").alias("h"),
    )
    sums = grid_sums(joined, points).toDF("__of", "__i", "__sum")
    norm = F.col("__n") * F.col("__h") * math.sqrt(2 * math.pi)
    x = F.col("__start") + F.col("__i") * F.col("__step")
    density = F.col("__sum") / norm
    return sums.join(stats, F.col("__of") == F.col("__g")).select(*groups, x.alias("x"), density.alias("density"))


def box_stats(df: DataFrame, *, y: str, x: str | None = None, factor: float = 1.5) -> DataFrame:
    """Box plot numbers, overall or per level of ``x``.

    ``n, q1, median, q3``, whiskers at the furthest values within ``factor`` times the
    interquartile range, and the count of values beyond them.
    """
    require_numeric(df, y)
    keys = require(df, x) if x is not None else []
    groups = [ref(k) for k in keys]
    table = df.where(" and ".join(f"`{k}` is not null" for k in keys) or "true")
    table = table.select(*groups, number(df, y).alias("__y")).where("__y is not null")
    quartiles = exact_quantiles(table, ["__y"], [0.25, 0.5, 0.75], keys)
    q1, q2, q3 = (F.get("__y", F.lit(i)) for i in range(3))
    fences = quartiles.select(
        *groups,
        q1.alias("q1"),
        q2.alias("median"),
        q3.alias("q3"),
        (q1 - factor * (q3 - q1)).alias("__lo"),
        (q3 + factor * (q3 - q1)).alias("__hi"),
    )
    joined = attach(table, written(fences), keys)
    inside = F.col("__y").between(F.col("__lo"), F.col("__hi"))
    return joined.groupBy(*groups, "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(inside, F.col("__y"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__y"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    ).select(*groups, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")


def box_outliers(df: DataFrame, *, y: str, x: str | None = None, factor: float = 1.5) -> DataFrame:
    """The rows a box plot draws as single points; rows without a level of ``x`` have no box."""
    keys = require(df, x) if x is not None else []
    require_numeric(df, y)
    for k in keys:
        df = df.where(~is_missing(df, k))
    fences = exact_quantiles(df, [y], [0.25, 0.75], keys).withColumnRenamed(y, "__q")
    q1, q3 = F.get("__q", F.lit(0)), F.get("__q", F.lit(1))
    reach = factor * (q3 - q1)
    joined = attach(df, written(fences), keys)
    v = number(df, y)
    return joined.where((v < q1 - reach) | (v > q3 + reach)).select(*[ref(c) for c in df.columns])


def violin_stats(df: DataFrame, *, y: str, x: str | None = None) -> dict[str, DataFrame]:
    """``boxes`` as in :func:`box_stats` and, per level, the density ``curves`` around them."""
    keys = [x] if x is not None else []
    present = df.where(ref(x).isNotNull()) if x is not None else df
    curves = density_curve(present, y, group_by=keys, points=VIOLIN_POINTS, cut=2.0)
    return {"boxes": box_stats(df, y=y, x=x), "curves": curves}


def category_counts(df: DataFrame, column: str, *, top_n: int | None = None) -> DataFrame:
    """``column, count``, most frequent first, missing left out; optionally the first ``top_n``."""
    counts = value_counts(df, column, dropna=True)
    return counts if top_n is None else counts.limit(top_n)


def scatter_grid(
    df: DataFrame, *, x: str, y: str, hue: str | None = None, bins: int = 50
) -> DataFrame:
    """Point cloud as counts: ``x_bin, y_bin`` (and ``hue``), cell centres and ``count``."""
    require_numeric(df, x)
    require_numeric(df, y)
    keys = require(df, hue) if hue is not None else []
    a, b = number(df, x), number(df, y)
    points = df.where(a.isNotNull() & b.isNotNull())
    ends = points.agg(
        F.min(a).alias("a0"), F.max(a).alias("a1"), F.min(b).alias("b0"), F.max(b).alias("b1")
    )
    a0, a1 = _edges(F.col("a0"), F.col("a1"))
    b0, b1 = _edges(F.col("b0"), F.col("b1"))
    span = ends.select(F.struct(a0.alias("a0"), a1.alias("a1"), b0.alias("b0"), b1.alias("b1"))).scalar()
    cells = points.groupBy(
        *[ref(k) for k in keys],
        _bin_of(a, span["a0"], span["a1"], bins).alias("x_bin"),
        _bin_of(b, span["b0"], span["b1"], bins).alias("y_bin"),
    ).agg(F.count("*").alias("count"))
    return cells.select(
        *[ref(k) for k in keys],
        "x_bin",
        "y_bin",
        (span["a0"] + (F.col("x_bin") + 0.5) * (span["a1"] - span["a0"]) / bins).alias("x_centre"),
        (span["b0"] + (F.col("y_bin") + 0.5) * (span["b1"] - span["b0"]) / bins).alias("y_centre"),
        "count",
    )


def pair_grid(
    df: DataFrame, *, columns: Sequence[str] | None = None, hue: str | None = None, bins: int = 20
) -> DataFrame:
    """Scatter matrix as counts: ``feature_x, feature_y, x_bin, y_bin, count`` (and ``hue``).

    Off the diagonal a cell counts the rows that have both values; on the diagonal
    (``feature_x = feature_y``) it is a histogram bin.  All pairs come from one scan: a
    row is binned once per column and combined with its own other bins only.
    """
    names = require(df, columns) if columns is not None else numeric_columns(df)
    names = [require_numeric(df, c) for c in names if c != hue]
    keys = require(df, hue) if hue is not None else []
    ends = df.agg(
        *[f(number(df, c)).alias(f"{side}{i}") for i, c in enumerate(names) for side, f in (("l", F.min), ("h", F.max))]
    )
    bounds = []
    for i in range(len(names)):
        low, high = _edges(F.col(f"l{i}"), F.col(f"h{i}"))
        bounds += [low.alias(f"l{i}"), high.alias(f"h{i}")]
    span = ends.select(F.struct(*bounds)).scalar()
    binned = df.select(
        *[ref(k) for k in keys],
        *[_bin_of(number(df, c), span[f"l{i}"], span[f"h{i}"], bins).alias(f"__b{i}") for i, c in enumerate(names)],
    )
    own = [(i, i) for i in range(len(names))]
    pairs = [
        F.struct(
            F.lit(names[i]).alias("feature_x"),
            F.lit(names[j]).alias("feature_y"),
            F.col(f"__b{i}").alias("x_bin"),
            F.col(f"__b{j}").alias("y_bin"),
        )
        for i, j in [*own, *combinations(range(len(names)), 2)]
    ]
    cells = binned.select(*[ref(k) for k in keys], F.inline(F.array(*pairs)))
    cells = cells.where("x_bin is not null and y_bin is not null")
    by = [*keys, "feature_x", "feature_y", "x_bin", "y_bin"]
    return cells.groupBy(*[ref(c) for c in by]).agg(F.count("*").alias("count"))


def correlation_heatmap(df: DataFrame, *, method: str = "pearson") -> DataFrame:
    """The correlation matrix at full precision, in long form."""
    return correlation_matrix(df, method=method, digits=None)


def missing_patterns(df: DataFrame) -> DataFrame:
    """Which columns are missing together: ``pattern`` (1 = missing, in column order),
    ``missing_columns`` and the number of rows, most frequent first."""
    bits = F.concat(*[F.when(is_missing(df, c), "1").otherwise("0") for c in df.columns])
    patterns = df.groupBy(bits.alias("pattern")).agg(F.count("*").alias("count"))
    gone = F.filter(
        F.array(*[F.when(F.substring("pattern", i + 1, 1) == "1", F.lit(c)) for i, c in enumerate(df.columns)]),
        lambda c: c.isNotNull(),
    )
    return patterns.select("pattern", gone.alias("missing_columns"), "count").orderBy(F.desc("count"), "pattern")


def category_series(df: DataFrame, *, x: str, y: str) -> DataFrame:
    """Bars: the category as text and its height."""
    require(df, [x, y])
    return df.select(ref(x).cast("string").alias(x), value(df, y).alias(y))


def line_series(df: DataFrame, *, x: str, y: str) -> DataFrame:
    """Line: ``x, y`` in the order of ``x``."""
    require(df, [x, y])
    return df.select(ref(x), value(df, y).alias(y)).orderBy(ref(x))


def top_importances(importances: DataFrame, *, top_n: int = 20) -> DataFrame:
    """The ``top_n`` rows of a ``feature, importance`` table, largest first."""
    require(importances, ["feature", "importance"])
    return importances.orderBy(F.desc("importance"), "feature").limit(top_n)
