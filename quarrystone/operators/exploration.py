"""Exploration: overview, numeric and categorical summaries, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    canonicalize,
    datetime_columns,
    number,
    numeric_columns,
    ref,
    require,
    rounded,
    text_columns,
    value,
)
from ..functions.moments import kurtosis, skew
from ..plans.distincts import distinct_counts
from ..plans.leaders import leaders
from ..plans.quantiles import exact_quantiles
from .correlation import top_correlations

# Spark keeps a rank filter below the exchange for so many rows a group.
RANKED_BELOW = 1_000
# Bytes one value of a fixed-width type takes in memory.
FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def overview(df: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_cols, data_mb, n_duplicated_rows`` and the columns by class.

    ``data_mb`` counts the values themselves (text by its UTF-8 length), the part of
    an in-memory footprint that does not depend on the engine.
    """
    fixed = sum(w for f in df.schema.fields for t, w in FIXED_WIDTH.items() if isinstance(f.dataType, t))
    text = [F.coalesce(F.octet_length(ref(c)), F.lit(0)).cast("long") for c in text_columns(df)]
    per_row = sum(text, F.lit(fixed).cast("long"))
    # Identical rows collapse before the shuffle and the row count comes from the groups.
    groups = canonicalize(df).groupBy(*[ref(c) for c in df.columns]).agg(
        F.count("*").alias("__n"), F.first(per_row).alias("__bytes")
    )

    def names(columns: Sequence[str]):
        return F.array(*[F.lit(c) for c in columns]).cast("array<string>")

    weight = F.sum(F.col("__n").cast("double") * F.col("__bytes"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("__distinct"),
        F.coalesce(weight, F.lit(0.0)).alias("__bytes"),
    ).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        rounded(F.col("__bytes") / 1_048_576, 3).alias("data_mb"),
        (F.col("n_rows") - F.col("__distinct")).alias("n_duplicated_rows"),
        names(numeric_columns(df)).alias("numeric_cols"),
        names(text_columns(df)).alias("categorical_cols"),
        names(datetime_columns(df)).alias("datetime_cols"),
    )


def _numeric_statistics(df: DataFrame, names: Sequence[str], shape: bool) -> DataFrame:
    """Statistics of all columns from one aggregate pass, one output row per column."""
    parts = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    if shape:
        parts |= {"skew": skew, "kurtosis": kurtosis}
    moments = {
        f"s{i}_{stat}": make(number(df, c)) for i, c in enumerate(names) for stat, make in parts.items()
    }
    both = exact_quantiles(df, names, [0.25, 0.5, 0.75], along=moments)
    both = both.select(*[ref(c).alias(f"q{i}") for i, c in enumerate(names)], *moments)

    def row(i: int, name: str):
        own = {stat: F.col(f"s{i}_{stat}") for stat in parts}
        middle = {p: F.get(f"q{i}", F.lit(k)) for k, p in enumerate(("25%", "50%", "75%"))}
        ordered = {k: own[k] for k in ("count", "mean", "std", "min")} | middle | {"max": own["max"]}
        ordered |= {k: own[k] for k in ("skew", "kurtosis") if shape}
        return F.struct(F.lit(name).alias("column"), *[v.alias(k) for k, v in ordered.items()])

    return both.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(names)])))


def describe_numeric(df: DataFrame) -> DataFrame:
    """``column, count, mean, std, min, 25%, 50%, 75%, max`` per numeric column.

    A table without numeric columns is described by ``count, unique, top, freq``.
    """
    names = numeric_columns(df)
    if names:
        return _numeric_statistics(df, names, shape=False)
    return categorical_summary(df, top_n=1).select(
        "column",
        F.col("count"),
        F.col("n_unique").alias("unique"),
        F.col("top_value").alias("top"),
        F.col("top_freq").alias("freq"),
    )


SUMMARY_SCHEMA = (
    "column string, count bigint, mean double, std double, min double, `25%` double, "
    "`50%` double, `75%` double, max double, skew double, kurtosis double"
)


def numeric_summary(df: DataFrame) -> DataFrame:
    """:func:`describe_numeric` plus bias-corrected skew and kurtosis, at four digits.

    Empty when the table has no numeric columns or no rows.
    """
    names = numeric_columns(df)
    if not names or df.isEmpty():
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    table = _numeric_statistics(df, names, shape=True)
    plain = ("column", "count")
    return table.select(*[ref(c) if c in plain else rounded(ref(c), 4).alias(c) for c in table.columns])


def categorical_summary(df: DataFrame, *, top_n: int = 5) -> DataFrame:
    """Per text column ``n_unique, top_value, top_freq, top_values`` (and ``count``).

    ``top_values`` lists the most frequent values with their counts, most frequent
    first and then by value, however many are asked for.  An empty column gives 0 and an empty list.
    """
    names = text_columns(df)
    entry = "array<struct<value:string,count:bigint>>"
    if not names:
        schema = f"column string, n_unique bigint, top_value string, top_freq bigint, top_values {entry}, count bigint"
        return df.sparkSession.createDataFrame([], schema)
    cells = [F.struct(F.lit(i).alias("position"), ref(c).alias("value")) for i, c in enumerate(names)]
    pairs = df.select(F.inline(F.array(*cells))).where("value is not null")
    counts = pairs.groupBy("position", "value").agg(F.count("*").alias("n"))
    if top_n <= RANKED_BELOW:
        # The rank filter is pushed below the exchange, so a task ships top_n rows per column.
        ranking = Window.partitionBy("position").orderBy(F.desc("n"), "value")
        first = counts.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= max(top_n, 1))
    else:
        first = leaders(counts, top_n)
    entries = F.collect_list(F.struct((-F.col("n")).alias("lead"), "value", "n"))
    tops = first.groupBy("position").agg(F.sort_array(entries).alias("ranked"))
    sizes = counts.groupBy("position").agg(F.count("*").alias("n_unique"), F.sum("n").alias("count"))
    spine = df.sparkSession.createDataFrame(list(enumerate(names)), "position int, column string")
    listed = F.transform("ranked", lambda r: F.struct(r["value"].alias("value"), r["n"].alias("count")))
    return (
        spine.join(sizes, "position", "left")
        .join(tops, "position", "left")
        .orderBy("position")
        .select(
            "column",
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            F.get("ranked", F.lit(0))["value"].alias("top_value"),
            F.coalesce(F.get("ranked", F.lit(0))["n"], F.lit(0)).alias("top_freq"),
            F.slice(F.coalesce(listed, F.array().cast(entry)), 1, top_n).alias("top_values")
            if top_n > 0
            else F.array().cast(entry).alias("top_values"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


def value_counts(df: DataFrame, column: str, *, normalize: bool = False, dropna: bool = False) -> DataFrame:
    """Frequency table of one column, most frequent first; ``count`` or ``proportion``.

    Missing values get a row of their own unless ``dropna``.
    """
    require(df, column)
    table = df.select(value(df, column).alias(column))
    if dropna:
        table = table.where(ref(column).isNotNull())
    counts = table.groupBy(ref(column)).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), ref(column).asc_nulls_last())
    if not normalize:
        return ordered
    total = counts.agg(F.sum("count")).scalar()  # reuses the exchange of the counts
    return ordered.select(ref(column), F.try_divide(F.col("count").cast("double"), total).alias("proportion"))


def unique_counts(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """One row with the number of distinct non-missing values of each column."""
    names = require(df, columns) if columns is not None else df.columns
    if approx:
        return df.agg(*[F.approx_count_distinct(value(df, c)).alias(c) for c in names])
    return distinct_counts(df, names).select(*[F.col(f"u{i}").alias(c) for i, c in enumerate(names)])


def summary_report(df: DataFrame) -> dict[str, DataFrame]:
    """Bundle of ``overview``, ``numeric_summary``, ``categorical_summary`` and ``correlations``."""
    return {
        "overview": overview(df),
        "numeric_summary": numeric_summary(df),
        "categorical_summary": categorical_summary(df),
        "correlations": top_correlations(df, threshold=0.5),
    }
