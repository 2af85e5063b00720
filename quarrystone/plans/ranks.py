"""Average ranks over distributed value histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_total


def average_ranks(df: DataFrame, column: str, native: int | None = None) -> DataFrame:
    """``value, rank``: the mean rank of each distinct value, ties sharing it."""
    histogram = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranked = running_total(histogram, ["value"], "n", "upto", native_rows=native)
    return ranked.select("value", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank"))


def column_ranks(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column, value, rank``: the mean ranks in each of the columns (by number), from one histogram and one sort."""
    cells = [F.struct(F.lit(i).alias("column"), F.col(c).alias("value")) for i, c in enumerate(names)]
    long = table.select(F.inline(F.array(*cells))).where("value is not null")
    histogram = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    ranked = running_total(histogram, ["value"], "n", "upto", ["column"])
    return ranked.select("column", "value", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank"))
