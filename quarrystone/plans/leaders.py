"""The most frequent values of each column, for any number of them, by threshold selection.

How many values have each count is a small histogram; its running total from the top gives the count that the last
leader has.  Values above it are leaders, and of those that tie with it the first ones by a distributed sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_total
from .scratch import written


def leaders(counts: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` rows with the largest ``n`` of each ``position``, ties by ``value``; counts has these columns."""
    counts = written(counts.select("position", "value", "n"))
    histogram = counts.groupBy("position", (-F.col("n")).alias("lead")).agg(F.count("*").alias("values"))
    ranked = running_total(histogram, ["lead"], "values", "upto", ["position"])
    before = F.col("upto") - F.col("values")
    reached = ranked.select("position", "lead", before.alias("before")).where(F.col("before") < top_n)
    last = reached.groupBy("position").agg(F.max(F.struct("lead", "before")).alias("last"))
    cut = written(last.select(F.col("position").alias("at"), (-F.col("last.lead")).alias("least"), "last.before"))
    met = counts.join(cut, F.col("position") == F.col("at"))
    sure = met.where(F.col("n") > F.col("least")).select("position", "value", "n")
    ties = met.where(F.col("n") == F.col("least")).withColumn("one", F.lit(1)).drop("at")
    placed = running_total(ties, ["value"], "one", "place", ["position"])
    kept = placed.where(F.col("place") <= top_n - F.col("before"))
    return sure.unionByName(kept.select("position", "value", "n"))
