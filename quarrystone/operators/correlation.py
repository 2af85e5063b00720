"""Correlation matrices and rankings: Pearson, Spearman and Kendall (tau-b)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number, numeric_columns, require, rounded
from ..plans.inversions import concordant, value_places
from ..plans.ranks import column_ranks
from ..plans.scratch import written

METHODS = ("pearson", "spearman", "kendall")


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")


def correlate_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], method: str = "pearson") -> DataFrame:
    """``feature_1, feature_2, correlation`` for the listed column pairs, unrounded.

    Each pair uses the rows in which both columns have a value.
    """
    _check(method)
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    require(df, names)
    slots = {c: f"x{i}" for i, c in enumerate(names)}
    table = df.select(*[number(df, c).alias(slots[c]) for c in names])
    coded = [(slots[a], slots[b]) for a, b in pairs]
    if method == "kendall":
        found = _kendall(table, coded)
    elif method == "spearman":
        found = _spearman(table, coded)
    else:
        found = _pearson(table, coded)
    if not found:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, correlation double")
    long = reduce(DataFrame.unionByName, found)
    label = F.create_map(*[F.lit(v) for c, s in slots.items() for v in (s, c)])
    return long.select(
        F.element_at(label, F.col("a")).alias("feature_1"),
        F.element_at(label, F.col("b")).alias("feature_2"),
        "correlation",
    )


def _pearson(table: DataFrame, pairs) -> list[DataFrame]:
    """Pearson's r of many pairs from central moments of each pair's own complete rows.

    A task takes the columns without gaps in a batch through one matrix product and the
    other pairs one by one, adds batches up and gives one row per pair.  Values are
    shifted by one of their own first, so that a constant column has no spread at all.
    """
    if not pairs:
        return []
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: i for i, c in enumerate(names)}
    left, right = np.array([at[a] for a, _ in pairs]), np.array([at[b] for _, b in pairs])

    def centred(x):
        shifted = x - x[0]
        mean = shifted.mean(0)
        return x[0] + mean, shifted - mean

    def batch_moments(x):
        present = ~np.isnan(x)
        full, found = present.all(0), np.zeros((6, len(left)))
        whole = full[left] & full[right]
        if whole.any():
            place = np.cumsum(full) - 1
            mean, z = centred(x[:, full])
            products = z.T @ z
            a, b = place[left[whole]], place[right[whole]]
            found[:, whole] = [
                np.full(len(a), len(x)), mean[a], mean[b], products[a, a], products[b, b], products[a, b]
            ]
        for p in np.flatnonzero(~whole):
            rows = present[:, left[p]] & present[:, right[p]]
            if rows.any():
                mean, z = centred(x[rows][:, [left[p], right[p]]])
                products = z.T @ z
                found[:, p] = rows.sum(), *mean, products[0, 0], products[1, 1], products[0, 1]
        return found

    def moments(batches):
        total = np.zeros((6, len(left)))
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new = batch_moments(np.stack(columns, axis=1).astype(float))
            n = np.maximum(total[0] + new[0], 1)
            apart, weight = new[1:3] - total[1:3], total[0] * new[0] / n
            between = [apart[0] * apart[0] * weight, apart[1] * apart[1] * weight, apart[0] * apart[1] * weight]
            total[1:3] = np.where(total[0] > 0, total[1:3] + apart * new[0] / n, new[1:3])
            total[3:] += new[3:] + between
            total[0] += new[0]
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *[pa.array(total[k][some]) for k in range(len(sums))]], ["p", *sums]
        )

    sums = ("n", "mx", "my", "sxx", "syy", "sxy")
    parts = table.select(*names).mapInArrow(moments, "p int, " + ", ".join(f"{c} double" for c in sums))
    # The parts of a pair are as many as there were tasks.
    pair = Window.partitionBy("p")
    apart = parts.withColumns({c: F.col(c) - F.min(c).over(pair) for c in ("mx", "my")})
    mean = {c: F.sum(F.col(c) * F.col("n")).over(pair) / F.sum("n").over(pair) for c in ("mx", "my")}
    off = apart.withColumns({c: F.col(c) - mean[c] for c in mean})

    def added(square: str, a: str, b: str) -> Column:
        return F.sum(F.col(square) + F.col("n") * F.col(a) * F.col(b))

    r = F.try_divide(
        added("sxy", "mx", "my"), F.sqrt(added("sxx", "mx", "mx")) * F.sqrt(added("syy", "my", "my"))
    )
    found = off.groupBy("p").agg(r.alias("r"))
    # A pair without one complete row is in no part.
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(pairs)])
    every = table.sparkSession.range(1).select(F.inline(listed))
    return [every.join(found, F.col("i") == F.col("p"), "left").select("a", "b", F.col("r").alias("correlation"))]


def _spearman(table: DataFrame, pairs) -> list[DataFrame]:
    """Pearson on mean ranks.  Columns without gaps are ranked once for all their pairs;
    a pair with gaps is ranked over its own complete rows."""
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    gaps = table.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in names]).first()
    full = [c for c in names if not gaps[c]]
    whole = [p for p in pairs if p[0] in full and p[1] in full]
    results = []
    if whole:
        used = [c for c in full if any(c in p for p in whole)]
        results += _pearson(_ranked(table.select(*used), used), whole)
    for a, b in pairs:
        if (a, b) not in whole:
            complete = table.select(a, b).na.drop() if a != b else table.select(a).na.drop()
            results += _pearson(_ranked(complete, list(dict.fromkeys([a, b]))), [(a, b)])
    return results


def _ranked(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace each column by its mean ranks.

    The ranks of all columns are one written table, so the planner broadcasts short ones and shuffles
    for long ones.
    """
    ranks, joined = written(column_ranks(table, names)), table
    for i, c in enumerate(names):
        own = ranks.where(F.col("column") == i).select(F.col("value").alias(f"{c}_v"), F.col("rank").alias(f"{c}_r"))
        joined = joined.join(own, F.col(c) == F.col(f"{c}_v"))
    return joined.select(*[F.col(f"{c}_r").alias(c) for c in names])


def _kendall(table: DataFrame, pairs) -> list[DataFrame]:
    """tau-b from pair counts over the distinct (x, y) cells, all column pairs in the same jobs."""
    if not pairs:
        return []
    sides = [F.struct(F.lit(i).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for i, (a, b) in enumerate(pairs)]
    both = table.select(F.inline(F.array(*sides))).where("x is not null and y is not null")
    counted = written(both.groupBy("pair", "x", "y").agg(F.count("*").alias("n")))
    places = value_places(counted.select("pair", F.col("y").alias("value")))
    ranked = counted.join(places.withColumnRenamed("value", "y"), ["pair", "y"]).select("pair", "x", "rank", "n")
    rising = concordant(written(ranked), places.count())

    def tied(name: str, *keys: str) -> DataFrame:
        groups = counted.groupBy("pair", *keys).agg(F.sum("n").cast("double").alias("n"))
        return groups.groupBy("pair").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias(name))

    sums = tied("every")
    for part in (tied("tx", "x"), tied("ty", "y"), tied("txy", "x", "y"), rising):
        sums = sums.join(part, "pair")
    either = F.col("every") - F.col("tx") - F.col("ty") + F.col("txy")
    spread = F.sqrt(F.col("every") - F.col("tx")) * F.sqrt(F.col("every") - F.col("ty"))
    found = sums.select("pair", F.try_divide(2 * F.col("concordant") - either, spread).alias("r"))
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(pairs)])
    every = table.sparkSession.range(1).select(F.inline(listed))  # a pair without complete rows has no sums
    return [every.join(found, F.col("i") == F.col("pair"), "left").select("a", "b", F.col("r").alias("correlation"))]


def correlation_matrix(
    df: DataFrame, *, method: str = "pearson", digits: int | None = 4, columns: Sequence[str] | None = None
) -> DataFrame:
    """All pairs of numeric columns, both ways and with the diagonal, in long form.

    ``digits=None`` leaves the values unrounded (what a heatmap is drawn from);
    :func:`as_matrix` turns the result into a square table.
    """
    _check(method)
    names = require(df, columns) if columns is not None else numeric_columns(df)
    upper, own = list(combinations(names, 2)), [(c, c) for c in names]
    # On the diagonal every method gives 1, or nothing for a constant column.
    if method == "pearson":
        found = correlate_pairs(df, upper + own)
    else:
        found = correlate_pairs(df, upper, method).unionByName(correlate_pairs(df, own))
    same = F.col("feature_1") == F.col("feature_2")
    r = F.when(same & F.col("correlation").isNotNull(), 1.0).otherwise(F.col("correlation")).alias("correlation")
    ways = [F.struct(F.col(a).alias("feature_1"), F.col(b).alias("feature_2"), r)
            for a, b in (("feature_1", "feature_2"), ("feature_2", "feature_1"))]
    whole = found.select(F.inline(F.when(same, F.array(ways[0])).otherwise(F.array(*ways))))
    return whole if digits is None else whole.withColumn("correlation", rounded(F.col("correlation"), digits))


def as_matrix(correlations: DataFrame, names: Sequence[str]) -> DataFrame:
    """Square view of a long correlation table: one row and one column per feature."""
    square = correlations.groupBy(F.col("feature_1").alias("feature")).pivot("feature_2", list(names))
    return square.agg(F.first("correlation"))


def top_correlations(df: DataFrame, *, method: str = "pearson", threshold: float = 0.5) -> DataFrame:
    """Pairs whose rounded correlation reaches ``threshold`` in absolute value, strongest first."""
    upper = correlate_pairs(df, list(combinations(numeric_columns(df), 2)), method)
    strong = upper.withColumn("correlation", rounded(F.col("correlation"), 4))
    strong = strong.where(F.abs("correlation") >= threshold)
    return strong.orderBy(F.abs("correlation").desc(), "feature_1", "feature_2")


def correlation_with_target(df: DataFrame, target: str, *, method: str = "pearson") -> DataFrame:
    """``feature, correlation`` of every other numeric column with the target, strongest first."""
    names = numeric_columns(df)
    if target not in names:
        raise ValueError(f"{target!r} is not among the numeric columns")
    pairs = correlate_pairs(df, [(c, target) for c in names if c != target], method)
    ranked = pairs.select(F.col("feature_1").alias("feature"), "correlation")
    return ranked.orderBy(F.abs("correlation").desc_nulls_last(), "feature")
