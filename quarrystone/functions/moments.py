"""Bias-corrected moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skew(column: Column) -> Column:
    """Sample skewness G1; 0 for a constant, missing below three values."""
    n = F.count(column).cast("double")
    population = F.coalesce(F.try_divide(F.skewness(column), F.lit(1.0)), F.lit(0.0))
    corrected = F.try_divide(population * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, F.when(F.stddev_pop(column) == 0, 0.0).otherwise(corrected))


def kurtosis(column: Column) -> Column:
    """Sample excess kurtosis G2; 0 for a constant, missing below four values."""
    n = F.count(column).cast("double")
    population = F.coalesce(F.try_divide(F.kurtosis(column), F.lit(1.0)), F.lit(0.0))
    corrected = F.try_divide((n - 1) * ((n + 1) * population + 6), (n - 2) * (n - 3))
    return F.when(n >= 4, F.when(F.stddev_pop(column) == 0, 0.0).otherwise(corrected))
