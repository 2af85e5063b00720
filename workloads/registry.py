"""Name -> query and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str | Column, digits: int = 2) -> Column:
    """A sum of doubles at a precision that no longer depends on the order of adding."""
    return F.bround(F.col(column) if isinstance(column, str) else column, digits)


def rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: money(f"`{c}`", digits) for c in columns})
