"""Distinct counts of all columns in one pass."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import cleansing, exploration
from quarrystone.plans import distincts


@pytest.fixture(scope="module")
def mixed(spark):
    n = F.col("id")
    return spark.range(20_000, numPartitions=5).select(
        F.when(n % 7 != 0, n).alias("mostly"),
        F.concat(F.lit("v"), (n % 113).cast("string")).alias("text"),
        F.when(n % 5 == 0, F.lit(float("nan"))).when(n % 5 == 1, F.lit(-0.0)).otherwise((n % 3).cast("double")).alias("real"),
        F.array(n % 4, n % 2).alias("list"),
        F.lit(None).cast("date").alias("none"),
        (n.cast("decimal(20,3)") / 8).alias("a.b"),
    )


def brute(df):
    return df.agg(*[F.count_distinct(exploration.value(df, c)).alias(c) for c in df.columns]).first().asDict()


@pytest.mark.parametrize("held, new", [(1 << 20, 1 << 16), (500, 64), (1, 1)])
def test_equal_to_plain_distinct_counts(mixed, monkeypatch, held, new):
    monkeypatch.setattr(distincts, "HELD_PAIRS", held)
    monkeypatch.setattr(distincts, "NEW_PAIRS", new)
    assert exploration.unique_counts(mixed).first().asDict() == brute(mixed)
    rows = {r["column"]: r for r in cleansing.quality_report(mixed).collect()}
    assert {c: r["n_unique"] for c, r in rows.items()} == brute(mixed)
    assert (rows["real"]["n_missing"], rows["real"]["non_null"]) == (4000, 16_000)
    assert (rows["none"]["n_unique"], rows["none"]["pct_missing"]) == (0, 100.0)


def test_no_row_is_expanded(mixed):
    for table in (exploration.unique_counts(mixed), cleansing.quality_report(mixed)):
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            table.explain("formatted")
        assert "Expand" not in shown.getvalue() and "MapInArrow" in shown.getvalue()


def test_empty_tables_repeats_and_maps(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert exploration.unique_counts(empty).first().asDict() == {"a": 0, "b": 0}
    assert [r["n_unique"] for r in cleansing.quality_report(empty).collect()] == [0, 0]
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 2)")
    assert exploration.unique_counts(maps).first()["m"] == 2
    twice = spark.range(3).select(F.lit("x" * 100_000).alias("long"))
    assert exploration.unique_counts(twice).first()["long"] == 1
