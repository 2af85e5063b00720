import datetime

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import cleansing


def values(df, column):
    return [r[column] for r in df.collect()]


def test_missing_report_lists_only_columns_with_gaps(messy_df):
    rows = cleansing.missing_value_report(messy_df).collect()
    assert [(r["column"], r["n_missing"], r["pct_missing"]) for r in rows] == [("Sales", 1, 16.67)]


def test_missing_report_of_an_empty_table(messy_df):
    assert cleansing.missing_value_report(messy_df.where("false")).collect() == []


def test_quality_report(messy_df):
    rows = {r["column"]: r for r in cleansing.quality_report(messy_df).collect()}
    assert rows["Sales"]["dtype"] == "double" and rows["Sales"]["non_null"] == 5
    assert rows["Order ID"]["n_unique"] == 5 and rows["Region "]["n_missing"] == 0
    rough = {r["column"]: r["n_unique"] for r in cleansing.quality_report(messy_df, approx=True).collect()}
    assert rough["Order ID"] == 5


def test_quality_report_reads_nan_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    row = cleansing.quality_report(df).first()
    assert (row["non_null"], row["n_missing"], row["n_unique"]) == (1, 2, 1)


def test_standardize_column_names(messy_df):
    assert cleansing.standardize_column_names(messy_df).columns == ["order_id", "region", "sales", "units_sold"]
    assert messy_df.columns[0] == "Order ID"
    assert cleansing.clean_name(" Total Sales ($) ") == "total_sales"


def test_colliding_or_empty_names_raise(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int")
    with pytest.raises(ValueError, match="collide"):
        cleansing.standardize_column_names(df)
    with pytest.raises(ValueError, match="no letter"):
        cleansing.standardize_column_names(spark.createDataFrame([(1,)], "`$$` int"))


def test_strip_whitespace_removes_every_kind(spark):
    df = spark.createDataFrame([("\t a ",), (None,), ("b c \n",)], "t string")
    assert values(cleansing.strip_whitespace(df), "t") == ["a", None, "b c"]


def test_convert_dtypes(spark):
    df = spark.createDataFrame(
        [("1", "2023-01-01", "b"), ("2", "bad", None), ("x", "2023-03-01", "a"), ("nan", None, "b"), ("1d", "", "a")],
        "n string, d string, k string",
    )
    out = cleansing.convert_dtypes(df, to_numeric=["n"], to_datetime=["d"], to_category=["k"])
    rows = out.collect()
    assert sorted((r["n"] for r in rows if r["n"] is not None)) == [1.0, 2.0]
    assert dict(out.dtypes)["d"] == "timestamp_ntz"
    assert {r["d"] for r in rows} == {datetime.datetime(2023, 1, 1), datetime.datetime(2023, 3, 1), None}
    assert {(r["k"], r["k_code"]) for r in rows} == {("a", 0), ("b", 1), (None, None)}


def test_convert_dates_with_formats(spark):
    df = spark.createDataFrame([("31/12/2023",), ("2024-01-05",)], "d string")
    out = cleansing.convert_dtypes(df, to_datetime=["d"], datetime_formats=["dd/MM/yyyy", "yyyy-MM-dd"])
    assert values(out, "d") == [datetime.datetime(2023, 12, 31), datetime.datetime(2024, 1, 5)]


def test_large_dictionaries_take_the_distributed_path(spark):
    df = spark.range(200).select(F.format_string("%03d", F.col("id") % 50).alias("k"))
    rows = cleansing.convert_dtypes(df, to_category=["k"]).collect()
    assert len(rows) == 200 and all(int(r["k"]) == r["k_code"] for r in rows)


def test_drop_duplicates_whole_rows(messy_df):
    assert cleansing.drop_duplicates(messy_df).count() == 5


def test_drop_duplicates_first_last_none(spark):
    rows = [(1, None, "a"), (2, None, "b"), (3, "k", "c"), (4, "k", None), (5, "m", "e")]
    df = spark.createDataFrame(rows, "at int, key string, v string")
    first = cleansing.drop_duplicates(df, subset=["key"], order_by=["at"])
    assert sorted(values(first, "at")) == [1, 3, 5]
    last = cleansing.drop_duplicates(df, subset=["key"], keep="last", order_by=["at"])
    assert sorted((r["at"], r["v"]) for r in last.collect() if r["at"] != 4) == [(2, "b"), (5, "e")]
    assert {r["v"] for r in last.collect() if r["at"] == 4} == {None}
    assert values(cleansing.drop_duplicates(df, subset=["key"], keep=False), "at") == [5]
    assert last.columns == df.columns


def test_drop_duplicates_needs_an_order(messy_df):
    with pytest.raises(ValueError, match="order_by"):
        cleansing.drop_duplicates(messy_df, subset=["Sales"])
    with pytest.raises(ValueError, match="keep"):
        cleansing.drop_duplicates(messy_df, keep="middle")


def test_duplicate_plan_combines_before_the_shuffle(messy_df):
    plan = cleansing.drop_duplicates(messy_df, subset=["Sales"], order_by=["Order ID"])._jdf.queryExecution().toString()
    assert "partial_min" in plan and "Window" not in plan


@pytest.mark.parametrize(
    "strategy, expected",
    [("mean", (100 + 200 + 150 + 999999 + 100) / 5), ("median", 150.0), ("mode", 100.0)],
)
def test_imputation(messy_df, strategy, expected):
    out = cleansing.handle_missing(messy_df, strategy=strategy)
    assert out.where("`Order ID` = 3").first()["Sales"] == pytest.approx(expected)
    assert messy_df.where("Sales is null").count() == 1


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (None, None)], "n int, t string")
    assert tuple(cleansing.handle_missing(df, strategy="mode").collect()[2]) == (1, "a")


def test_all_missing_column_stays_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    for strategy in ("mean", "median", "mode"):
        rows = cleansing.handle_missing(df, strategy=strategy).collect()
        assert [tuple(r) for r in rows] == [(None, 1.0), (None, 1.0)]


def test_drop_rows_and_columns(messy_df):
    assert cleansing.handle_missing(messy_df).count() == 5
    assert "Sales" not in cleansing.handle_missing(messy_df, strategy="drop_cols").columns
    assert cleansing.handle_missing(messy_df, columns=["Order ID"]).count() == 6


def test_constant_fill_checks_its_type(messy_df):
    out = cleansing.handle_missing(messy_df, strategy="constant", columns=["Sales"], fill_value=0)
    assert out.where("Sales = 0").count() == 1
    with pytest.raises(ValueError, match="fill_value"):
        cleansing.handle_missing(messy_df, strategy="constant")
    with pytest.raises(ValueError, match="does not fit"):
        cleansing.handle_missing(messy_df, strategy="constant", columns=["Sales"], fill_value="z")


def test_unknown_strategy_and_column(messy_df):
    with pytest.raises(ValueError, match="Unknown strategy"):
        cleansing.handle_missing(messy_df, strategy="guess")
    with pytest.raises(ValueError, match="Unknown column"):
        cleansing.handle_missing(messy_df, columns=["nope"])


def test_outliers_are_flagged_and_capped(messy_df):
    flags = {r["Order ID"]: r["is_outlier"] for r in cleansing.detect_outliers_iqr(messy_df, "Sales").collect()}
    assert flags == {1: False, 2: False, 3: False, 4: False, 5: True}
    capped = {r["Order ID"]: r["Sales"] for r in cleansing.cap_outliers_iqr(messy_df, "Sales").collect()}
    assert capped[5] == 350.0 and capped[3] is None and capped[1] == 100.0
    with pytest.raises(ValueError, match="numeric"):
        cleansing.cap_outliers_iqr(messy_df, "Region ")


def test_clean_pipeline(messy_df):
    out = cleansing.clean_pipeline(messy_df)
    assert out.columns == ["order_id", "region", "sales", "units_sold"]
    assert sorted(values(out, "region")) == ["East", "North", "South", "West"]
    assert cleansing.clean_pipeline(messy_df, drop_dupes=False, missing_strategy="median").count() == 6
