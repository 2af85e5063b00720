"""Calendar trends, moving averages and decomposition."""

from pyspark.sql import functions as F

from quarrystone.operators import timeseries
from quarrystone.plans.scratch import written
from quarrystone.operators.cleansing import (
    cap_outliers_iqr,
    drop_duplicates,
    handle_missing,
    standardize_column_names,
    strip_whitespace,
)

from .registry import query, rounded, table

# label of a bucket start in column b, step between starts
BUCKETS = {
    "daily": ("D", "day", "1 day", "b"),
    "weekly": ("W", "week", "7 days", "b + INTERVAL 6 DAY"),
    "monthly": ("ME", "month", "1 month", "last_day(b)"),
    "month_start": ("MS", "month", "1 month", "b"),
    "quarterly": ("Q", "quarter", "3 months", "last_day(b + INTERVAL 2 MONTH)"),
    "yearly": ("Y", "year", "1 year", "last_day(b + INTERVAL 11 MONTH)"),
}
# Orders of one status on a few weekdays leave empty days to fill.
TREND = """
    WITH dated AS (SELECT date_trunc('{unit}', CASE WHEN day(o_orderdate) BETWEEN 10 AND 20
                                 THEN o_orderdate + INTERVAL 11 DAY ELSE o_orderdate END) AS b, o_totalprice AS v
                   FROM orders),
         spine AS (SELECT unnest(generate_series((SELECT min(b) FROM dated)::TIMESTAMP,
                                                 (SELECT max(b) FROM dated)::TIMESTAMP, INTERVAL '{step}')) AS b)
    SELECT CAST({label} AS TIMESTAMP) AS o_orderdate, {value} AS o_totalprice
    FROM spine LEFT JOIN dated USING (b) GROUP BY b"""
VALUES = {
    "sum": "round_even(coalesce(sum(v), 0), 2)",
    "mean": "round_even(avg(v), 6)",
    "count": "count(v)",
    "median": "round_even(median(v), 3)",
}


def _register(name: str, grain: str, agg: str) -> None:
    freq, unit, step, label = BUCKETS[grain]

    @query(name, TREND.format(unit=unit, step=step, label=label, value=VALUES[agg]))
    def run(spark, sf):
        # All orders; the middle of each month moves on, which leaves gaps.
        later = F.when(F.dayofmonth("o_orderdate").between(10, 20), F.col("o_orderdate") + F.expr("INTERVAL 11 DAYS"))
        orders = table(spark, sf, "orders").withColumn("o_orderdate", F.coalesce(later, "o_orderdate"))
        trend = timeseries.trend_over_time(
            orders, date_column="o_orderdate", value="o_totalprice", freq=freq, agg=agg
        )
        return trend if agg == "count" else rounded(trend, ["o_totalprice"], {"sum": 2, "mean": 6, "median": 3}[agg])


for _grain in BUCKETS:
    _register(f"trend_{_grain}", _grain, "sum")
_register("trend_daily_mean", "daily", "mean")
_register("trend_daily_count", "daily", "count")
_register("trend_monthly_median", "monthly", "median")


MA = """CASE WHEN count({v}) OVER w = {n} THEN round_even(avg({v}) OVER w, 4) END"""


@query(
    "moving_average",
    f"""SELECT o_orderkey, {MA.format(v='o_totalprice', n=5)} AS o_totalprice_ma5 FROM orders
        WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def moving_average(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    smooth = timeseries.moving_average(
        orders, value="o_totalprice", window=5, order_by=["o_orderdate", "o_orderkey"]
    )
    return rounded(smooth.select("o_orderkey", "o_totalprice_ma5"), ["o_totalprice_ma5"], 4)


@query(
    "moving_average_by_series",
    f"""SELECT event_id, {MA.format(v='value', n=7)} AS value_ma7 FROM events
        WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def moving_average_by_series(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    smooth = timeseries.moving_average(
        events, value="value", window=7, order_by="event_id", partition_by="event_type"
    )
    return rounded(smooth.select("event_id", "value_ma7"), ["value_ma7"], 4)


@query(
    "trend_smoothed",
    """WITH m AS (SELECT date_trunc('month', o_orderdate) AS b, sum(o_totalprice) AS v FROM orders GROUP BY 1),
            spine AS (SELECT unnest(generate_series((SELECT min(b) FROM m)::TIMESTAMP,
                                                    (SELECT max(b) FROM m)::TIMESTAMP, INTERVAL '1 month')) AS b),
            t AS (SELECT b, coalesce(v, 0) AS v FROM spine LEFT JOIN m USING (b))
       SELECT CAST(last_day(b) AS TIMESTAMP) AS o_orderdate, round_even(v, 2) AS o_totalprice,
              CASE WHEN count(v) OVER w = 3 THEN round_even(avg(v) OVER w, 4) END AS o_totalprice_ma3
       FROM t WINDOW w AS (ORDER BY b ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def trend_smoothed(spark, sf):
    trend = timeseries.trend_over_time(
        table(spark, sf, "orders"), date_column="o_orderdate", value="o_totalprice", freq="ME"
    )
    smooth = timeseries.moving_average(
        trend, value="o_totalprice", window=3, order_by="o_orderdate"
    )
    return rounded(rounded(smooth, ["o_totalprice"], 2), ["o_totalprice_ma3"], 4)


SEASONS = """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS p FROM {t}),
         m AS (SELECT *, {trend} AS trend FROM s),
         d AS (SELECT *, {v} {minus} trend AS detrended FROM m),
         ph AS (SELECT {key}, p % {period} AS phase, avg(detrended) AS mean FROM d GROUP BY ALL),
         se AS (SELECT {key}, phase, mean {minus} avg(mean) OVER (PARTITION BY {key}) AS seasonal FROM ph)
    SELECT d.{key}, {id}, round_even({v}, 4) AS observed, round_even(trend, 6) AS trend,
           round_even(seasonal, {digits}) AS seasonal, round_even(detrended {minus} seasonal, {digits}) AS resid
    FROM d JOIN se ON d.{key} = se.{key} AND d.p % {period} = se.phase"""
EVEN = """CASE WHEN count(*) OVER (PARTITION BY {k} ORDER BY p ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
          THEN (avg({v}) OVER (PARTITION BY {k} ORDER BY p ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
              + avg({v}) OVER (PARTITION BY {k} ORDER BY p ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END"""
ODD = """CASE WHEN count(*) OVER (PARTITION BY {k} ORDER BY p ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
         THEN avg({v}) OVER (PARTITION BY {k} ORDER BY p ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END"""


@query(
    "seasonal_additive",
    SEASONS.format(
        key="o_orderpriority", order="o_orderdate, o_orderkey", t="orders", v="o_totalprice", id="o_orderkey",
        period=12, minus="-", digits=6, trend=EVEN.format(k="o_orderpriority", v="o_totalprice"),
    ),
)
def seasonal_additive(spark, sf):
    parts = timeseries.seasonal_decompose(
        table(spark, sf, "orders"),
        value="o_totalprice",
        order_by=["o_orderdate", "o_orderkey"],
        partition_by="o_orderpriority",
        period=12,
    ).drop("o_orderdate")
    return rounded(rounded(parts, ["observed"], 4), ["trend", "seasonal", "resid"], 6)


@query(
    "seasonal_multiplicative",
    SEASONS.format(
        key="event_type", order="event_id", t="(SELECT * REPLACE (value + 1000 AS value) FROM events)", v="value",
        id="event_id", period=7, minus="/", digits=6, trend=ODD.format(k="event_type", v="value"),
    ),
)
def seasonal_multiplicative(spark, sf):
    events = table(spark, sf, "events").withColumn("value", F.col("value") + 1000)
    parts = timeseries.seasonal_decompose(
        events, value="value", order_by="event_id", partition_by="event_type", period=7, model="multiplicative"
    )
    return rounded(rounded(parts, ["observed"], 4), ["trend", "seasonal", "resid"], 6)


# The cleansing and reporting slice of a whole project on one table.
PROJECT_SQL = """
    WITH d AS (SELECT DISTINCT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS v,
                      o_orderdate FROM orders),
         i AS (SELECT o_orderkey, o_orderdate, coalesce(v, (SELECT median(v) FROM d)) AS v FROM d),
         q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM i),
         c AS (SELECT o_orderdate, least(greatest(v, q1 - 0.4 * (q3 - q1)), q3 + 0.4 * (q3 - q1)) AS v FROM i, q),
         m AS (SELECT date_trunc('month', o_orderdate) AS b, sum(v) AS v FROM c GROUP BY 1),
         spine AS (SELECT unnest(generate_series((SELECT min(b) FROM m)::TIMESTAMP,
                                                 (SELECT max(b) FROM m)::TIMESTAMP, INTERVAL '1 month')) AS b),
         t AS (SELECT b, coalesce(v, 0) AS v FROM spine LEFT JOIN m USING (b))
    SELECT CAST(last_day(b) AS TIMESTAMP) AS order_date, round_even(v, 4) AS total_price,
           CASE WHEN count(v) OVER w = 3 THEN round_even(avg(v) OVER w, 4) END AS total_price_ma3
    FROM t WINDOW w AS (ORDER BY b ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


@query("project_flow", PROJECT_SQL)
def project_flow(spark, sf):
    orders = table(spark, sf, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias("Order Key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("Total Price ($)"),
        F.col("o_orderdate").alias("Order Date "),
        F.concat(F.lit(" "), "o_orderpriority").alias("Priority"),
    )
    clean = drop_duplicates(strip_whitespace(standardize_column_names(raw)))
    clean = handle_missing(written(clean), strategy="median")
    clean = cap_outliers_iqr(clean, "total_price", factor=0.4)
    trend = timeseries.trend_over_time(clean, date_column="order_date", value="total_price", freq="ME")
    smooth = timeseries.moving_average(trend, value="total_price", order_by="order_date")
    return rounded(smooth, ["total_price", "total_price_ma3"], 4)
