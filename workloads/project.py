"""A whole project on one table: clean, describe, diagnose, predict and prescribe in one chain."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.operators import correlation, descriptive, diagnostic, modeling, prescriptive, timeseries
from quarrystone.operators.cleansing import (
    cap_outliers_iqr,
    drop_duplicates,
    handle_missing,
    standardize_column_names,
    strip_whitespace,
)
from quarrystone.plans.scratch import written

from .models import MIX, RANGE, _mixed
from .registry import query, rounded, table

KEYS = ["order_key", "line", "part_key"]
FEATURES = ["units_sold", "discount", "profit"]
FIT = f"""SELECT *, row_number() OVER (ORDER BY (order_key * {MIX}) % {RANGE}, {", ".join(KEYS)})
                 <= ceil(round(count(*) OVER () * 0.2, 9)) AS test FROM c"""

PROJECT = f"""
    WITH d AS (SELECT DISTINCT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key,
                      CASE WHEN l_linenumber <> 7 THEN l_quantity::DOUBLE END AS units, l_extendedprice AS sales, l_discount AS discount,
                      l_returnflag AS flag, l_shipdate AS shipped FROM lineitem),
         i AS (SELECT * REPLACE (coalesce(sales, 0) AS sales), coalesce(units, (SELECT median(units) FROM d)) AS units_sold FROM d),
         q AS (SELECT quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3 FROM i),
         s AS (SELECT i.* REPLACE (least(greatest(sales, q1 - 0.4 * (q3 - q1)), q3 + 0.4 * (q3 - q1)) AS sales) FROM i, q),
         c AS (SELECT *, sales * (1 - discount) - 800 * units_sold AS profit FROM s),
         m AS (SELECT date_trunc('month', shipped) AS b, sum(sales) AS v FROM c GROUP BY 1),
         spine AS (SELECT unnest(generate_series((SELECT min(b) FROM m)::TIMESTAMP, (SELECT max(b) FROM m)::TIMESTAMP,
                                                 INTERVAL '1 month')) AS b),
         trend AS (SELECT b, coalesce(v, 0) AS v FROM spine LEFT JOIN m USING (b)),
         g AS (SELECT count(*) FILTER (flag = 'A') AS n_a, count(*) FILTER (flag = 'R') AS n_r,
                      avg(profit) FILTER (flag = 'A') AS m_a, avg(profit) FILTER (flag = 'R') AS m_r,
                      var_samp(profit) FILTER (flag = 'A') AS v_a, var_samp(profit) FILTER (flag = 'R') AS v_r FROM c),
         p AS ({FIT}),
         f AS (SELECT regr_slope(sales, units_sold) AS a, regr_intercept(sales, units_sold) AS b FROM p WHERE NOT test),
         e AS (SELECT sales AS y, a * units_sold + b AS f FROM p CROSS JOIN f WHERE test),
         r AS (SELECT CASE WHEN margin < 0.15 THEN 'review_pricing' WHEN margin < 0.25 THEN 'monitor' ELSE 'healthy' END AS action
               FROM (SELECT round_even(profit / nullif(sales, 0), 3) AS margin FROM c)),
         shares AS (SELECT flag, round_even(100 * sum(sales) / sum(sum(sales)) OVER (), 2) AS pct FROM c GROUP BY flag)
    SELECT 'share' AS step, flag AS item, pct AS value FROM shares
    UNION ALL
    SELECT 'trend', strftime(last_day(b), '%Y-%m-%d'), round_even(CASE WHEN count(v) OVER w = 3 THEN avg(v) OVER w END, 4)
    FROM trend WINDOW w AS (ORDER BY b ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    UNION ALL
    """ + " UNION ALL ".join(
    f"SELECT 'correlation', '{x}', round_even(corr({x}, sales), 6) FROM c" for x in FEATURES
) + """
    UNION ALL
    SELECT 'ttest', 't_statistic', round_even((m_a - m_r) / sqrt(v_a / n_a + v_r / n_r), 4) FROM g
    UNION ALL
    SELECT 'regression', 'r2', round_even(1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)), 4) FROM e
    UNION ALL
    SELECT 'regression', 'rmse', round_even(sqrt(avg(pow(y - f, 2))), 4) FROM e
    UNION ALL
    SELECT 'action', action, count(*)::DOUBLE FROM r GROUP BY action
    UNION ALL
    SELECT 'allocation', flag, round_even(least(400.0, greatest(1000.0 - coalesce(sum(400.0) OVER (ORDER BY pct DESC, flag
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)), 4) FROM shares"""


def _long(df: DataFrame, step: str, item, value) -> DataFrame:
    return df.select(F.lit(step).alias("step"), item.cast("string").alias("item"), value.cast("double").alias("value"))


@query("demo_flow", PROJECT)
def demo_flow(spark, sf):
    lines = table(spark, sf, "lineitem")
    raw = lines.select(
        F.col("l_orderkey").alias("Order Key"),
        F.col("l_linenumber").alias("Line"),
        F.col("l_partkey").alias("Part Key "),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("double")).alias("Units Sold"),
        F.col("l_extendedprice").alias(" Sales ($)"),
        F.col("l_discount").alias("Discount"),
        F.concat(F.lit(" "), "l_returnflag", F.lit("\t")).alias("Flag"),
        F.col("l_shipdate").alias("Shipped"),
    )
    # Written once the duplicates are gone: medians and fences read the table several times.
    clean = written(drop_duplicates(strip_whitespace(standardize_column_names(raw))))
    clean = cap_outliers_iqr(handle_missing(clean, strategy="median"), "sales", factor=0.4)
    clean = written(clean.withColumn("profit", F.col("sales") * (1 - F.col("discount")) - 800 * F.col("units_sold")))

    shares = written(descriptive.share_of_total(clean, group_by="flag", value="sales"))
    trend = timeseries.trend_over_time(clean, date_column="shipped", value="sales", freq="ME")
    # Written, as sorting samples its input first.
    trend = timeseries.moving_average(written(trend), value="sales", order_by="shipped")
    strengths = correlation.correlation_with_target(clean.select("sales", *FEATURES), "sales")
    test = diagnostic.ttest_two_groups(clean, group_column="flag", value_column="profit", group_a="A", group_b="R")
    # The medians leave keys as doubles, whose products lose digits above 2**53.
    order = F.col("order_key").cast("long")
    fitted = modeling.train_regressor(
        clean.select(*KEYS, "units_sold", "sales"), "sales", model="linear", drop=KEYS, key=KEYS, order_hash=_mixed(order)
    )
    # Both scores from one pass over the test rows.
    scores = fitted["metrics"].select(F.inline(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in ("r2", "rmse")])))
    margin = F.bround(F.try_divide("profit", "sales"), 3)
    actions = prescriptive.recommend_by_rules(
        clean.withColumn("margin", margin),
        [(lambda d: d["margin"] < 0.15, "review_pricing"), (lambda d: d["margin"] < 0.25, "monitor")],
        default_action="healthy",
    )
    counts = actions.groupBy("recommended_action").agg(F.count("*").alias("n"))
    budget = prescriptive.optimize_allocation(
        shares.withColumn("most", F.lit(400.0)), option="flag", returns="pct_of_total", total_budget=1000.0, max_alloc="most"
    )
    parts = [
        _long(shares, "share", F.col("flag"), F.col("pct_of_total")),
        _long(trend, "trend", F.col("shipped").cast("date"), F.bround("sales_ma3", 4)),
        _long(strengths, "correlation", F.col("feature"), F.bround("correlation", 6)),
        _long(test, "ttest", F.lit("t_statistic"), F.col("t_statistic")),
        _long(scores, "regression", F.col("m"), F.col("v")),
        _long(counts, "action", F.col("recommended_action"), F.col("n")),
        _long(budget, "allocation", F.col("option"), F.col("allocation")),
    ]
    return reduce(DataFrame.unionByName, parts)
