"""Rules, scenarios and allocation."""

from pyspark.sql import functions as F

from quarrystone.operators import prescriptive

from .cleansing import GAPPY, gappy
from .registry import query, rounded, table


@query(
    "rules",
    f"""SELECT o_orderkey, CASE WHEN price > 400000 THEN 'call' WHEN priority = '1-URGENT' THEN 'rush'
               WHEN price < 50000 THEN 'bundle' ELSE 'none' END AS recommended_action FROM ({GAPPY})""",
)
def rules(spark, sf):
    chosen = prescriptive.recommend_by_rules(
        gappy(spark, sf),
        [
            (lambda d: d["price"] > 400000, "call"),
            ("priority = '1-URGENT'", "rush"),
            (F.col("price") < 50000, "bundle"),
        ],
        default_action="none",
    )
    return chosen.select("o_orderkey", "recommended_action")


@query(
    "margin_rules",
    """SELECT l_orderkey, l_linenumber, margin, CASE WHEN margin < 0.93 THEN 'review_pricing'
              WHEN margin < 0.97 THEN 'monitor' ELSE 'healthy' END AS recommended_action
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    round_even((l_extendedprice - 1000 * l_discount) / nullif(l_extendedprice, 0), 3) AS margin
             FROM lineitem)""",
)
def margin_rules(spark, sf):
    lines = table(spark, sf, "lineitem")
    profit = F.col("l_extendedprice") - 1000 * F.col("l_discount")
    lines = lines.withColumn("margin", F.bround(F.try_divide(profit, F.col("l_extendedprice")), 3))
    chosen = prescriptive.recommend_by_rules(
        lines,
        [(lambda d: d["margin"] < 0.93, "review_pricing"), (lambda d: d["margin"] < 0.97, "monitor")],
        default_action="healthy",
    )
    return chosen.select("l_orderkey", "l_linenumber", "margin", "recommended_action")


@query(
    "scenario",
    """SELECT p_partkey, s.p_size, p_retailprice, round_even(p_retailprice * (1 + s.p_size / 100.0), 4) AS prediction
       FROM (SELECT p_partkey, p_retailprice FROM part), (SELECT CAST(unnest([5, 25, 50]) AS INTEGER) AS p_size) s""",
)
def scenario(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")

    def priced(rows):
        return rows.withColumn("prediction", F.col("p_retailprice") * (1 + F.col("p_size") / 100.0))

    sweep = prescriptive.scenario_analysis(priced, parts, variable="p_size", values=[5, 25, 50], allow_many=True)
    return rounded(sweep, ["prediction"], 4)


# Suppliers of a nation share a budget; their balance is the return on it.
SUPPLIERS = """
    SELECT s_nationkey, s_name, s_acctbal / 10000 AS roi, CAST(100 AS DOUBLE) AS lo,
           CAST(CASE WHEN s_nationkey = 7 THEN 50 ELSE 2500 END AS DOUBLE) AS hi FROM supplier"""


@query(
    "allocation",
    f"""WITH o AS ({SUPPLIERS}),
             p AS (SELECT *, CASE WHEN roi > 0 THEN hi - lo ELSE 0 END AS room FROM o),
             f AS (SELECT *, sum(lo) OVER (PARTITION BY s_nationkey) AS floor_sum,
                          bool_or(lo > hi) OVER (PARTITION BY s_nationkey) AS crossed,
                          coalesce(sum(room) OVER (PARTITION BY s_nationkey ORDER BY roi DESC, s_name
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM p),
             x AS (SELECT *, NOT crossed AND floor_sum <= 6000 AS success,
                          lo + least(room, greatest(6000 - floor_sum - spent, 0)) AS x FROM f)
        SELECT s_nationkey, s_name AS option, round_even(CASE WHEN success THEN x ELSE 0 END, 4) AS allocation,
               round_even(CASE WHEN success THEN x ELSE 0 END * roi, 4) AS expected_return, success,
               CASE WHEN success THEN 'optimal' ELSE 'infeasible' END AS status FROM x""",
)
def allocation(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        "s_nationkey",
        "s_name",
        (F.col("s_acctbal") / 10000).alias("roi"),
        F.lit(100.0).alias("lo"),
        F.when(F.col("s_nationkey") == 7, 50.0).otherwise(2500.0).alias("hi"),
    )
    return prescriptive.optimize_allocation(
        suppliers, option="s_name", returns="roi", total_budget=6000.0, min_alloc="lo", max_alloc="hi",
        problem="s_nationkey",
    )
