"""Diagnostic queries."""

from pyspark.sql import functions as F

from quarrystone.operators import diagnostic

from .cleansing import GAPPY, gappy
from .registry import query, rounded, table


@query(
    "group_comparison",
    f"""SELECT priority, count(price) AS count, round_even(avg(price), 4) AS mean,
               round_even(median(price), 4) AS median, round_even(stddev_samp(price), 4) AS std,
               round_even(min(price), 4) AS min, round_even(max(price), 4) AS max
        FROM ({GAPPY}) GROUP BY priority""",
)
def group_comparison(spark, sf):
    return diagnostic.group_comparison(gappy(spark, sf), group_column="priority", value_column="price")


# Integrals by Simpson's rule over 2,000 steps: a tail is one less the area up to the statistic.
SIMPSON = "CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"

T_TEST = """
    WITH s AS (SELECT {by} count(price) FILTER (status = 'F') AS n_a, count(price) FILTER (status = 'O') AS n_b,
                      avg(price) FILTER (status = 'F') AS mean_a, avg(price) FILTER (status = 'O') AS mean_b,
                      var_samp(price) FILTER (status = 'F') AS v_a, var_samp(price) FILTER (status = 'O') AS v_b
               FROM ({gappy}) {group}),
         t AS (SELECT *, (mean_a - mean_b) / sqrt({error}) AS t, {dof} AS dof FROM s),
         a AS (SELECT *, atan(abs(t) / sqrt(dof)) AS angle,
                      exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(pi()) AS scale FROM t),
         p AS (SELECT {by} any_value(t) AS t, any_value(mean_a) AS mean_a, any_value(mean_b) AS mean_b,
                      any_value(n_a) AS n_a, any_value(n_b) AS n_b,
                      1 - sum({simpson} * 2 * scale * pow(cos(angle * i / 2000), dof - 1) * angle / 6000) AS p
               FROM a CROSS JOIN range(2001) g(i) {group})
    SELECT {by} round_even(t, 4) AS t_statistic, round_even(p, 6) AS p_value, round_even(mean_a, 4) AS mean_a,
           round_even(mean_b, 4) AS mean_b, n_a, n_b, p < 0.05 AS "significant_at_0.05" FROM p"""
WELCH = dict(
    error="v_a / n_a + v_b / n_b",
    dof="pow(v_a / n_a + v_b / n_b, 2) / (pow(v_a / n_a, 2) / (n_a - 1) + pow(v_b / n_b, 2) / (n_b - 1))",
    simpson=SIMPSON,
)
POOLED = dict(
    error="((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b)",
    dof="(n_a + n_b - 2)::DOUBLE",
    simpson=SIMPSON,
)


@query("ttest_welch", T_TEST.format(by="", group="", gappy=GAPPY, **WELCH))
def ttest_welch(spark, sf):
    return diagnostic.ttest_two_groups(
        gappy(spark, sf), group_column="status", value_column="price", group_a="F", group_b="O"
    )


@query("ttest_pooled", T_TEST.format(by="", group="", gappy=GAPPY, **POOLED))
def ttest_pooled(spark, sf):
    return diagnostic.ttest_two_groups(
        gappy(spark, sf), group_column="status", value_column="price", group_a="F", group_b="O", equal_var=True
    )


@query(
    "ttest_by_segment",
    T_TEST.format(by="priority,", group="GROUP BY priority", gappy=GAPPY, **WELCH),
)
def ttest_by_segment(spark, sf):
    return diagnostic.ttest_two_groups(
        gappy(spark, sf), group_column="status", value_column="price", group_a="F", group_b="O", by=["priority"]
    )


LINES = "SELECT l_returnflag AS status, l_extendedprice AS price FROM lineitem"


@query(
    "ttest_p_value",
    T_TEST.format(by="", group="", gappy=LINES, **WELCH).replace("'F'", "'A'").replace("'O'", "'R'"),
)
def ttest_p_value(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return diagnostic.ttest_two_groups(
        lines, group_column="l_returnflag", value_column="l_extendedprice", group_a="A", group_b="R"
    )


CHI = """
    WITH j AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL),
         r AS (SELECT a, sum(n) AS row_n FROM j GROUP BY a), c AS (SELECT b, sum(n) AS col_n FROM j GROUP BY b),
         g AS (SELECT coalesce(j.n, 0) AS o, row_n * col_n * 1.0 / (SELECT sum(n) FROM j) AS e
               FROM r CROSS JOIN c LEFT JOIN j ON j.a = r.a AND j.b = c.b),

         x AS (SELECT sum(pow(greatest(abs(o - e) - {yates}, 0), 2) / e) AS x,
                      ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS k FROM g),
         p AS (SELECT any_value(x) AS x, any_value(k) AS k,
                      1 - sum({simpson} * pow(sqrt(x) * i / 2000, k - 1) * exp(-x * pow(i / 2000, 2) / 2)
                              * 2 / exp(lgamma(k / 2) + k / 2 * ln(2)) * sqrt(x) / 6000) AS p
               FROM x CROSS JOIN range(2001) h(i))
    SELECT round_even(x, 4) AS chi2, round_even(p, 6) AS p_value, k AS degrees_of_freedom,
           p < 0.05 AS "significant_at_0.05" FROM p"""


@query("chi_square", CHI.format(a="priority", b="status", t=f"({GAPPY})", yates=0, simpson=SIMPSON))
def chi_square(spark, sf):
    return diagnostic.chi_square_independence(gappy(spark, sf), column_a="priority", column_b="status")


@query("chi_square_yates", CHI.format(a="quality", b="toxic", t="labels", yates="least(0.5, abs(o - e))", simpson=SIMPSON))
def chi_square_yates(spark, sf):
    return diagnostic.chi_square_independence(table(spark, sf, "labels"), column_a="quality", column_b="toxic")


@query("chi_square_p_value", CHI.format(a="l_returnflag", b="l_linenumber", t="lineitem", yates=0, simpson=SIMPSON))
def chi_square_p_value(spark, sf):
    lines = table(spark, sf, "lineitem")
    return diagnostic.chi_square_independence(lines, column_a="l_returnflag", column_b="l_linenumber")


@query(
    "contingency_table",
    "SELECT priority, "
    + ", ".join(f"count(*) FILTER (status = '{s}') AS \"{s}\"" for s in "FOP")
    + f" FROM ({GAPPY}) WHERE priority IS NOT NULL GROUP BY priority",
)
def contingency_table(spark, sf):
    return diagnostic.contingency_table(gappy(spark, sf), column_a="priority", column_b="status")


@query(
    "contribution_to_change",
    f"""WITH y AS (SELECT o_orderpriority AS priority,
                  coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 1996), 0) AS value_from,
                  coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 1997), 0) AS value_to
               FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL)
        SELECT priority, round_even(value_from, 2) AS value_from, round_even(value_to, 2) AS value_to,
               round_even(value_to - value_from, 2) AS delta,
               round_even((value_to - value_from) / (SELECT sum(value_to - value_from) FROM y) * 100, 2)
                   AS pct_contribution_to_change
        FROM y""",
)
def contribution_to_change(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"), "o_totalprice"
    )
    change = diagnostic.contribution_to_change(
        orders, dimension="priority", value="o_totalprice", period_column="year", period_from=1996, period_to=1997
    )
    return rounded(change, ["value_from", "value_to", "delta"], 2)
