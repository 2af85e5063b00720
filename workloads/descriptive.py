"""Descriptive queries."""

import numpy as np
from pyspark.sql import functions as F

from quarrystone.functions.aggregates import UserAggregate
from quarrystone.operators import descriptive

from .cleansing import GAPPY, gappy
from .registry import query, rounded, table


@query(
    "aggregate_single",
    """SELECT l_returnflag, l_linestatus, round_even(sum(l_extendedprice), 2) AS l_extendedprice,
              round_even(avg(l_discount), 6) AS l_discount, max(l_quantity) AS l_quantity
       FROM lineitem GROUP BY ALL""",
)
def aggregate_single(spark, sf):
    result = descriptive.aggregate(
        table(spark, sf, "lineitem"),
        group_by=["l_returnflag", "l_linestatus"],
        metrics={"l_extendedprice": "sum", "l_discount": "mean", "l_quantity": "max"},
    )
    return rounded(rounded(result, ["l_extendedprice"], 2), ["l_discount"], 6)


@query(
    "aggregate_many",
    f"""SELECT priority, round_even(coalesce(sum(price), 0), 2) AS price_sum, round_even(avg(price), 4) AS price_mean,
              round_even(median(price), 4) AS price_median, min(price) AS price_min, max(price) AS price_max,
              count(price) AS price_count, count(*) AS price_size, count(DISTINCT price) AS price_nunique,
              round_even(stddev_samp(price), 4) AS price_std, round_even(var_samp(price), 0) AS price_var,
              round_even(stddev_samp(price) / sqrt(count(price)), 4) AS price_sem,
              round_even(skewness(price), 4) AS price_skew,
              arg_min(price, o_orderkey) FILTER (price IS NOT NULL) AS price_first,
              arg_max(price, o_orderkey) FILTER (price IS NOT NULL) AS price_last
        FROM ({GAPPY}) GROUP BY priority""",
)
def aggregate_many(spark, sf):
    names = (
        "sum mean median min max count size nunique std var sem skew first last"
    ).split()
    result = descriptive.aggregate(
        gappy(spark, sf), group_by="priority", metrics={"price": names}, order_by=["o_orderkey"]
    )
    fine = [f"price_{n}" for n in ("mean", "median", "std", "sem", "skew")]
    return rounded(rounded(rounded(result, fine, 4), ["price_sum"], 2), ["price_var"], 0)


@query(
    "aggregate_product",
    """SELECT l_returnflag, l_linenumber, round_even(ln(product(1 + l_tax / 1000)), 6) AS l_growth
       FROM lineitem GROUP BY ALL""",
)
def aggregate_product(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_growth", 1 + F.col("l_tax") / 1000)
    result = descriptive.aggregate(lines, group_by=["l_returnflag", "l_linenumber"], metrics={"l_growth": "prod"})
    return result.withColumn("l_growth", F.bround(F.ln("l_growth"), 6))


@query(
    "aggregate_custom",
    """SELECT o_orderpriority, max(o_totalprice) - min(o_totalprice) AS o_totalprice_spread,
              count(o_totalprice) AS o_totalprice_count FROM orders GROUP BY ALL""",
)
def aggregate_custom(spark, sf):
    def spread(column):
        return F.max(column) - F.min(column)

    return descriptive.aggregate(
        table(spark, sf, "orders"),
        group_by="o_orderpriority",
        metrics={"o_totalprice": [spread, "count"]},
    )


@query(
    "share_of_total",
    f"""SELECT priority, round_even(coalesce(sum(price), 0), 2) AS price,
               round_even(sum(price) / (SELECT sum(price) FROM ({GAPPY})) * 100, 2) AS pct_of_total
        FROM ({GAPPY}) GROUP BY priority""",
)
def share_of_total(spark, sf):
    shares = descriptive.share_of_total(gappy(spark, sf), group_by="priority", value="price")
    return rounded(shares, ["price"], 2)


PIVOT_CELL = "round_even(coalesce({f}(o_totalprice) FILTER (o_orderstatus = '{s}'), 0), 3) AS \"{s}\""


@query(
    "pivot_summary",
    "SELECT o_orderpriority, "
    + ", ".join(PIVOT_CELL.format(f="sum", s=s) for s in "FOP")
    + " FROM orders GROUP BY o_orderpriority",
)
def pivot_summary(spark, sf):
    wide = descriptive.pivot_summary(
        table(spark, sf, "orders"), index="o_orderpriority", columns="o_orderstatus", values="o_totalprice"
    )
    return rounded(wide, ["F", "O", "P"], 3)


@query(
    "pivot_median",
    "SELECT o_orderpriority, "
    + ", ".join(PIVOT_CELL.format(f="median", s=s) for s in "FOP")
    + " FROM orders GROUP BY o_orderpriority",
)
def pivot_median(spark, sf):
    wide = descriptive.pivot_summary(
        table(spark, sf, "orders"),
        index="o_orderpriority",
        columns="o_orderstatus",
        values="o_totalprice",
        aggfunc="median",
        column_values=["F", "O", "P"],
    )
    return rounded(wide, ["F", "O", "P"], 3)


@query(
    "pivot_long",
    """SELECT l_linenumber, l_returnflag || '_' || l_linestatus AS pivot_key,
              round_even(avg(l_extendedprice), 4) AS cell
       FROM lineitem GROUP BY ALL""",
)
def pivot_long(spark, sf):
    cells = descriptive.pivot_cells(
        table(spark, sf, "lineitem"),
        index="l_linenumber",
        columns=["l_returnflag", "l_linestatus"],
        values="l_extendedprice",
        aggfunc="mean",
    )
    return rounded(cells, ["cell"], 4)


@query(
    "top_n",
    f"SELECT o_orderkey, price FROM ({GAPPY}) ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 25",
)
def top_n(spark, sf):
    orders = gappy(spark, sf).select("o_orderkey", "price")
    return descriptive.top_n(orders, by="price", n=25, order_by=["o_orderkey"])


@query(
    "bottom_n",
    f"SELECT o_orderkey, price FROM ({GAPPY}) ORDER BY price ASC NULLS LAST, o_orderkey LIMIT 25",
)
def bottom_n(spark, sf):
    orders = gappy(spark, sf).select("o_orderkey", "price")
    return descriptive.top_n(orders, by="price", n=25, ascending=True, order_by=["o_orderkey"])


def _mean_of(name, forth, back):
    """The mean of transformed values, transformed back, from a state of count and sum."""
    return UserAggregate(
        name,
        lambda: (0, 0.0),
        lambda state, values: (state[0] + len(values), state[1] + float(forth(values).sum())),
        lambda a, b: (a[0] + b[0], a[1] + b[1]),
        lambda state: float(back(state[1] / state[0])) if state[0] else None,
    )


@query(
    "aggregate_own",
    f"""SELECT status, round_even(exp(avg(ln(price))), 2) AS price_geometric,
               round_even(count(price) / sum(1 / price), 2) AS price_harmonic, count(price) AS price_count
        FROM ({GAPPY}) GROUP BY status""",
)
def aggregate_own(spark, sf):
    """Aggregates in Python next to a named one; the largest status has half of all rows."""
    means = [_mean_of("geometric", np.log, np.exp), _mean_of("harmonic", lambda v: 1 / v, lambda m: 1 / m), "count"]
    result = descriptive.aggregate(gappy(spark, sf), group_by="status", metrics={"price": means})
    return rounded(result, ["price_geometric", "price_harmonic"], 2)
