"""Queries for the tables behind charts."""

import math

from pyspark.sql import functions as F

from quarrystone.operators import charts

from .cleansing import GAPPY, gappy
from .registry import query, rounded, table

HISTOGRAM = """
    WITH {extra} e AS (SELECT min({c}) AS lo, max({c}) AS hi, {bins} AS bins FROM {t}),
         k AS (SELECT CAST(least(floor(({c} - lo) * bins / (hi - lo)), bins - 1) AS INTEGER) AS bin, count(*) AS n
               FROM {t}, e WHERE {c} IS NOT NULL GROUP BY 1)
    SELECT s.bin, round_even(lo + s.bin * ((hi - lo) / bins), 4) AS bin_start,
           round_even(lo + (s.bin + 1) * ((hi - lo) / bins), 4) AS bin_end, coalesce(n, 0) AS count
    FROM (SELECT CAST(unnest(range(bins)) AS INTEGER) AS bin FROM e) s CROSS JOIN e LEFT JOIN k ON k.bin = s.bin"""


@query("histogram", HISTOGRAM.format(c="l_extendedprice", t="lineitem", bins="30", extra=""))
def histogram(spark, sf):
    bins = charts.histogram_bins(table(spark, sf, "lineitem"), "l_extendedprice", bins=30)
    return rounded(bins, ["bin_start", "bin_end"], 4)


AUTO_BINS = """CAST(ceil((max({c}) - min({c})) / least((max({c}) - min({c})) / (log2(count({c})) + 1),
    2 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) / pow(count({c}), 1.0 / 3))) AS INTEGER)"""


@query(
    "distribution_histogram",
    HISTOGRAM.format(c="o_totalprice", t="orders", bins=AUTO_BINS.format(c="o_totalprice"), extra=""),
)
def distribution_histogram(spark, sf):
    bins = charts.distribution(table(spark, sf, "orders"), "o_totalprice", kde=False)["histogram"]
    return rounded(bins, ["bin_start", "bin_end"], 4)


DENSITY = """
    WITH s AS (SELECT {key} count({c}) AS n, stddev_samp({c}) * pow(count({c}), -0.2) AS h, min({c}) AS lo,
                      max({c}) AS hi FROM {t} {group}),
         g AS (SELECT *, lo - {cut} * h AS a, (hi - lo + 2 * {cut} * h) / {last} AS step,
                      unnest(range({last} + 1)) AS i FROM s)
    SELECT {gkey} round_even(a + i * step, 4) AS x,
           round_even(sum(exp(-0.5 * pow((a + i * step - {c}) / h, 2)) / (n * h * {root})), 8) AS density
    FROM g JOIN {t} d {on} GROUP BY ALL"""
ROOT = math.sqrt(2 * math.pi)


@query(
    "density_curve",
    DENSITY.format(
        key="", gkey="", c="p_retailprice", t="part", group="", cut=0, last=199, on="ON TRUE", root=ROOT
    ),
)
def density_curve(spark, sf):
    curve = charts.distribution(table(spark, sf, "part"), "p_retailprice")["curve"]
    return rounded(rounded(curve, ["x"], 4), ["density"], 8)


@query(
    "violin_curves",
    DENSITY.format(
        key="p_type,", gkey="g.p_type,", c="p_retailprice", t="part", group="GROUP BY p_type", cut=2, last=99,
        on="ON d.p_type = g.p_type", root=ROOT,
    ),
)
def violin_curves(spark, sf):
    curves = charts.violin_stats(table(spark, sf, "part"), y="p_retailprice", x="p_type")["curves"]
    return rounded(rounded(curves, ["x"], 4), ["density"], 8)


BOX = """
    WITH q AS (SELECT {k} quantile_cont({y}, 0.25) AS q1, median({y}) AS median, quantile_cont({y}, 0.75) AS q3
               FROM {t} WHERE {present} {group}),
         d AS (SELECT q.*, {y} AS y, {y} BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1) AS inside
               FROM q JOIN {t} d ON {on} AND {y} IS NOT NULL)
    SELECT {k} count(*) AS n, round_even(q1, 4) AS q1, round_even(median, 4) AS median, round_even(q3, 4) AS q3,
           min(y) FILTER (inside) AS whisker_low, max(y) FILTER (inside) AS whisker_high,
           count(*) FILTER (NOT inside) AS n_outliers
    FROM d GROUP BY {k} q1, median, q3"""


@query(
    "box_stats",
    f"WITH gappy AS ({GAPPY}) SELECT * FROM ("
    + BOX.format(k="priority,", y="price", t="gappy", present="priority IS NOT NULL", group="GROUP BY priority",
                 on="d.priority = q.priority").replace("SELECT q.*,", "SELECT q.*,")
    + ")",
)
def box_stats(spark, sf):
    boxes = charts.box_stats(gappy(spark, sf), y="price", x="priority", factor=0.5)
    return rounded(boxes, ["q1", "median", "q3"], 4)


@query("box_overall", BOX.format(k="", y="l_extendedprice", t="lineitem", present="TRUE", group="", on="TRUE"))
def box_overall(spark, sf):
    boxes = charts.box_stats(table(spark, sf, "lineitem"), y="l_extendedprice", factor=0.5)
    return rounded(boxes, ["q1", "median", "q3"], 4)


@query(
    "box_outliers",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
       SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN q USING (l_returnflag)
       WHERE l_extendedprice < q1 - 0.4 * (q3 - q1) OR l_extendedprice > q3 + 0.4 * (q3 - q1)""",
)
def box_outliers(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return charts.box_outliers(lines, y="l_extendedprice", x="l_returnflag", factor=0.4)


@query("category_counts", "SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1")
def category_counts(spark, sf):
    return charts.category_counts(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "category_counts_top",
    "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_partkey LIMIT 10",
)
def category_counts_top(spark, sf):
    return charts.category_counts(table(spark, sf, "lineitem"), "l_partkey", top_n=10)


BIN = "CAST(least(floor(({c} - {c}_lo) * {n} / ({c}_hi - {c}_lo)), {n} - 1) AS INTEGER)"


def _ends(columns, t):
    return "e AS (SELECT " + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in columns) + f" FROM {t})"


@query(
    "scatter_grid",
    f"""WITH {_ends(['l_quantity', 'l_extendedprice'], 'lineitem')},
             k AS (SELECT l_returnflag, {BIN.format(c='l_quantity', n=50)} AS x_bin,
                          {BIN.format(c='l_extendedprice', n=50)} AS y_bin, count(*) AS count
                   FROM lineitem, e GROUP BY ALL)
        SELECT l_returnflag, x_bin, y_bin,
               round_even(l_quantity_lo + (x_bin + 0.5) * (l_quantity_hi - l_quantity_lo) / 50, 4) AS x_centre,
               round_even(l_extendedprice_lo + (y_bin + 0.5) * (l_extendedprice_hi - l_extendedprice_lo) / 50, 4)
                   AS y_centre, count
        FROM k, e""",
)
def scatter_grid(spark, sf):
    cells = charts.scatter_grid(
        table(spark, sf, "lineitem"), x="l_quantity", y="l_extendedprice", hue="l_returnflag"
    )
    return rounded(cells, ["x_centre", "y_centre"], 4)


PAIRS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "pair_grid",
    f"WITH {_ends(PAIRS, 'lineitem')}, b AS (SELECT l_returnflag, "
    + ", ".join(f"{BIN.format(c=c, n=20)} AS {c}" for c in PAIRS)
    + " FROM lineitem, e) "
    + " UNION ALL ".join(
        f"""SELECT l_returnflag, '{a}' AS feature_x, '{b}' AS feature_y, {a} AS x_bin, {b} AS y_bin,
                   count(*) AS count FROM b GROUP BY ALL"""
        for i, a in enumerate(PAIRS)
        for b in PAIRS[i:]
    ),
)
def pair_grid(spark, sf):
    return charts.pair_grid(table(spark, sf, "lineitem"), columns=PAIRS, hue="l_returnflag")


@query(
    "missing_patterns",
    f"""SELECT '00' || CASE WHEN price IS NULL THEN '1' ELSE '0' END
                    || CASE WHEN priority IS NULL THEN '1' ELSE '0' END || '0' AS pattern,
               concat_ws(',', CASE WHEN price IS NULL THEN 'price' END,
                         CASE WHEN priority IS NULL THEN 'priority' END) AS missing_columns, count(*) AS count
        FROM ({GAPPY}) GROUP BY ALL""",
)
def missing_patterns(spark, sf):
    patterns = charts.missing_patterns(gappy(spark, sf))
    return patterns.withColumn("missing_columns", F.concat_ws(",", "missing_columns"))


@query("category_series", "SELECT CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part")
def category_series(spark, sf):
    return charts.category_series(table(spark, sf, "part"), x="p_size", y="p_retailprice")


@query("line_series", "SELECT ts, value FROM events")
def line_series(spark, sf):
    return charts.line_series(table(spark, sf, "events"), x="ts", y="value")
