"""Exploration queries."""

from pyspark.sql import functions as F

from quarrystone.operators import exploration

from .cleansing import GAPPY, gappy
from .registry import query, rounded, table


@query(
    "overview",
    """SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols,
              (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (
                  SELECT DISTINCT l_orderkey, l_returnflag, l_quantity, l_shipdate FROM lineitem)) AS n_duplicated_rows,
              'l_orderkey,l_quantity' AS numeric_cols, 'l_returnflag' AS categorical_cols,
              'l_shipdate' AS datetime_cols
       FROM lineitem""",
)
def overview(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_shipdate")
    row = exploration.overview(lines).drop("data_mb")
    return row.withColumns({c: F.concat_ws(",", c) for c in ("numeric_cols", "categorical_cols", "datetime_cols")})


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS = """SELECT '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 4) AS mean,
                  round_even(stddev_samp({c}), 4) AS std, round_even(min({c}), 4) AS min,
                  round_even(quantile_cont({c}, 0.25), 4) AS "25%", round_even(median({c}), 4) AS "50%",
                  round_even(quantile_cont({c}, 0.75), 4) AS "75%", round_even(max({c}), 4) AS max{more}
           FROM {t}"""


@query("describe_numeric", " UNION ALL ".join(STATS.format(c=c, t="lineitem", more="") for c in LINE_NUMBERS))
def describe_numeric(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_NUMBERS)
    return rounded(exploration.describe_numeric(lines), ["mean", "std", "min", "25%", "50%", "75%", "max"], 4)


SHAPE = ", round_even(skewness({c}), 4) AS skew, round_even(kurtosis({c}), 4) AS kurtosis"


@query(
    "numeric_summary",
    " UNION ALL ".join(
        STATS.format(c=c, t=t, more=SHAPE.format(c=c))
        for c, t in [("p_size", "(SELECT CAST(p_size AS DOUBLE) AS p_size FROM part)"), ("p_retailprice", "part")]
    ),
)
def numeric_summary(spark, sf):
    return exploration.numeric_summary(table(spark, sf, "part").select("p_size", "p_retailprice"))


CATEGORY = """
    SELECT '{c}' AS "column",
           (SELECT count(DISTINCT {c}) FROM gappy) AS n_unique,
           first(v ORDER BY n DESC, v) AS top_value,
           max(n) AS top_freq,
           string_agg(v || ':' || n, ',' ORDER BY n DESC, v) AS top_values,
           (SELECT count({c}) FROM gappy) AS count
    FROM (SELECT {c} AS v, count(*) AS n FROM gappy WHERE {c} IS NOT NULL GROUP BY {c}
          ORDER BY n DESC, v LIMIT 3)"""


@query(
    "categorical_summary",
    f"WITH gappy AS ({GAPPY}) " + " UNION ALL ".join(CATEGORY.format(c=c) for c in ("priority", "status")),
)
def categorical_summary(spark, sf):
    summary = exploration.categorical_summary(gappy(spark, sf), top_n=3)
    listed = F.transform("top_values", lambda e: F.concat_ws(":", e["value"], e["count"].cast("string")))
    return summary.withColumn("top_values", F.concat_ws(",", listed))


MANY = """
    SELECT '{c}' AS "column", v AS value, n AS count FROM (
        SELECT *, row_number() OVER (ORDER BY n DESC, v) AS r FROM (
            SELECT {c}::VARCHAR AS v, count(*) AS n FROM lineitem GROUP BY 1)) WHERE r <= 1500"""


@query("categorical_leaders", " UNION ALL ".join(MANY.format(c=c) for c in ("l_partkey", "l_orderkey", "l_suppkey")))
def categorical_leaders(spark, sf):
    """More leading values than a rank filter keeps below the exchange."""
    keys = table(spark, sf, "lineitem").select(*[F.col(c).cast("string") for c in ("l_partkey", "l_orderkey", "l_suppkey")])
    summary = exploration.categorical_summary(keys, top_n=1500)
    return summary.select("column", F.inline("top_values"))


@query("value_counts", f"SELECT priority, count(*) AS count FROM ({GAPPY}) GROUP BY priority")
def value_counts(spark, sf):
    return exploration.value_counts(gappy(spark, sf), "priority")


@query(
    "value_counts_proportion",
    f"""SELECT priority, round_even(count(*) / sum(count(*)) OVER (), 6) AS proportion
        FROM ({GAPPY}) WHERE priority IS NOT NULL GROUP BY priority""",
)
def value_counts_proportion(spark, sf):
    shares = exploration.value_counts(gappy(spark, sf), "priority", normalize=True, dropna=True)
    return rounded(shares, ["proportion"], 6)


@query(
    "unique_counts",
    """SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
              count(DISTINCT l_returnflag) AS l_returnflag, count(DISTINCT l_extendedprice) AS l_extendedprice
       FROM lineitem""",
)
def unique_counts(spark, sf):
    lines = table(spark, sf, "lineitem")
    return exploration.unique_counts(lines, ["l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice"])


REPORT = """
    WITH t AS (SELECT p_size, p_retailprice, p_brand FROM part)
    SELECT 'overview' AS section, 'n_rows' AS item, count(*)::DOUBLE AS value FROM t
    UNION ALL SELECT 'overview', 'n_duplicated_rows', (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)))::DOUBLE FROM t
    UNION ALL SELECT 'numeric', 'p_size', round_even(avg(p_size), 4) FROM t
    UNION ALL SELECT 'numeric', 'p_retailprice', round_even(avg(p_retailprice), 4) FROM t
    UNION ALL SELECT 'categorical', 'p_brand', count(DISTINCT p_brand)::DOUBLE FROM t
    UNION ALL SELECT 'correlations', 'p_size,p_retailprice', r FROM (
        SELECT round_even(corr(p_size, p_retailprice), 4) AS r FROM t) WHERE abs(r) >= 0.5"""


@query("summary_report", REPORT)
def summary_report(spark, sf):
    """A row or more from each section of the bundle."""
    report = exploration.summary_report(table(spark, sf, "part").select("p_size", "p_retailprice", "p_brand"))

    def rows(section, item, value):
        return report[{"numeric": "numeric_summary", "categorical": "categorical_summary"}.get(section, section)].select(
            F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value")
        )

    counts = [rows("overview", F.lit(c), F.col(c)) for c in ("n_rows", "n_duplicated_rows")]
    numbers = rows("numeric", F.col("column"), F.col("mean"))
    texts = rows("categorical", F.col("column"), F.col("n_unique"))
    pairs = rows("correlations", F.concat_ws(",", "feature_1", "feature_2"), F.col("correlation"))
    return counts[0].unionByName(counts[1]).unionByName(numbers).unionByName(texts).unionByName(pairs)
