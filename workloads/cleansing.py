"""Cleansing queries.  The tables hold no gaps, so a derived view has some."""

from pyspark.sql import functions as F

from quarrystone.operators import cleansing

from .registry import query, rounded, table

# Orders with gaps in a number and in a text, and blanks around a text.
GAPPY = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
           CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END AS priority,
           o_orderstatus AS status
    FROM orders"""


def gappy(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "clean_names",
    "SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderpriority AS priority FROM orders",
)
def clean_names(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return cleansing.standardize_column_names(orders.toDF(" Order  Key", "Total Price ($)", "PRIORITY "))


@query(
    "strip_whitespace",
    "SELECT c_custkey, c_name, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS segment FROM customer",
)
def strip_whitespace(spark, sf):
    customers = table(spark, sf, "customer")
    blank = customers.select(
        "c_custkey",
        F.concat(F.lit(" \t"), "c_name", F.lit("\n ")).alias("c_name"),
        F.when(F.col("c_nationkey") != 3, F.concat("c_mktsegment", F.lit("  "))).alias("segment"),
    )
    return cleansing.strip_whitespace(blank)


@query(
    "convert_numeric",
    "SELECT p_partkey, TRY_CAST(CASE WHEN p_type = 'PROMO' THEN 'unknown' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS size FROM part",
)
def convert_numeric(spark, sf):
    parts = table(spark, sf, "part")
    text = F.when(F.col("p_type") == "PROMO", "unknown").otherwise(F.col("p_size").cast("string"))
    return cleansing.convert_dtypes(parts.select("p_partkey", text.alias("size")), to_numeric=["size"])


@query(
    "convert_datetime",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS ordered FROM orders",
)
def convert_datetime(spark, sf):
    orders = table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.col("o_orderdate").cast("string"))
    return cleansing.convert_dtypes(orders.select("o_orderkey", text.alias("ordered")), to_datetime=["ordered"])


@query(
    "convert_category",
    f"""SELECT o_orderkey, priority,
           CASE WHEN priority IS NOT NULL
                THEN CAST(dense_rank() OVER (ORDER BY priority NULLS LAST) - 1 AS INTEGER) END AS priority_code
        FROM ({GAPPY})""",
)
def convert_category(spark, sf):
    return cleansing.convert_dtypes(gappy(spark, sf).select("o_orderkey", "priority"), to_category=["priority"])


@query(
    "dedupe_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem",
)
def dedupe_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    return cleansing.drop_duplicates(lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


ORDERED = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {0}, o_orderkey {0})"
KEPT = "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY {} = 1"


@query("dedupe_first", KEPT.format(ORDERED.format("ASC")))
def dedupe_first(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return cleansing.drop_duplicates(orders, subset=["o_custkey"], order_by=["o_orderdate", "o_orderkey"])


@query("dedupe_last", KEPT.format(ORDERED.format("DESC")))
def dedupe_last(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return cleansing.drop_duplicates(
        orders, subset=["o_custkey"], keep="last", order_by=["o_orderdate", "o_orderkey"]
    )


@query(
    "dedupe_none",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
       QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
)
def dedupe_none(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return cleansing.drop_duplicates(lines, subset=["l_orderkey", "l_linenumber"], keep=False)


@query(
    "duplicate_count",
    """SELECT CAST((SELECT count(*) FROM lineitem)
                   - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT)
              AS n_duplicated""",
)
def duplicate_count(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return spark.range(1).select(cleansing.duplicated_row_count(lines).alias("n_duplicated"))


@query("missing_drop_rows", f"SELECT * FROM ({GAPPY}) WHERE price IS NOT NULL AND priority IS NOT NULL")
def missing_drop_rows(spark, sf):
    return cleansing.handle_missing(gappy(spark, sf), strategy="drop_rows")


@query("missing_drop_cols", f"SELECT o_orderkey, o_custkey, status FROM ({GAPPY})")
def missing_drop_cols(spark, sf):
    return cleansing.handle_missing(gappy(spark, sf), strategy="drop_cols")


FILLED = """
    WITH gappy AS ({gappy})
    SELECT o_orderkey, round_even(coalesce(price, (SELECT {stat}(price) FROM gappy)), 4) AS price, priority
    FROM gappy"""


@query("missing_mean", FILLED.format(gappy=GAPPY, stat="avg"))
def missing_mean(spark, sf):
    filled = cleansing.handle_missing(gappy(spark, sf), strategy="mean", columns=["price", "priority"])
    return rounded(filled.select("o_orderkey", "price", "priority"), ["price"], 4)


@query("missing_median", FILLED.format(gappy=GAPPY, stat="median"))
def missing_median(spark, sf):
    filled = cleansing.handle_missing(gappy(spark, sf), strategy="median", columns=["price"])
    return rounded(filled.select("o_orderkey", "price", "priority"), ["price"], 4)


@query(
    "missing_mode",
    f"""WITH gappy AS ({GAPPY}),
             top AS (SELECT priority FROM gappy WHERE priority IS NOT NULL
                     GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1),
             top_price AS (SELECT price FROM gappy WHERE price IS NOT NULL
                           GROUP BY price ORDER BY count(*) DESC, price LIMIT 1)
        SELECT o_orderkey, coalesce(price, (SELECT price FROM top_price)) AS price,
               coalesce(priority, (SELECT priority FROM top)) AS priority
        FROM gappy""",
)
def missing_mode(spark, sf):
    filled = cleansing.handle_missing(gappy(spark, sf), strategy="mode")
    return filled.select("o_orderkey", "price", "priority")


@query("missing_constant", f"SELECT o_orderkey, price, coalesce(priority, 'none') AS priority FROM ({GAPPY})")
def missing_constant(spark, sf):
    filled = cleansing.handle_missing(
        gappy(spark, sf), strategy="constant", columns=["priority"], fill_value="none"
    )
    return filled.select("o_orderkey", "price", "priority")


FENCES = """
    WITH gappy AS ({gappy}),
         q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM gappy),
         f AS (SELECT q1 - 0.5 * (q3 - q1) AS lo, q3 + 0.5 * (q3 - q1) AS hi FROM q)"""


@query(
    "outlier_flags",
    FENCES.format(gappy=GAPPY)
    + " SELECT o_orderkey, price, coalesce(price < lo OR price > hi, FALSE) AS is_outlier FROM gappy, f",
)
def outlier_flags(spark, sf):
    orders = gappy(spark, sf).select("o_orderkey", "price")
    return cleansing.detect_outliers_iqr(orders, "price", factor=0.5)


@query(
    "outlier_cap",
    FENCES.format(gappy=GAPPY)
    + """ SELECT o_orderkey, round_even(CASE WHEN price IS NULL THEN NULL WHEN price < lo THEN lo
                 WHEN price > hi THEN hi ELSE price END, 4) AS price FROM gappy, f""",
)
def outlier_cap(spark, sf):
    orders = gappy(spark, sf).select("o_orderkey", "price")
    return rounded(cleansing.cap_outliers_iqr(orders, "price", factor=0.5), ["price"], 4)


@query(
    "clean_all",
    """SELECT DISTINCT o_custkey AS customer, o_orderpriority AS priority, o_orderstatus AS status
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def clean_all(spark, sf):
    orders = table(spark, sf, "orders")
    raw = orders.select(
        F.col("o_custkey").alias(" Customer"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("PRIORITY"),
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", F.lit("\t"))).alias("Status "),
    )
    return cleansing.clean_pipeline(raw)


def _per_column(body: str, columns) -> str:
    return " UNION ALL ".join(body.format(c=c, **extra) for c, extra in columns)


@query(
    "missing_report",
    f"WITH gappy AS ({GAPPY}) SELECT * FROM ("
    + _per_column(
        """SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing,
                  round_even((count(*) - count({c})) * 100.0 / count(*), 2) AS pct_missing FROM gappy""",
        [(c, {}) for c in ("o_orderkey", "o_custkey", "price", "priority", "status")],
    )
    + ") WHERE n_missing > 0",
)
def missing_report(spark, sf):
    return cleansing.missing_value_report(gappy(spark, sf))


@query(
    "quality_report",
    f"WITH gappy AS ({GAPPY}) "
    + _per_column(
        """SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS n_missing,
                  round_even((count(*) - count({c})) * 100.0 / count(*), 2) AS pct_missing,
                  count(DISTINCT {c}) AS n_unique FROM gappy""",
        [
            (c, {"t": t})
            for c, t in (
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("price", "double"),
                ("priority", "string"),
                ("status", "string"),
            )
        ],
    ),
)
def quality_report(spark, sf):
    return cleansing.quality_report(gappy(spark, sf))
