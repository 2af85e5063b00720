"""Splits, folds, metrics and models."""

from pyspark.sql import functions as F

from quarrystone.operators import charts, correlation, modeling, prescriptive, splitting
from quarrystone.plans.scratch import scratch_folder

from .registry import query, rounded, table

# A hash both engines compute alike: multiplicative hashing modulo 2**32.
MIX, RANGE = 2654435761, 4294967296
HASH_SQL = f"(o_orderkey * {MIX}) % {RANGE}"


def _mixed(column):
    return ((F.col(column) if isinstance(column, str) else column) * F.lit(MIX)) % F.lit(RANGE)


def _parts(pair):
    train, test = pair
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("o_orderkey", "part")


@query(
    "split_exact",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {HASH_SQL}, o_orderkey)
               <= ceil((SELECT count(*) FROM orders) * 0.25) THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def split_exact(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return _parts(
        splitting.train_test(orders, test_size=0.25, key="o_orderkey", order_hash=_mixed("o_orderkey"))
    )


@query(
    "split_stratified",
    f"""WITH c AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1),
             w AS (SELECT *, ceil(sum(n) OVER () * 0.2) AS take_all, ceil(sum(n) OVER () * 0.2) * n / sum(n) OVER () AS quota FROM c),
             t AS (SELECT s, floor(quota) + CASE WHEN row_number() OVER (ORDER BY quota - floor(quota) DESC, s)
                          <= take_all - sum(floor(quota)) OVER () THEN 1 ELSE 0 END AS take FROM w)
        SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey)
               <= take THEN 'test' ELSE 'train' END AS part FROM orders JOIN t ON s = o_orderstatus""",
)
def split_stratified(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return _parts(
        splitting.train_test(
            orders, test_size=0.2, stratify="o_orderstatus", key="o_orderkey", order_hash=_mixed("o_orderkey")
        )
    )


@query(
    "split_copies",
    """SELECT part, sum(n)::BIGINT AS n FROM (
         SELECT 'test' AS part, ceil(count(*) * 0.3)::BIGINT AS n FROM lineitem UNION ALL
         SELECT 'train', (count(*) - ceil(count(*) * 0.3))::BIGINT FROM lineitem) GROUP BY part""",
)
def split_copies(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_discount")
    train, test = splitting.train_test(lines, test_size=0.3)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("n"))


@query(
    "split_features_target",
    "SELECT p_brand, p_type, p_size FROM part",
)
def split_features_target(spark, sf):
    return splitting.split_features_target(
        table(spark, sf, "part"), "p_retailprice", drop=["p_partkey", "p_name"]
    ).X


@query(
    "cv_folds",
    """SELECT o_orderkey, CAST(CASE WHEN p < (n % 7) * (n // 7 + 1) THEN p // (n // 7 + 1)
              ELSE (n % 7) + (p - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS p,
                    count(*) OVER () AS n FROM orders)""",
)
def cv_folds(spark, sf):
    folds = splitting.assign_folds(table(spark, sf, "orders"), cv=7, order_by=["o_orderdate", "o_orderkey"])
    return folds.select("o_orderkey", "fold")


# Class members are dealt modulo cv over all rows in class order, then laid out in order.
FOLD_END = "n // 5 + CASE WHEN (({i} - s) % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END"


@query(
    "cv_folds_stratified",
    """WITH g AS (SELECT o_orderkey, o_orderpriority AS c,
                         row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS p FROM orders),
            z AS (SELECT *, count(*) OVER (PARTITION BY c) AS n, min(p) OVER (PARTITION BY c) AS s FROM g),
            e AS (SELECT *, p - s AS j, """
    + ", ".join(f"{FOLD_END.format(i=i)} AS e{i}" for i in range(4))
    + """ FROM z)
       SELECT o_orderkey, CAST((j >= e0)::INTEGER + (j >= e0 + e1)::INTEGER + (j >= e0 + e1 + e2)::INTEGER
              + (j >= e0 + e1 + e2 + e3)::INTEGER AS INTEGER) AS fold FROM e""",
)
def cv_folds_stratified(spark, sf):
    folds = splitting.assign_folds(
        table(spark, sf, "orders"), cv=5, order_by="o_orderkey", label="o_orderpriority"
    )
    return folds.select("o_orderkey", "fold")


def _guessed(spark, sf):
    guess = F.when(F.col("o_totalprice") > 300000, "F").when(F.col("o_totalprice") > 150000, "O").otherwise("F")
    return table(spark, sf, "orders").select("o_orderstatus", guess.alias("prediction"))


GUESS = """SELECT o_orderstatus AS y, CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 150000 THEN 'O'
                  ELSE 'F' END AS p FROM orders"""


@query(
    "confusion",
    f"""WITH g AS ({GUESS}), l AS (SELECT y AS c FROM g UNION SELECT p FROM g)
        SELECT a.c AS "true", b.c AS predicted, count(g.y) AS count
        FROM l a CROSS JOIN l b LEFT JOIN g ON g.y = a.c AND g.p = b.c GROUP BY ALL""",
)
def confusion(spark, sf):
    return modeling.confusion_matrix(_guessed(spark, sf), label="o_orderstatus")


@query(
    "classification_metrics",
    f"""WITH g AS ({GUESS}),
             c AS (SELECT y, count(*) AS n, count(*) FILTER (y = p) AS hit, (SELECT count(*) FROM g h WHERE h.p = g.y) AS said
                   FROM g GROUP BY y),
             m AS (SELECT n, hit, CASE WHEN said = 0 THEN 0 ELSE hit * 1.0 / said END AS pr, hit * 1.0 / n AS re FROM c)
        SELECT round_even(sum(hit) * 1.0 / sum(n), 4) AS accuracy,
               round_even(sum(n * pr) / sum(n), 4) AS precision_weighted,
               round_even(sum(n * re) / sum(n), 4) AS recall_weighted,
               round_even(sum(n * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / sum(n), 4) AS f1_weighted
        FROM m""",
)
def classification_metrics(spark, sf):
    return modeling.classification_metrics(_guessed(spark, sf), label="o_orderstatus")


@query(
    "regression_metrics",
    """SELECT round_even(1 - avg(pow(y - p, 2)) / var_pop(y), 4) AS r2, round_even(avg(abs(y - p)), 4) AS mae,
              round_even(sqrt(avg(pow(y - p, 2))), 4) AS rmse
       FROM (SELECT l_extendedprice AS y, 2100 * l_quantity AS p FROM lineitem)""",
)
def regression_metrics(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("prediction", 2100 * F.col("l_quantity"))
    return modeling.regression_metrics(lines, label="l_extendedprice")


KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_HASH_SQL = f"(l_orderkey * {MIX}) % {RANGE}"
# The test part by the hash both engines share, then the columns the models see.
LINES_SPLIT = f"""
    SELECT *, row_number() OVER (ORDER BY {LINE_HASH_SQL}, {", ".join(KEY)}) <= ceil(round(count(*) OVER () * 0.2, 9)) AS test
    FROM (SELECT {", ".join(KEY)}, {{columns}} FROM lineitem)"""
METRICS = """round_even(1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)), 4) AS r2, round_even(avg(abs(y - f)), 4) AS mae,
             round_even(sqrt(avg(pow(y - f, 2))), 4) AS rmse"""
LINE_FIT = f"""
    WITH p AS ({LINES_SPLIT.format(columns="l_quantity AS x, l_extendedprice AS y")}),
         m AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, stddev_pop(x) AS sd FROM p WHERE NOT test),
         e AS (SELECT y, a * x + b AS f FROM p CROSS JOIN m WHERE test)
    """


def _prices(spark, sf):
    return table(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_extendedprice")


def _price_line(spark, sf):
    return modeling.train_regressor(
        _prices(spark, sf), "l_extendedprice", model="linear", drop=KEY, key=KEY, order_hash=_mixed("l_orderkey")
    )


@query("train_linear", LINE_FIT + f"SELECT {METRICS} FROM e")
def train_linear(spark, sf):
    return _price_line(spark, sf)["metrics"]


@query(
    "feature_importance",
    LINE_FIT + "SELECT 'numeric__l_quantity' AS feature, round_even(abs(a) * sd, 4) AS importance FROM m",
)
def feature_importance(spark, sf):
    return rounded(modeling.get_feature_importance(_price_line(spark, sf)), ["importance"], 4)


@query(
    "top_importances",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round_even(abs(corr({c}, l_extendedprice)), 6) AS importance FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    )
    + " ORDER BY importance DESC, feature LIMIT 3",
)
def top_importances(spark, sf):
    """The three features that a univariate model of the price leans on most."""
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice")
    strengths = correlation.correlation_with_target(lines, "l_extendedprice")
    found = charts.top_importances(strengths.select("feature", F.abs("correlation").alias("importance")), top_n=3)
    return rounded(found, ["importance"], 6)


PRICED = LINE_FIT + """
    SELECT v::DOUBLE AS l_quantity, count(*) AS n, round_even(avg(a * v + b), 4) AS prediction
    FROM p CROSS JOIN m CROSS JOIN (SELECT unnest([10, 25, 40]) AS v) WHERE test GROUP BY v"""


@query("scenario_model", PRICED)
def scenario_model(spark, sf):
    """What a fitted model predicts for every test row if its quantity were another."""
    result = _price_line(spark, sf)
    base = result["predictions"].select(*KEY, "l_quantity", "l_extendedprice")
    sweep = prescriptive.scenario_analysis(
        result["pipeline"], base, variable="l_quantity", values=[10.0, 25.0, 40.0], allow_many=True
    )
    groups = sweep.groupBy("l_quantity").agg(F.count("*").alias("n"), F.avg("prediction").alias("prediction"))
    return rounded(groups, ["prediction"], 4)


# A target that is a rule on two features is met exactly on rows the model has not seen.
STEPS = "CASE WHEN l_linenumber > 3 THEN 10.0 ELSE 20.0 END + CASE WHEN l_returnflag = 'R' THEN 5.0 ELSE 0.0 END"
STEPS_FIT = f"""
    WITH p AS ({LINES_SPLIT.format(columns=f"l_returnflag, l_linenumber AS line, ({STEPS})::DOUBLE AS y")}),
         m AS (SELECT l_returnflag, line, avg(y) AS f FROM p WHERE NOT test GROUP BY ALL)
    SELECT {METRICS} FROM p JOIN m USING (l_returnflag, line) WHERE test"""


def _stepped(spark, sf, model):
    lines = table(spark, sf, "lineitem").select(
        *KEY, "l_returnflag", F.col("l_linenumber").alias("line"), "l_quantity", F.expr(STEPS).cast("double").alias("step")
    )
    return modeling.train_regressor(
        lines, "step", model=model, drop=KEY, key=KEY, order_hash=_mixed("l_orderkey")
    )


@query("train_forest", STEPS_FIT)
def train_forest(spark, sf):
    return _stepped(spark, sf, "random_forest")["metrics"]


@query("train_boosted", STEPS_FIT)
def train_boosted(spark, sf):
    return _stepped(spark, sf, "gradient_boosting")["metrics"]


SOON = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'soon' ELSE 'later' END"
# Every test row meets the class of the training rows with its priority.
SOON_FIT = f"""
    WITH r AS (SELECT o_orderkey, o_orderpriority, {SOON} AS y FROM orders),
         c AS (SELECT y, count(*) AS n FROM r GROUP BY 1),
         w AS (SELECT *, ceil(sum(n) OVER () * 0.2) AS take_all, ceil(sum(n) OVER () * 0.2) * n / sum(n) OVER () AS quota FROM c),
         t AS (SELECT y, floor(quota) + CASE WHEN row_number() OVER (ORDER BY quota - floor(quota) DESC, y)
                      <= take_all - sum(floor(quota)) OVER () THEN 1 ELSE 0 END AS take FROM w),
         s AS (SELECT r.*, row_number() OVER (PARTITION BY r.y ORDER BY {HASH_SQL}, o_orderkey) <= take AS test
               FROM r JOIN t ON r.y = t.y),
         m AS (SELECT o_orderpriority, mode(y) AS f FROM s WHERE NOT test GROUP BY 1),
         e AS (SELECT y, f FROM s JOIN m USING (o_orderpriority) WHERE test)
    """
SOON_CELLS = SOON_FIT + """SELECT a.y AS "true", b.y AS predicted, count(e.y) AS count
    FROM c a CROSS JOIN c b LEFT JOIN e ON e.y = a.y AND e.f = b.y GROUP BY ALL"""


def _soon(spark, sf, model):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", F.expr(SOON).alias("due")
    )
    return modeling.train_classifier(
        orders, "due", model=model, drop=["o_orderkey"], key="o_orderkey", order_hash=_mixed("o_orderkey")
    )


@query(
    "train_logistic",
    SOON_FIT + """SELECT avg((y = f)::INTEGER) AS accuracy, avg((y = f)::INTEGER) AS precision_weighted,
                         avg((y = f)::INTEGER) AS recall_weighted, avg((y = f)::INTEGER) AS f1_weighted FROM e""",
)
def train_logistic(spark, sf):
    return _soon(spark, sf, "logistic")["metrics"]


@query("train_forest_classifier", SOON_CELLS)
def train_forest_classifier(spark, sf):
    return _soon(spark, sf, "random_forest")["confusion_matrix"]


@query("train_boosted_classifier", SOON_CELLS)
def train_boosted_classifier(spark, sf):
    return _soon(spark, sf, "gradient_boosting")["confusion_matrix"]


@query(
    "kmeans_sizes",
    """WITH p AS (SELECT p_partkey % 4 AS g, 1000 * (p_partkey % 2) + p_size AS x, 1000 * (p_partkey % 4 // 2) + p_size AS y
                  FROM part),
            z AS (SELECT g, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM p),
            c AS (SELECT g, count(*) AS n, avg(x) AS cx, avg(y) AS cy, var_pop(x) + var_pop(y) AS v FROM z GROUP BY g),
            s AS (SELECT z.i, max(CASE WHEN z.g = c.g THEN (pow(z.x - cx, 2) + pow(z.y - cy, 2) + v) * n / (n - 1) END) AS a,
                         min(CASE WHEN z.g <> c.g THEN pow(z.x - cx, 2) + pow(z.y - cy, 2) + v END) AS b
                  FROM (SELECT *, row_number() OVER () AS i FROM z) z CROSS JOIN c GROUP BY 1)
       SELECT g AS first_group, g AS last_group, n, round_even((SELECT sum(n * v) FROM c), 4) AS inertia,
              round_even((SELECT avg((b - a) / greatest(a, b)) FROM s), 4) AS silhouette FROM c""",
)
def kmeans_sizes(spark, sf):
    group = F.col("p_partkey") % 4
    parts = table(spark, sf, "part").select(
        group.alias("g"),
        (1000 * (F.col("p_partkey") % 2) + F.col("p_size")).alias("x"),
        (1000 * F.floor(group / 2) + F.col("p_size")).alias("y"),
    )
    result = modeling.cluster_kmeans(parts, n_clusters=4, features=["x", "y"])
    sizes = result["labels"].groupBy("cluster").agg(
        F.min("g").alias("first_group"), F.max("g").alias("last_group"), F.count("*").alias("n")
    )
    return sizes.drop("cluster").withColumns(
        {"inertia": F.lit(result["inertia"]), "silhouette": F.lit(result["silhouette_squared_euclidean"])}
    )


@query(
    "cross_validated_linear",
    f"""WITH q AS (SELECT l_quantity AS x, l_extendedprice AS y, count(*) OVER () AS n,
                          row_number() OVER (ORDER BY {", ".join(KEY)}, l_quantity, l_extendedprice) - 1 AS p FROM lineitem),
             g AS (SELECT x, y, CAST(CASE WHEN p < (n % 3) * (n // 3 + 1) THEN p // (n // 3 + 1)
                          ELSE (n % 3) + (p - (n % 3) * (n // 3 + 1)) // (n // 3) END AS INTEGER) AS fold FROM q),
             m AS (SELECT k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
                   FROM g JOIN range(3) r(k) ON fold <> k GROUP BY k)
        SELECT fold, round_even(1 - sum(pow(y - a * x - b, 2)) / (var_pop(y) * count(*)), 4) AS score
        FROM g JOIN m ON fold = k GROUP BY fold""",
)
def cross_validated_linear(spark, sf):
    lines = _prices(spark, sf)
    parts = splitting.split_features_target(lines, "l_extendedprice", drop=KEY)
    stages = modeling.build_model_pipeline(
        modeling.regressor("linear", "l_extendedprice", 42), modeling.build_preprocessor(lines, parts.features)
    )
    result = modeling.cross_validate(stages, lines, "l_extendedprice", order_by=lines.columns, cv=3)
    rows = [(i, float(s)) for i, s in enumerate(result["scores"])]
    return spark.createDataFrame(rows, "fold int, score double")


@query("model_round_trip", LINE_FIT + f"SELECT {METRICS}, 0::BIGINT AS changed_predictions FROM e")
def model_round_trip(spark, sf):
    """The metrics of a model that was saved and loaded, and how many predictions that changed."""
    result = _price_line(spark, sf)
    again = modeling.load_model(modeling.save_model(result["pipeline"], scratch_folder(spark)))
    test = result["predictions"]
    compared = again.transform(test.select(*KEY, "l_quantity", "l_extendedprice", F.col("prediction").alias("before")))
    changed = compared.agg(F.count_if(F.col("prediction") != F.col("before"))).scalar()
    metrics = modeling.regression_metrics(compared, label="l_extendedprice")
    return metrics.withColumn("changed_predictions", changed)
