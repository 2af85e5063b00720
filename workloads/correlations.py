"""Correlation queries."""

from itertools import combinations

from quarrystone.operators import charts, correlation

from .registry import query, rounded, table

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART = ["p_size", "p_retailprice", "p_partkey"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE)


def _upper(pairs, r: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {r.format(a=a, b=b)} AS correlation FROM {source}"
        for a, b in pairs
    )


EVERY = [(a, b) for a in LINE for b in LINE]


@query("corr_pearson", _upper(EVERY, "round_even(corr({a}, {b}), 4)", "lineitem"))
def corr_pearson(spark, sf):
    return correlation.correlation_matrix(_lines(spark, sf))


@query(
    "corr_matrix_wide",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature, " + ", ".join(f"round_even(corr({a}, {b}), 4) AS {b}" for b in LINE) + " FROM lineitem"
        for a in LINE
    ),
)
def corr_matrix_wide(spark, sf):
    return correlation.as_matrix(correlation.correlation_matrix(_lines(spark, sf)), LINE)


RANKS = "(SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in LINE
) + " FROM lineitem)"


@query(
    "corr_spearman",
    f"WITH ranks AS {RANKS} " + _upper(list(combinations(LINE, 2)), "round_even(corr({a}, {b}), 4)", "ranks"),
)
def corr_spearman(spark, sf):
    pairs = correlation.correlate_pairs(_lines(spark, sf), list(combinations(LINE, 2)), "spearman")
    return rounded(pairs, ["correlation"], 4)


TAU = """
    SELECT '{a}' AS feature_1, '{b}' AS feature_2,
           round_even(sum(sign(x.{a} - y.{a}) * sign(x.{b} - y.{b}))
                      / (sqrt(count_if(x.{a} <> y.{a})) * sqrt(count_if(x.{b} <> y.{b}))), 4) AS correlation
    FROM part x, part y"""


@query("corr_kendall", " UNION ALL ".join(TAU.format(a=a, b=b) for a, b in combinations(PART, 2)))
def corr_kendall(spark, sf):
    parts = table(spark, sf, "part").select(*PART)
    return rounded(correlation.correlate_pairs(parts, list(combinations(PART, 2)), "kendall"), ["correlation"], 4)


@query(
    "top_correlations",
    "SELECT * FROM ("
    + _upper(list(combinations(LINE, 2)), "round_even(corr({a}, {b}), 4)", "lineitem")
    + ") WHERE abs(correlation) >= 0.001",
)
def top_correlations(spark, sf):
    return correlation.top_correlations(_lines(spark, sf), threshold=0.001)


@query(
    "corr_with_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round_even(corr({c}, l_extendedprice), 6) AS correlation FROM lineitem"
        for c in LINE
        if c != "l_extendedprice"
    ),
)
def corr_with_target(spark, sf):
    ranked = correlation.correlation_with_target(_lines(spark, sf), "l_extendedprice")
    return rounded(ranked, ["correlation"], 6)


@query("corr_heatmap", _upper(EVERY, "round_even(corr({a}, {b}), 8)", "lineitem"))
def corr_heatmap(spark, sf):
    return rounded(charts.correlation_heatmap(_lines(spark, sf)), ["correlation"], 8)
