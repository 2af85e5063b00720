import pytest

from quarrystone.operators import correlation, exploration


def test_overview(clean_df):
    row = exploration.overview(clean_df).first()
    assert (row["n_rows"], row["n_cols"], row["n_duplicated_rows"]) == (6, 5, 0)
    assert row["numeric_cols"] == ["sales", "cost", "profit"]
    assert row["categorical_cols"] == ["region", "channel"] and row["datetime_cols"] == []
    assert exploration.overview(clean_df.union(clean_df)).first()["n_duplicated_rows"] == 6


def test_numeric_summary(clean_df):
    rows = {r["column"]: r for r in exploration.numeric_summary(clean_df).collect()}
    frame = clean_df.toPandas()[["sales", "cost", "profit"]]
    for c in frame:
        assert rows[c]["mean"] == pytest.approx(frame[c].mean(), abs=1e-4)
        assert rows[c]["std"] == pytest.approx(frame[c].std(), abs=1e-4)
        assert rows[c]["25%"] == pytest.approx(frame[c].quantile(0.25))
        assert rows[c]["skew"] == pytest.approx(frame[c].skew(), abs=1e-4)
        assert rows[c]["kurtosis"] == pytest.approx(frame[c].kurtosis(), abs=1e-4)


def test_numeric_summary_without_numbers_or_rows(spark, clean_df):
    assert exploration.numeric_summary(spark.createDataFrame([("x",), ("y",)], "a string")).count() == 0
    assert exploration.numeric_summary(clean_df.where("false")).count() == 0


def test_moments_of_constants_and_tiny_samples(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, None), (5.0, None), (5.0, 2.0)], "same double, few double")
    rows = {r["column"]: r for r in exploration.numeric_summary(df).collect()}
    assert (rows["same"]["skew"], rows["same"]["kurtosis"]) == (0.0, 0.0)
    assert rows["few"]["skew"] is None and rows["few"]["kurtosis"] is None


def test_describe_text_only(spark):
    row = exploration.describe_numeric(spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "a string")).first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (3, 2, "x", 2)


def test_categorical_summary(spark, clean_df):
    rows = {r["column"]: r for r in exploration.categorical_summary(clean_df, top_n=2).collect()}
    assert rows["region"]["n_unique"] == 3 and len(rows["region"]["top_values"]) == 2
    assert rows["channel"]["top_value"] == "Online" and rows["channel"]["top_freq"] == 3
    empty = exploration.categorical_summary(spark.createDataFrame([(None,)], "t string")).first()
    assert (empty["n_unique"], empty["top_value"], empty["top_freq"], empty["top_values"]) == (0, None, 0, [])


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in exploration.value_counts(df, "k").collect()] == [("a", 2), ("b", 1), (None, 1)]
    shares = exploration.value_counts(df, "k", normalize=True, dropna=True).collect()
    assert [r["proportion"] for r in shares] == pytest.approx([2 / 3, 1 / 3])


def test_correlation_matrix_and_top_pairs(clean_df):
    square = correlation.as_matrix(correlation.correlation_matrix(clean_df), ["sales", "cost", "profit"]).toPandas()
    square = square.set_index("feature")
    assert all(square.loc[c, c] == 1.0 for c in square) and (square >= 0.9).all().all()
    strong = correlation.top_correlations(clean_df, threshold=0.9).collect()
    assert {(r["feature_1"], r["feature_2"]) for r in strong} == {
        ("sales", "cost"), ("sales", "profit"), ("cost", "profit")
    }


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    for method in correlation.METHODS:
        rows = correlation.correlation_matrix(df, method=method).collect()
        got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in rows}
        assert got[("a", "b")] is None and got[("a", "a")] is None and got[("b", "b")] == 1.0
    with pytest.raises(ValueError, match="method"):
        correlation.correlation_matrix(df, method="cosine")


def test_summary_report(clean_df):
    report = exploration.summary_report(clean_df)
    assert set(report) == {"overview", "numeric_summary", "categorical_summary", "correlations"}
    assert report["correlations"].count() == 3


@pytest.mark.parametrize("top_n", [1, 7, 40, 500])
def test_leaders_of_any_number(spark, monkeypatch, top_n):
    monkeypatch.setattr(exploration, "RANKED_BELOW", 0)
    rows = [(f"a{i % 50}", f"b{i}" if i % 3 else "hot") for i in range(300)] + [("a7", None)] * 9 + [(None, None)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(5)
    found = {r["column"]: r["top_values"] for r in exploration.categorical_summary(df, top_n=top_n).collect()}
    for i, c in enumerate("ab"):
        counts = {}
        for row in rows:
            if row[i] is not None:
                counts[row[i]] = counts.get(row[i], 0) + 1
        expected = sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:top_n]
        assert [tuple(e) for e in found[c]] == expected
    empty = exploration.categorical_summary(df.where("b = 'none'"), top_n=top_n).collect()
    assert [(r.n_unique, r.top_values) for r in empty] == [(0, []), (0, [])]
