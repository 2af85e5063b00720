"""The chain of `demo_flow`: steps that once read or computed more than they needed, and keys of many digits."""

import duckdb
import numpy as np

import __spark_entry__ as entry
from check_queries import compare
from quarrystone.operators import cleansing, splitting
from workloads import project
from workloads.models import MIX, RANGE

SF_DIR = "/root/testdata/sf0.001"


def test_duplicates_are_removed_once(spark, monkeypatch):
    handed, fill = [], cleansing.handle_missing
    monkeypatch.setattr(project, "handle_missing", lambda df, **how: handed.append(df) or fill(df, **how))
    entry.queries()["demo_flow"](spark, SF_DIR)
    assert "Aggregate" not in handed[0]._jdf.queryExecution().optimizedPlan().toString()


def test_medians_of_columns_with_gaps_only(spark, monkeypatch):
    asked, quantiles = [], cleansing.exact_quantiles
    monkeypatch.setattr(cleansing, "exact_quantiles", lambda df, names, *a: asked.extend(names) or quantiles(df, names, *a))
    df = spark.createDataFrame([(1, 2.0, 5), (2, float("nan"), 6), (3, 4.0, None)], "k bigint, x double, n int")
    filled = cleansing.handle_missing(df, strategy="median")
    assert asked == ["x", "n"] and [t for _, t in filled.dtypes] == ["double"] * 3
    assert sorted(tuple(r) for r in filled.collect()) == [(1.0, 2.0, 5.0), (2.0, 3.0, 6.0), (3.0, 4.0, 5.5)]


def test_buckets_of_the_widest_hashes(spark, monkeypatch):
    monkeypatch.setattr(splitting, "BUCKET_ROWS", 10)
    ends = [-(2**63), -(2**63) + 1, 2**63 - 2, 2**63 - 1, 2**53, 2**53 + 1]
    hashes = [*ends, *map(int, np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 994))]
    df = spark.createDataFrame(list(enumerate(hashes)), "id bigint, h bigint")
    for size in (0.001, 0.002, 0.2, 0.999):
        _, test = splitting.train_test(df, test_size=size, key="id", order_hash=df["h"])
        assert sorted(r.h for r in test.collect()) == sorted(hashes)[: round(1000 * size)]


def test_order_keys_whose_hashes_need_all_digits(spark, tmp_path):
    # Keys below 2**63 / MIX whose hashes are neighbours: as doubles, their products are multiples of 512.
    inverse = pow(MIX, -1, RANGE)
    keys = [k for k in (inverse * h % RANGE for h in range(1, 4000)) if k < 3_400_000_000][:1600]
    link = duckdb.connect()
    link.execute("CREATE TABLE keys AS SELECT unnest($1::BIGINT[]) AS k, unnest(range(1600)) AS i", [keys])
    link.execute(
        f"""COPY (SELECT l.* REPLACE (k AS l_orderkey) FROM '{SF_DIR}/lineitem.parquet' l JOIN
            (SELECT l_orderkey AS o, row_number() OVER (ORDER BY l_orderkey) - 1 AS i FROM
             (SELECT DISTINCT l_orderkey FROM '{SF_DIR}/lineitem.parquet')) ON l_orderkey = o JOIN keys USING (i))
            TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)"""
    )
    link.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    assert compare(spark, link, str(tmp_path), "demo_flow") == ""
