"""One Spark session and the small fixture tables."""

from __future__ import annotations

import datetime

import numpy as np
import pytest

from check_queries import session


@pytest.fixture(scope="session")
def spark():
    active = session("4")
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture(scope="session")
def clean_df(spark):
    rows = [
        ("North", "Online", 100.0, 60.0, 40.0),
        ("South", "Retail", 200.0, 120.0, 80.0),
        ("North", "Online", 150.0, 90.0, 60.0),
        ("South", "Retail", 250.0, 150.0, 100.0),
        ("East", "Online", 300.0, 180.0, 120.0),
        ("East", "Retail", 50.0, 30.0, 20.0),
    ]
    return spark.createDataFrame(rows, "region string, channel string, sales double, cost double, profit double")


@pytest.fixture(scope="session")
def messy_df(spark):
    rows = [
        (1, " North ", 100.0, 1),
        (2, "South", 200.0, 2),
        (3, "North", None, 3),
        (4, " East", 150.0, 4),
        (5, "West ", 999999.0, 5),
        (1, " North ", 100.0, 1),
    ]
    return spark.createDataFrame(rows, "`Order ID` bigint, `Region ` string, Sales double, `Units Sold` bigint")


@pytest.fixture(scope="session")
def timeseries_df(spark):
    rows = [(datetime.datetime(2023, m + 1, 1), 100.0 + 10 * m) for m in range(12)]
    return spark.createDataFrame(rows, "order_date timestamp_ntz, sales double")


@pytest.fixture(scope="session")
def regression_df(spark):
    rng = np.random.default_rng(0)
    x1, x2 = rng.normal(50, 10, 200), rng.normal(0, 1, 200)
    group = rng.choice(["A", "B"], 200)
    y = 3 * x1 + np.where(group == "A", 5.0, -5.0) + rng.normal(0, 2, 200)
    rows = [(float(a), float(b), str(g), float(v)) for a, b, g, v in zip(x1, x2, group, y)]
    return spark.createDataFrame(rows, "x1 double, x2 double, group string, y double")
