"""Shared session and the literal test frames of FIXTURES.md §1."""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("tessera-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture()
def employees(spark):
    rows = [(1, "Alice", "Sales", 50000, ts("2020-01-15"), True),
            (2, "Bob", "IT", 60000, ts("2019-06-20"), True),
            (3, "Charlie", "Sales", 55000, ts("2021-03-10"), False),
            (4, "David", "HR", 45000, ts("2018-11-05"), True),
            (5, "Eve", "IT", 65000, ts("2022-07-01"), True)]
    return spark.createDataFrame(rows, "id long, name string, department string, salary long, "
                                       "hire_date timestamp, active boolean")


@pytest.fixture()
def sales(spark):
    pattern = [("A", "Electronics", 10, 100.0, 1000.0, "North"), ("B", "Clothing", 5, 50.0, 250.0, "South"),
               ("C", "Electronics", 8, 75.0, 600.0, "East")]
    rows = []
    for i in range(30):
        p = pattern[i % 3]
        rows.append((dt.datetime(2024, 1, 1) + dt.timedelta(days=i),) + p)
    return spark.createDataFrame(rows, "date timestamp, product string, category string, quantity long, "
                                       "unit_price double, total_amount double, region string")


@pytest.fixture()
def kpi_frame(spark):
    rows = [(ts(f"2024-01-0{i + 1}"), a, c, h, s, amt) for i, (a, c, h, s, amt) in enumerate([
        (1, 50, 180, 4.5, 5000), (2, 45, 200, 4.2, 4500), (3, 60, 170, 4.8, 6000), (1, 55, 185, 4.6, 5200),
        (2, 48, 195, 4.3, 4800), (3, 62, 175, 4.7, 6200), (1, 53, 182, 4.4, 5100)])]
    return spark.createDataFrame(rows, "date timestamp, agent_id long, calls_handled long, avg_handling_time long, "
                                       "customer_satisfaction double, sales_amount long")


@pytest.fixture()
def nulls(spark):
    rows = [(1, "Alice", 100.0, "A"), (2, None, 200.0, "B"), (3, "Charlie", None, "A"), (4, "David", 400.0, None),
            (5, None, 500.0, "B")]
    return spark.createDataFrame(rows, "id long, name string, value double, category string")


@pytest.fixture()
def duplicates(spark):
    rows = [(1, "Alice", 100), (2, "Bob", 200), (2, "Bob", 200), (3, "Charlie", 300), (3, "Charlie", 300)]
    return spark.createDataFrame(rows, "id long, name string, value long")
