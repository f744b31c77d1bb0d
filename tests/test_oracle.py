"""Every registered query against its DuckDB SQL on the smallest data set (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import canon  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402
from tests.conftest import SF  # noqa: E402

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF).toPandas()
    want = con.execute(SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


def test_rows_only_keys_run(spark):
    for key in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[key](spark, SF).count() >= 0
