"""Registry of named queries over a data folder, each with its DuckDB oracle SQL.

A query is ``fn(spark, data_dir) -> DataFrame``. The oracle is ANSI SQL over
the same Parquet tables (views named like the files). Floating results are
rounded on both sides so that summation order does not change the compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column (summation order only moves the last bits)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols}) if cols else df


def load_all():
    """Import every catalog module so their queries register."""
    from . import catalog_clean, catalog_transform, catalog_aggregate, catalog_windows  # noqa: F401
    from . import catalog_kpi, catalog_reports, catalog_misc, catalog_sources  # noqa: F401
    return QUERIES, ORACLES
