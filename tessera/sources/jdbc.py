"""JDBC scans: SQL text or a table with columns / where / limit.

Filters and the column list are pushed to the database by Spark's JDBC
source; LIMIT is pushed when given in the ``query`` form. For large tables
pass ``partition_column`` with bounds so each task reads one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _reader(spark: SparkSession, url: str, properties: dict | None):
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def read_jdbc_query(spark: SparkSession, url: str, sql: str, properties: dict | None = None) -> DataFrame:
    """Run SQL text on the database (bind values belong in the text or a view)."""
    return _reader(spark, url, properties).option("query", sql).load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, columns: Sequence[str] | None = None,
                    where: str | None = None, limit: int | None = None, properties: dict | None = None,
                    partition_column: str | None = None, lower_bound=None, upper_bound=None,
                    num_partitions: int | None = None) -> DataFrame:
    r = _reader(spark, url, properties).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    df = r.load()
    if columns:
        df = df.select(*columns)
    if where:
        df = df.where(where)
    if limit is not None:
        df = df.limit(limit)
    return df
