"""CSV scans: options pass-through, column selection, multi-file union by name,
value filters and inclusive date ranges, all pushed into the scan where Spark can."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.nulls import as_list, isin_with_null, nan_to_null
from ..functions.time import literal_like, parse_ntz

DEFAULTS = {"header": "true"}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Read CSV file(s); call options override the defaults. With ``schema`` no
    inference pass is made (recommended at scale). ``columns`` prunes the scan.
    NaN cells become NULL (N3)."""
    opts = {**DEFAULTS, **{k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}}
    r = spark.read.options(**opts)
    if schema is not None:
        r = r.schema(schema)
    elif "inferSchema" not in opts:
        r = r.option("inferSchema", "true")
    df = nan_to_null(r.csv(path if isinstance(path, str) else list(path)))
    return df.select(*as_list(columns)) if columns else df


def read_csv_union(spark: SparkSession, paths: Sequence[str], concat: bool = True, schemas=None,
                   **options) -> DataFrame | list[DataFrame]:
    """Several files aligned by column name (missing columns → NULL); ``concat=False`` gives the list, one frame per path.

    Paths with the same header (or the same given schema) are one scan, so the
    plan grows with the number of layouts, not of files. Column types are inferred over all files of a layout.
    """
    schemas = list(schemas) if schemas else [None] * len(paths)
    if not concat:
        return [read_csv(spark, p, s, **options) for p, s in zip(paths, schemas)]
    layouts: dict = {}
    for p, s in zip(paths, schemas):
        key = (str(s), ()) if s is not None else ("", tuple(_header(spark, p, options)))
        layouts.setdefault(key, (s, []))[1].append(p)
    frames = [read_csv(spark, files, s, **options) for s, files in layouts.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names of a path; reads its first line only."""
    return read_csv(spark, path, **{**options, "inferSchema": False}).columns


def read_csv_isin(spark: SparkSession, path: str, column: str, values: Sequence, schema=None, **options) -> DataFrame:
    """Rows whose ``column`` is in ``values`` (None in the list matches NULL, N7)."""
    return read_csv(spark, path, schema, **options).where(isin_with_null(F.col(column), values))


def read_csv_date_range(spark: SparkSession, path: str, date_column: str, start, end, schema=None,
                        date_format: str | None = None, **options) -> DataFrame:
    """start ≤ date ≤ end, both inclusive; an end given as a date means its midnight."""
    df = read_csv(spark, path, schema, **options)
    if df.schema[date_column].dataType.simpleString() == "string":
        df = df.withColumn(date_column, parse_ntz(F.col(date_column), date_format))
    c = F.col(date_column)
    lo, hi = literal_like(df, date_column, start), literal_like(df, date_column, end)
    return df.where((c >= lo) & (c <= hi))
