"""Cleaning operators: duplicates, missing values, types, text, outliers, columns.

Statistics a fill or filter needs (mean, median, mode, quartiles, std) are one
global aggregate used as a scalar subquery: Spark runs the aggregate once with
map-side partial aggregation and injects the value into the row projection,
so the big table is never shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import stats as st
from ..functions import text as tx
from ..functions.time import parse_ntz
from ..functions.nulls import as_list, col_of, nan_to_null, numeric_columns, string_columns


def _order_key(order_by) -> Column:
    """A key whose order is that of the columns with NULLs last; never NULL itself, so no group loses its row."""
    cols = [col_of(c) for c in as_list(order_by)]
    return F.struct(*[x for i, c in enumerate(cols) for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])


def remove_duplicates(df: DataFrame, subset: Sequence[str] | str | None = None, keep: str | bool = "first",
                      order_by: Sequence[str] | str | None = None) -> DataFrame:
    """Drop duplicate rows (NULLs compare equal, N25).

    keep='first'/'last' keeps the row with the smallest/largest ``order_by``
    inside each duplicate group; without a subset all copies are identical and
    any one is kept. keep=False removes every row whose key occurs more than
    once. All forms are aggregates (partial aggregation before the
    shuffle), so a key holding a third of the table is combined map-side
    instead of landing whole in one task.
    """
    subset = as_list(subset) or None
    if keep is False or keep == "none":
        keys = subset or df.columns
        others = [c for c in df.columns if c not in keys]
        agg = [F.count(F.lit(1)).alias("__n")]
        if others:
            agg.append(F.any_value(F.struct(*others)).alias("__row"))
        g = df.groupBy(*keys).agg(*agg).where(F.col("__n") == 1)
        return g.select(*[F.col(k) if k in keys else F.col("__row")[k].alias(k) for k in df.columns])
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, got {keep!r}")
    if subset is None or set(subset) == set(df.columns):
        return df.dropDuplicates()
    if order_by is None:
        raise ValueError("remove_duplicates with a subset needs order_by to decide which copy is first")
    others = [c for c in df.columns if c not in subset]
    pick = F.min_by if keep == "first" else F.max_by
    g = df.groupBy(*subset).agg(pick(F.struct(*others), _order_key(order_by)).alias("__row"))
    return g.select(*[F.col(k) if k in subset else F.col("__row")[k].alias(k) for k in df.columns])


def remove_nulls(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """Drop rows with any / only missing values (NaN counts as missing)."""
    return df.dropna(how=how, subset=as_list(subset) or None)


drop_nulls = remove_nulls


def _existing(df: DataFrame, columns) -> list[str]:
    cols = as_list(columns) or df.columns
    return [c for c in cols if c in df.columns]


def fill_nulls(df: DataFrame, value=None, method: str | None = None, columns: Sequence[str] | None = None,
               order_by: Sequence[str] | str | None = None, partition_by: Sequence[str] | str | None = None
               ) -> DataFrame:
    """Fill missing values with a constant or a statistic, or carry values forward/backward.

    Statistics are computed once, distributed (see functions.stats), and applied as literals.

    - value: typed constant fill (a string fills string columns, a number numeric ones).
    - mean / median: numeric columns; other listed columns fall through to ``value``.
    - mode: any type, smallest of the ties (N11); an all-null column stays null.
    - ffill / bfill: by ``order_by`` (optionally per ``partition_by``), see operators.windows.
    """
    cols = _existing(df, columns)
    if method is None:
        if value is None:
            return df
        return df.fillna(value, subset=cols)
    df = nan_to_null(df, cols)
    m = method.lower()
    if m in ("ffill", "bfill"):
        from .windows import fill_forward_backward
        return fill_forward_backward(df, cols, order_by=order_by, partition_by=partition_by,
                                     direction="forward" if m == "ffill" else "backward")
    if m in ("mean", "median"):
        num = [c for c in cols if c in numeric_columns(df)]
        out = df
        if num:
            if m == "mean":
                r = st.one_row(df.agg(*[F.avg(c).alias(c) for c in num]))
                values = {c: r[c] for c in num}
            else:
                values = {c: v[0] for c, v in st.exact_quantiles_of(df, num, [0.5]).items()}
            out = df.withColumns({c: F.coalesce(F.col(c), F.lit(values[c])) for c in num if values[c] is not None})
        rest = [c for c in cols if c not in num]
        if value is not None and rest:
            out = out.fillna(value, subset=rest)
        return out
    if m == "mode":
        fills = {}
        for c in cols:
            v, _n = st.mode_and_count(df, c)
            if v is not None:
                fills[c] = F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        return df.withColumns(fills) if fills else df
    raise ValueError(f"unknown fill method: {method}")


_DTYPES = {
    "int": "bigint", "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint",
    "float": "double", "float64": "double", "float32": "float",
    "str": "string", "string": "string", "object": "string", "category": "string",
    "bool": "boolean", "boolean": "boolean",
    "datetime64": "timestamp", "datetime64[ns]": "timestamp", "date": "date",
}


def _converted(df: DataFrame, c: str, kind: str, fmt: str | None) -> Column:
    src = F.col(c)
    if kind == "datetime":
        dt = df.schema[c].dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            return src
        if isinstance(dt, T.DateType):
            return src.cast("timestamp_ntz")
        return parse_ntz(src.cast("string"), fmt)
    if kind == "numeric":
        return src.try_cast("double")
    return src.try_cast(_DTYPES.get(kind, kind))


def convert_types(df: DataFrame, type_mapping: dict[str, str], on_error: str = "coerce",
                  formats: dict[str, str] | None = None) -> DataFrame:
    """Convert column types; 'datetime', 'numeric' or a dtype name per column.

    on_error='coerce' (default): values that do not convert become NULL.
    on_error='keep': like the reference, a column with any value that fails to
    convert is left as it was; decided by one pre-pass returning one row of
    failure counts (bounded), not by collecting data.
    """
    formats = formats or {}
    mapping = {c: k for c, k in type_mapping.items() if c in df.columns}
    if not mapping:
        return df
    conv = {c: _converted(df, c, k, formats.get(c)) for c, k in mapping.items()}
    if on_error == "keep":
        fails = df.select([F.count_if(F.col(c).isNotNull() & e.isNull()).alias(c) for c, e in conv.items()]).first()
        conv = {c: e for c, e in conv.items() if fails[c] == 0}
    return df.withColumns(conv)


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip white space (all Unicode white space, N12) from string columns."""
    cols = [c for c in (as_list(columns) or string_columns(df)) if c in string_columns(df)]
    return df.withColumns({c: tx.strip(c) for c in cols}) if cols else df


def standardize_text(df: DataFrame, columns: Sequence[str] | str, case: str = "lower") -> DataFrame:
    fn = {"lower": tx.lower, "upper": tx.upper, "title": tx.title}.get(case)
    cols = [c for c in as_list(columns) if c in df.columns]
    if fn is None or not cols:
        return df
    return df.withColumns({c: fn(c) for c in cols})


def remove_outliers(df: DataFrame, columns: Sequence[str] | str, method: str = "iqr",
                    threshold: float | None = None, exact: bool = True) -> DataFrame:
    """Filter outliers column after column (later bounds use earlier survivors, N22).

    iqr: keep Q1 - t*IQR <= x <= Q3 + t*IQR (t default 1.5, linear quantiles N10;
    ``exact=False`` switches to approx_percentile for very large tables).
    zscore: keep |x - mean| / std <= t (t default 3, std n-1); std 0 drops all.
    Rows with NULL or NaN in the column are dropped.
    """
    out = nan_to_null(df, as_list(columns))
    for c in as_list(columns):
        if c not in numeric_columns(out):
            continue
        x = F.col(c)
        if method == "iqr":
            t = 1.5 if threshold is None else threshold
            q1, q3 = st.quantiles(out, c, [0.25, 0.75], exact)
            if q1 is None:
                out = out.where(F.lit(False))
                continue
            iqr = q3 - q1
            out = out.where((x >= F.lit(q1 - t * iqr)) & (x <= F.lit(q3 + t * iqr)))
        elif method == "zscore":
            t = 3.0 if threshold is None else threshold
            r = st.one_row(out.agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("sd")))
            if r["m"] is None or r["sd"] is None or r["sd"] == 0 or r["sd"] != r["sd"]:
                out = out.where(F.lit(False))     # std 0 (or undefined) drops every row, as division gives NaN
                continue
            out = out.where(F.abs(x - F.lit(r["m"])) / F.lit(r["sd"]) <= F.lit(t))
        else:
            raise ValueError(f"unknown outlier method: {method}")
    return out


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    return df.drop(*[c for c in as_list(columns) if c in df.columns])


class CleaningLog:
    """Row counts per cleaning step, gathered with ``df.observe`` while the
    final action runs (no extra count jobs). After the action, ``to_frame``
    returns one row per step: (step, operation, rows_before, rows_after,
    rows_removed, columns_after); column counts come from the schema.
    """

    def __init__(self, df: DataFrame):
        self._obs: list[tuple[str, Observation]] = []
        self._widths: list[int] = []
        self.df = self._tap(df, "original")

    def _tap(self, df: DataFrame, name: str) -> DataFrame:
        o = Observation(f"tessera_{len(self._obs)}_{name}")
        self._obs.append((name, o))
        self._widths.append(len(df.columns))
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    def apply(self, name: str, fn, *args, **kwargs) -> "CleaningLog":
        self.df = self._tap(fn(self.df, *args, **kwargs), name)
        return self

    def to_frame(self, spark) -> DataFrame:
        counts = [(name, int(o.get["rows"])) for name, o in self._obs]
        rows = []
        for i in range(1, len(counts)):
            before, after = counts[i - 1][1], counts[i][1]
            rows.append((i, counts[i][0], before, after, before - after, self._widths[i]))
        schema = ("step int, operation string, rows_before long, rows_after long, rows_removed long, "
                  "columns_after int")
        return spark.createDataFrame(rows, schema)
