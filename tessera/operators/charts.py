"""The tables behind the reference's charts (drawing is not built)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_list, drop_null_keys, sum0
from . import transform as tr


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), empty bins present:
    (bin, bin_start, bin_end, count). min = max gives one bin holding every value.
    Bounds are a one-row scalar subquery; counting is one partial aggregate;
    the spine has ``bins`` rows."""
    x = F.col(column).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).take(1)[0]    # one row
    if b["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    lo, hi = F.lit(b["lo"]), F.lit(b["hi"])
    width = (hi - lo) / F.lit(bins)
    idx = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((x - lo) * (F.lit(bins) / (hi - lo))) + 1, F.lit(bins)))
    counts = df.where(x.isNotNull()).groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    n = F.when(hi == lo, F.lit(1)).otherwise(F.lit(bins))
    spine = counts.agg(F.explode(F.sequence(F.lit(1), n)).alias("bin"))
    out = spine.join(counts, "bin", "left")
    return out.select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"),
                      F.when(F.col("bin") == n, hi).otherwise(lo + F.col("bin") * width).alias("bin_end"),
                      F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def pie_share(df: DataFrame, label: str, value: str) -> DataFrame:
    """(label, value, percentage rounded to 1 decimal) — the ``%1.1f%%`` labels."""
    g = drop_null_keys(df, [label]).groupBy(label).agg(sum0(value).alias(value))
    total = g.select(F.sum(value).alias("t")).scalar()
    return g.withColumn("percentage", F.round(F.try_divide(F.col(value), total) * 100, 1))


def heatmap(df: DataFrame, index: str, columns: str, values: str, aggfunc: str = "mean",
            column_values: Sequence | None = None) -> DataFrame:
    """Numeric matrix rounded to 2 decimals."""
    p = tr.pivot(df, index, columns, values, aggfunc, column_values)
    return p.select(index, *[F.round(F.col(f"`{c}`"), 2).alias(c) for c in p.columns if c != index])


def series(df: DataFrame, x: str, ys: Sequence[str] | str, color: str | None = None,
           agg: str = "sum") -> DataFrame:
    """Long (x[, color], series, y) for bar/line/scatter/multi-series charts."""
    ys = as_list(ys)
    keys = [x] + ([color] if color else [])
    g = tr.aggregate(df, keys, {y: agg for y in ys})
    return g.unpivot(keys, ys, "series", "y")

