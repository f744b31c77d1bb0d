"""Order-dependent operators: running sums, ranks, forward/backward fill, rolling windows.

Spark rows have no order, so every operator takes an explicit ``order_by``
(with a unique tie-breaker where the result depends on it). NULL order keys
come last, NULL groups form one window, NaN counts as missing.

Scaling. A window without ``partitionBy`` moves every row into one task, and a
window partitioned by a key that holds a third of the table is not much
better. So there is one form for every size:

1. The composite key (partition columns, order columns) is cut into contiguous
   ranges by Spark's range partitioner (``repartitionByRange``); a row's bucket
   is its range partition. A hot group is split over many buckets by its order
   columns. The bucketed rows are checkpointed in the shared folder, so what
   follows reads them and not the input, which is evaluated twice (the
   partitioner's sample and the shuffle).
2. Pass 1 aggregates one row per (bucket, group): a sum, a count, the last
   non-null value. A window over that table gives what earlier buckets hold of
   a group. Only the first group of a bucket can go on from an earlier one, so
   the carry table has at most one row per bucket.
3. Pass 2 joins the carry on the bucket and runs the ordinary window inside
   (bucket, group); both use the same exchange.

Ranks with ties cut the key (value, hash of the row), so a hot value spreads
over buckets too; its counts per bucket are added up and joined back on
(bucket, value). ``two_pass=False`` is the plain window, for a caller who knows
that every group fits a task; tests use it as the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import as_list, nan_to_null, sort_exprs
from ..session import ensure_checkpoint_dir

BUCKET = "__bucket"
_UNB = Window.unboundedPreceding


def with_range_bucket(df: DataFrame, key_cols: Sequence[str], n_buckets: int | None = None,
                      ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Add ``__bucket``: contiguous ranges of the key ``key_cols`` (NULLs last), equal keys in one.

    ``n_buckets`` defaults to ``spark.sql.shuffle.partitions``. The result is
    checkpointed (reliable, into ``spark.checkpoint.dir``), so all passes share
    one assignment even if executors are lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = n_buckets or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *sort_exprs(list(key_cols), ascending))
    return ranged.withColumn(BUCKET, F.spark_partition_id()).checkpoint(eager=True)


def _order_struct(cols: Sequence[str]) -> Column:
    """A struct that compares like ``ORDER BY cols ASC NULLS LAST``."""
    return F.struct(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))])


def _with_carry(bdf: DataFrame, pb: list[str], aggs: dict[str, Column], carry: dict[str, Column],
                forward: bool = True) -> DataFrame:
    """``bdf`` with what the buckets before (``forward``) or after hold of a row's group.

    ``aggs`` are the pass-1 aggregates per (bucket, group), ``carry`` aggregates over them; NULL
    for a group that does not go on from another bucket. ``carry`` sees the buckets in reading
    order, so the nearest one is always the last.
    """
    w = Window.partitionBy(*pb).orderBy(BUCKET if forward else F.desc(BUCKET)).rowsBetween(_UNB, -1)
    p1 = bdf.groupBy(BUCKET, *pb).agg(*[e.alias(k) for k, e in aggs.items()])
    p1 = (p1.select(BUCKET, *[F.col(p).alias(f"__g_{p}") for p in pb], F.count(F.lit(1)).over(w).alias("__others"),
                    *[e.over(w).alias(k) for k, e in carry.items()])
          .where("__others > 0"))                      # at most one group of each bucket
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__g_{p}")) for p in pb], F.col("__others").isNotNull())
    return (bdf.join(p1, BUCKET, "left").withColumns({k: F.when(same, F.col(k)) for k in carry})
            .drop("__others", *[f"__g_{p}" for p in pb]))


def cumulative_sum(df: DataFrame, column: str, order_by: Sequence[str] | str,
                   partition_by: Sequence[str] | str | None = None, two_pass: bool = True,
                   n_buckets: int | None = None, output: str | None = None) -> DataFrame:
    """Running total ``{column}_cumsum`` in ``order_by`` order (N15: NULL at a NULL
    value or NULL group key, the total carries on past it)."""
    order = as_list(order_by)
    pb = as_list(partition_by)
    out = output or f"{column}_cumsum"
    df = nan_to_null(df, [column])
    keep = F.col(column).isNotNull()
    for p in pb:
        keep = keep & F.col(p).isNotNull()
    if not two_pass:
        w = Window.partitionBy(*pb).orderBy(*sort_exprs(order)).rowsBetween(_UNB, 0)
        return df.withColumn(out, F.when(keep, F.sum(column).over(w)))
    bdf = with_range_bucket(df, pb + order, n_buckets)
    j = _with_carry(bdf, pb, {"__s": F.sum(column)}, {"__pre": F.sum("__s")})
    w = Window.partitionBy(BUCKET, *pb).orderBy(*sort_exprs(order)).rowsBetween(_UNB, 0)
    total = F.coalesce(F.col("__pre"), F.lit(0)) + F.sum(column).over(w)
    return j.withColumn(out, F.when(keep, total)).drop(BUCKET, "__pre")


def row_number(df: DataFrame, order_by: Sequence[str] | str, partition_by: Sequence[str] | str | None = None,
               two_pass: bool = True, n_buckets: int | None = None, output: str = "row_number",
               ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Exact 1-based position in ``order_by`` order (order must be unique for a stable answer)."""
    order = as_list(order_by)
    pb = as_list(partition_by)
    asc = list(ascending) if isinstance(ascending, (list, tuple)) else [ascending] * len(order)
    if not two_pass:
        return df.withColumn(output, F.row_number().over(Window.partitionBy(*pb).orderBy(*sort_exprs(order, asc))))
    bdf = with_range_bucket(df, pb + order, n_buckets, [True] * len(pb) + asc)
    j = _with_carry(bdf, pb, {"__c": F.count(F.lit(1))}, {"__pre": F.sum("__c")})
    w = Window.partitionBy(BUCKET, *pb).orderBy(*sort_exprs(order, asc))
    position = F.coalesce(F.col("__pre"), F.lit(0)) + F.row_number().over(w)
    return j.withColumn(output, position).drop(BUCKET, "__pre")


def rank(df: DataFrame, column: str, ascending: bool = False, method: str = "dense",
         order_by: Sequence[str] | str | None = None, two_pass: bool = True,
         n_buckets: int | None = None) -> DataFrame:
    """``{column}_rank`` as double; NULL values get NULL (N16).

    method: dense | min | max | average | first (first breaks ties by ``order_by``,
    which must make the order unique).
    """
    out = f"{column}_rank"
    if method not in ("dense", "min", "max", "average", "first"):
        raise ValueError(f"unknown rank method: {method}")
    if method == "first" and not order_by:
        raise ValueError("rank(method='first') needs order_by to break ties")
    df = nan_to_null(df, [column])
    if method == "first":
        keys = [column] + [c for c in as_list(order_by) if c != column]
        pos = row_number(df, keys, two_pass=two_pass, n_buckets=n_buckets, output=out,
                         ascending=[ascending] + [True] * (len(keys) - 1))
        return pos.withColumn(out, F.when(F.col(column).isNotNull(), F.col(out).cast("double")))
    if not two_pass:
        return _rank_plain(df, column, ascending, method, out)
    # rows of one value spread over buckets by a hash of the row
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    bdf = with_range_bucket(df.withColumn("__salt", F.xxhash64(*hashed)), [column, "__salt"], n_buckets,
                            [ascending, True]).drop("__salt")
    ranks = _bucket_ranks(bdf, column, ascending, method).withColumnRenamed("__rank", out)
    return bdf.join(ranks, [BUCKET, column], "left").drop(BUCKET).select(*df.columns, out)


def _bucket_ranks(bdf: DataFrame, column: str, ascending: bool, method: str) -> DataFrame:
    """One row per bucket and value (NULL left out) with the value's rank among all rows."""
    v = F.col(column)
    inside = Window.partitionBy(BUCKET).orderBy(v.asc() if ascending else v.desc())
    per = (bdf.where(v.isNotNull()).groupBy(BUCKET, column).agg(F.count(F.lit(1)).alias("__n"))
           .withColumn("__d", F.row_number().over(inside).cast("long"))
           .withColumn("__le", F.sum("__n").over(inside.rowsBetween(_UNB, 0))))
    low, high = (F.min(v), F.max(v)) if ascending else (F.max(v), F.min(v))
    by = Window.orderBy(BUCKET)                        # one row per bucket
    before = by.rowsBetween(_UNB, -1)
    # the first value of a bucket may go on from the bucket before: then it is no new value
    pre = (per.groupBy(BUCKET).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__vals"),
                                   low.alias("__low"), high.alias("__high"))
           .withColumn("__goes_on", F.coalesce((F.lag("__high").over(by) == F.col("__low")).cast("long"), F.lit(0)))
           .select(BUCKET, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__pre_rows"),
                   (F.coalesce(F.sum(F.col("__vals") - F.col("__goes_on")).over(before), F.lit(0))
                    - F.col("__goes_on")).alias("__pre_vals")))
    j = per.join(pre, BUCKET)
    if method == "dense":
        return j.select(BUCKET, column, (F.col("__pre_vals") + F.col("__d")).cast("double").alias("__rank"))
    whole = Window.partitionBy(column)                 # a value has at most one row per bucket
    first = F.min(F.col("__pre_rows") + F.col("__le") - F.col("__n")).over(whole) + 1
    n = F.sum("__n").over(whole)
    r = {"min": first, "max": first + n - 1, "average": first + (n - 1) / 2.0}[method]
    return j.select(BUCKET, column, r.cast("double").alias("__rank"))


def _rank_plain(df, column, ascending, method, out):
    v = F.col(column)
    w = Window.orderBy(v.asc_nulls_last() if ascending else v.desc_nulls_last())
    more = F.count(F.lit(1)).over(Window.partitionBy(column)) - 1
    r = {"dense": F.dense_rank().over(w), "min": F.rank().over(w), "max": F.rank().over(w) + more,
         "average": F.rank().over(w) + more / 2.0}[method]
    return df.withColumn(out, F.when(v.isNotNull(), r.cast("double")))


def fill_forward_backward(df: DataFrame, columns: Sequence[str], order_by: Sequence[str] | str,
                          partition_by: Sequence[str] | str | None = None, direction: str = "forward",
                          two_pass: bool = True, n_buckets: int | None = None) -> DataFrame:
    """Carry the last (forward) or next (backward) non-null value along ``order_by``.

    Backward is forward over the mirrored order: Spark evaluates a frame that ends at
    the partition's end anew for every row, which is quadratic, a growing frame once.
    """
    if order_by is None:
        raise ValueError("ffill/bfill needs order_by (Spark rows have no order)")
    order = as_list(order_by)
    pb = as_list(partition_by)
    cols = [c for c in as_list(columns) if c in df.columns and c not in pb]
    df = nan_to_null(df, cols)
    fwd = direction == "forward"
    along = sort_exprs(order) if fwd else [F.col(c).desc_nulls_first() for c in order]
    if not two_pass:
        w = Window.partitionBy(*pb).orderBy(*along).rowsBetween(_UNB, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    bdf = with_range_bucket(df, pb + order, n_buckets)
    o = _order_struct(order)
    edge = F.max_by if fwd else F.min_by
    j = _with_carry(bdf, pb, {f"__e_{c}": edge(F.col(c), F.when(F.col(c).isNotNull(), o)) for c in cols},
                    {f"__in_{c}": F.last(f"__e_{c}", ignorenulls=True) for c in cols}, forward=fwd)
    w = Window.partitionBy(BUCKET, *pb).orderBy(*along).rowsBetween(_UNB, 0)
    res = j.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"__in_{c}")) for c in cols})
    return res.drop(BUCKET, *[f"__in_{c}" for c in cols])


_ROLL = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp}


def rolling(df: DataFrame, column: str, window: int, func: str = "mean", order_by: Sequence[str] | str = None,
            partition_by: Sequence[str] | str | None = None, two_pass: bool = True,
            n_buckets: int | None = None, block_rows: int = 100_000) -> DataFrame:
    """Trailing ``window``-row aggregate ``{column}_rolling_{func}``; NULL until the
    frame holds ``window`` non-null values (N14). Unknown func → unchanged.

    The work per row does not grow with ``window``. Exact row numbers cut a group
    into blocks of ``window`` rows; a running aggregate from the start of the
    block and one from its end give, for every row, what its own block holds up
    to it and what the block before holds after the row that leaves the frame
    (van Herk). The two parts are merged: extrema as they are, sums and counts added,
    means and squared deviations by the pairwise rule, so nothing is ever
    subtracted. Tasks work on stretches of at least ``block_rows`` rows (a
    multiple of the window), each with the ``window - 1`` rows before it as a
    halo, so a hot group is spread.
    """
    if func not in _ROLL:
        return df
    if order_by is None:
        raise ValueError("rolling needs order_by")
    order = as_list(order_by)
    pb = as_list(partition_by)
    out = f"{column}_rolling_{func}"
    df = nan_to_null(df, [column])

    if not two_pass:
        w = Window.partitionBy(*pb).orderBy(*sort_exprs(order)).rowsBetween(-(window - 1), 0)
        return df.withColumn(out, F.when(F.count(column).over(w) == window, _ROLL[func](column).over(w)))
    stretch = window * max(1, -(-block_rows // window))
    rn = row_number(df, order, pb, n_buckets=n_buckets, output="__rn")
    at = F.col("__rn") - 1
    own = F.struct(F.floor(at / stretch).alias("blk"), F.lit(False).alias("halo"))
    ahead = F.struct((F.floor(at / stretch) + 1).alias("blk"), F.lit(True).alias("halo"))
    both = rn.withColumn("__in", F.explode(F.when(at % stretch >= stretch - (window - 1), F.array(own, ahead)).otherwise(F.array(own))))
    both = both.withColumns({"__blk": F.col("__in.blk"), "__halo": F.col("__in.halo"), "__v": F.floor(at / window)}).drop("__in")
    along = Window.partitionBy(*pb, "__blk").orderBy("__rn")
    block = Window.partitionBy(*pb, "__blk", "__v")
    run = {"n": F.count(column)} | {"mean": {"x": F.sum(column)}, "sum": {"x": F.sum(column)}, "min": {"x": F.min(column)},
                                    "max": {"x": F.max(column)}, "std": {"x": F.avg(column), "q": F.var_pop(column)}}[func]
    ends = both.withColumns({f"__s_{k}": f.over(block.orderBy(F.desc("__rn")).rowsBetween(_UNB, 0)) for k, f in run.items()})
    parts = ends.withColumns({f"__p_{k}": f.over(block.orderBy("__rn").rowsBetween(_UNB, 0)) for k, f in run.items()})
    # the end of the block before, as seen from the first row of the frame; a frame that is a whole block needs none
    apart = at % window != window - 1
    parts = parts.withColumns({f"__s_{k}": F.when(apart, F.lag(f"__s_{k}", window - 1).over(along)) for k in run})
    n, m = F.coalesce("__s_n", F.lit(0)), F.col("__p_n")
    if func in ("min", "max"):
        value = (F.least if func == "min" else F.greatest)("__s_x", "__p_x")
    elif func == "std":
        gap = F.coalesce(F.col("__s_x") - F.col("__p_x"), F.lit(0.0))
        square = F.coalesce(F.col("__s_q") * n, F.lit(0.0)) + F.col("__p_q") * m + gap * gap * n * m / window
        value = F.when(F.lit(window > 1), F.sqrt(square / (window - 1)))
    else:
        value = F.coalesce(F.col("__s_x") + F.col("__p_x"), F.col("__p_x"))
        if func == "mean":
            value = (value / window).cast(df.select(F.avg(column).alias("v")).schema["v"].dataType)
    res = parts.withColumn(out, F.when(n + m == window, value))
    return res.where(~F.col("__halo")).drop("__rn", "__blk", "__halo", "__v", *[f"__{x}_{k}" for x in "sp" for k in run])
