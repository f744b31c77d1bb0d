"""Registered order-dependent queries, two-pass form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources import tables as tb
from .fixtures import ORDERS_NULLS_SQL, orders_nulls
from .registry import query, rounded

ORDER = ["o_orderdate", "o_orderkey"]
_W = "ORDER BY o_orderdate, o_orderkey"
_ROLL_SQL = {"mean": "avg", "sum": "sum", "min": "min", "max": "max", "std": "stddev_samp"}


def _rolling_query(func):
    @query(f"win_rolling_{func}", f"""
    SELECT *, round(CASE WHEN count(o_totalprice) OVER w = 7 THEN {_ROLL_SQL[func]}(o_totalprice) OVER w END, 2)
           AS o_totalprice_rolling_{func}
    FROM ({ORDERS_NULLS_SQL}) WINDOW w AS ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """)
    def q(spark, d):
        return rounded(W.rolling(orders_nulls(spark, d), "o_totalprice", 7, func, ORDER, block_rows=2000), 2)
    return q


for _f in ("mean", "sum", "min", "max", "std"):
    _rolling_query(_f)


@query("win_cumsum", f"""
SELECT *, round(CASE WHEN o_totalprice IS NOT NULL THEN sum(o_totalprice) OVER ({_W} ROWS UNBOUNDED PRECEDING) END, 2)
       AS o_totalprice_cumsum
FROM ({ORDERS_NULLS_SQL})
""")
def q_cumsum(spark, d):
    return rounded(W.cumulative_sum(orders_nulls(spark, d), "o_totalprice", ORDER), 2)


@query("win_cumsum_group", f"""
SELECT *, round(CASE WHEN o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
       THEN sum(o_totalprice) OVER (PARTITION BY o_orderpriority {_W} ROWS UNBOUNDED PRECEDING) END, 2)
       AS o_totalprice_cumsum
FROM ({ORDERS_NULLS_SQL})
""")
def q_cumsum_group(spark, d):
    return rounded(W.cumulative_sum(orders_nulls(spark, d), "o_totalprice", ORDER, "o_orderpriority"), 2)


_RANKED = f"(SELECT *, round(o_totalprice / 10000) AS p FROM ({ORDERS_NULLS_SQL}))"
_RANK_SQL = {
    "dense": "dense_rank() OVER (ORDER BY p DESC)",
    "min": "rank() OVER (ORDER BY p DESC)",
    "max": "rank() OVER (ORDER BY p DESC) + count(*) OVER (PARTITION BY p) - 1",
    "average": "rank() OVER (ORDER BY p DESC) + (count(*) OVER (PARTITION BY p) - 1) / 2.0",
    "first": "row_number() OVER (ORDER BY p DESC, o_orderkey)",
}


def _rank_query(method):
    @query(f"win_rank_{method}", f"""
    SELECT *, CAST({_RANK_SQL[method]} AS DOUBLE) AS p_rank FROM {_RANKED} WHERE p IS NOT NULL
    UNION ALL SELECT *, CAST(NULL AS DOUBLE) FROM {_RANKED} WHERE p IS NULL
    """)
    def q(spark, d):
        o = orders_nulls(spark, d).withColumn("p", F.round(F.col("o_totalprice") / 10000))
        return W.rank(o, "p", ascending=False, method=method, order_by=["o_orderkey"])
    return q


for _m in ("dense", "min", "max", "average", "first"):
    _rank_query(_m)


def _fill_query(key, direction, sql_fn, frame):
    @query(key, f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           {sql_fn}(o_totalprice IGNORE NULLS) OVER w AS o_totalprice,
           {sql_fn}(o_orderpriority IGNORE NULLS) OVER w AS o_orderpriority
    FROM ({ORDERS_NULLS_SQL}) WINDOW w AS ({_W} ROWS BETWEEN {frame})
    """)
    def q(spark, d):
        from ..operators import cleaning as cl
        return cl.fill_nulls(orders_nulls(spark, d), method="ffill" if direction == "forward" else "bfill",
                             columns=["o_totalprice", "o_orderpriority"], order_by=ORDER)
    return q


_fill_query("clean_ffill", "forward", "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
_fill_query("clean_bfill", "backward", "first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")


@query("win_row_number_group", """
SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_number FROM events
""")
def q_row_number_group(spark, d):
    return W.row_number(tb.table(spark, d, "events"), ["ts", "event_id"], "event_type")


# ---- keys of earlier rounds, when small tables took another form ----
@query("win_cumsum_two_pass", f"""
SELECT *, round(CASE WHEN o_totalprice IS NOT NULL THEN sum(o_totalprice) OVER ({_W} ROWS UNBOUNDED PRECEDING) END, 2)
       AS o_totalprice_cumsum
FROM ({ORDERS_NULLS_SQL})
""")
def q_cumsum_2p(spark, d):
    return rounded(W.cumulative_sum(orders_nulls(spark, d), "o_totalprice", ORDER, two_pass=True), 2)


@query("win_rank_dense_two_pass", f"""
SELECT *, CAST({_RANK_SQL["dense"]} AS DOUBLE) AS p_rank FROM {_RANKED} WHERE p IS NOT NULL
UNION ALL SELECT *, CAST(NULL AS DOUBLE) FROM {_RANKED} WHERE p IS NULL
""")
def q_rank_2p(spark, d):
    o = orders_nulls(spark, d).withColumn("p", F.round(F.col("o_totalprice") / 10000))
    return W.rank(o, "p", ascending=False, method="dense", two_pass=True)


@query("win_rank_first_two_pass", f"""
SELECT *, CAST({_RANK_SQL["first"]} AS DOUBLE) AS p_rank FROM {_RANKED} WHERE p IS NOT NULL
UNION ALL SELECT *, CAST(NULL AS DOUBLE) FROM {_RANKED} WHERE p IS NULL
""")
def q_rank_first_2p(spark, d):
    o = orders_nulls(spark, d).withColumn("p", F.round(F.col("o_totalprice") / 10000))
    return W.rank(o, "p", ascending=False, method="first", order_by=["o_orderkey"], two_pass=True)


@query("win_rolling_mean_two_pass", f"""
SELECT *, round(CASE WHEN count(o_totalprice) OVER w = 7 THEN avg(o_totalprice) OVER w END, 2)
       AS o_totalprice_rolling_mean
FROM ({ORDERS_NULLS_SQL}) WINDOW w AS ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def q_rolling_2p(spark, d):
    return rounded(W.rolling(orders_nulls(spark, d), "o_totalprice", 7, "mean", ORDER, block_rows=2000,
                             two_pass=True), 2)


@query("win_rolling_wide", f"""
SELECT *, round(CASE WHEN count(o_totalprice) OVER w = 500 THEN max(o_totalprice) OVER w END, 2) AS o_totalprice_rolling_max,
       round(CASE WHEN count(o_totalprice) OVER w = 500 THEN stddev_samp(o_totalprice) OVER w END, 2) AS o_totalprice_rolling_std
FROM (SELECT * FROM ({ORDERS_NULLS_SQL}) WHERE o_totalprice IS NOT NULL) WINDOW w AS ({_W} ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)
""")
def q_rolling_wide(spark, d):
    o = orders_nulls(spark, d).where("o_totalprice IS NOT NULL")
    return rounded(W.rolling(W.rolling(o, "o_totalprice", 500, "max", ORDER), "o_totalprice", 500, "std", ORDER), 2)


@query("clean_ffill_two_pass", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       last_value(o_totalprice IGNORE NULLS) OVER w AS o_totalprice,
       last_value(o_orderpriority IGNORE NULLS) OVER w AS o_orderpriority
FROM ({ORDERS_NULLS_SQL}) WINDOW w AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def q_ffill_2p(spark, d):
    return W.fill_forward_backward(orders_nulls(spark, d), ["o_totalprice", "o_orderpriority"], ORDER,
                                   two_pass=True)


@query("win_cumsum_group_two_pass", f"""
SELECT *, round(CASE WHEN o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
       THEN sum(o_totalprice) OVER (PARTITION BY o_orderpriority {_W} ROWS UNBOUNDED PRECEDING) END, 2)
       AS o_totalprice_cumsum
FROM ({ORDERS_NULLS_SQL})
""")
def q_cumsum_group_2p(spark, d):
    return rounded(W.cumulative_sum(orders_nulls(spark, d), "o_totalprice", ORDER, "o_orderpriority",
                                    two_pass=True), 2)


# ---- NULL order keys, NULL groups and NaN values ----
@query("win_cumsum_null_order", f"""
SELECT *, round(CASE WHEN o_totalprice IS NOT NULL THEN sum(o_totalprice) OVER
       (ORDER BY o_orderpriority NULLS LAST, o_orderkey ROWS UNBOUNDED PRECEDING) END, 2) AS o_totalprice_cumsum
FROM ({ORDERS_NULLS_SQL})
""")
def q_cumsum_null_order(spark, d):
    return rounded(W.cumulative_sum(orders_nulls(spark, d), "o_totalprice", ["o_orderpriority", "o_orderkey"]), 2)


@query("win_row_number_null_group", f"""
SELECT *, row_number() OVER (PARTITION BY o_orderstatus {_W}) AS row_number FROM ({ORDERS_NULLS_SQL})
""")
def q_row_number_null_group(spark, d):
    return W.row_number(orders_nulls(spark, d), ORDER, "o_orderstatus")


@query("clean_ffill_null_group", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       last_value(o_totalprice IGNORE NULLS) OVER (PARTITION BY o_orderpriority
           ORDER BY o_orderstatus NULLS LAST, o_orderkey ROWS UNBOUNDED PRECEDING) AS o_totalprice
FROM ({ORDERS_NULLS_SQL})
""")
def q_ffill_null_group(spark, d):
    return W.fill_forward_backward(orders_nulls(spark, d), ["o_totalprice"], ["o_orderstatus", "o_orderkey"], "o_orderpriority")


@query("win_rank_nan", f"""
SELECT o_orderkey, p, CASE WHEN p IS NOT NULL THEN CAST(rank() OVER (ORDER BY p DESC NULLS LAST) AS DOUBLE) END AS p_rank
FROM {_RANKED}
""")
def q_rank_nan(spark, d):
    o = orders_nulls(spark, d).select("o_orderkey", F.coalesce(F.round(F.col("o_totalprice") / 10000), F.lit(float("nan"))).alias("p"))
    return W.rank(o, "p", ascending=False, method="min")
