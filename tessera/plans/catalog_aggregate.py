"""Registered aggregation and top-k queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import aggregate as ag
from ..sources import tables as tb
from .fixtures import ORDERS_NULLS_SQL, orders_nulls
from .registry import query, rounded

S = f"({tb.SALES_SQL})"


@query("agg_group_multi", f"""
SELECT region, round(coalesce(sum(total_amount), 0), 4) AS total_amount_sum, round(avg(total_amount), 4) AS total_amount_mean,
       round(coalesce(sum(quantity), 0), 4) AS quantity_sum, max(quantity) AS quantity_max
FROM {S} WHERE region IS NOT NULL GROUP BY region
""")
def q_group_multi(spark, d):
    return rounded(ag.group_by(tb.sales(spark, d), "region",
                               {"total_amount": ["sum", "mean"], "quantity": ["sum", "max"]}))


def _describe_sql(table, cols, strs=(), extra=False):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        tail = ", CAST(NULL AS BIGINT) AS unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq" if extra else ""
        parts.append(f"""SELECT '{c}' AS "column", CAST(count({x}) AS DOUBLE) AS count, round(avg({x}), 4) AS mean,
          round(stddev_samp({x}), 4) AS std, min({x}) AS min, round(quantile_cont({x}, 0.25), 4) AS q25,
          round(quantile_cont({x}, 0.5), 4) AS q50, round(quantile_cont({x}, 0.75), 4) AS q75, max({x}) AS max{tail}
          FROM {table}""")
    for c in strs:
        top = f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        parts.append(f"""SELECT '{c}', CAST(count({c}) AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
          CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
          count(DISTINCT {c}), {top}, count(*) FILTER (WHERE {c} = {top}) FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@query("agg_describe_numeric", _describe_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"]))
def q_describe_numeric(spark, d):
    return rounded(ag.summarize(tb.table(spark, d, "orders")))


@query("agg_describe_all", _describe_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"],
                                         ["c_name", "c_mktsegment"], extra=True))
def q_describe_all(spark, d):
    return rounded(ag.summarize(tb.table(spark, d, "customer"), numeric_only=False))


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax"]


@query("agg_totals", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", round(coalesce(sum(CAST({c} AS DOUBLE)), 0), 2) AS total FROM lineitem"""
    for c in _LI_NUM))
def q_totals(spark, d):
    return rounded(ag.calculate_totals(tb.table(spark, d, "lineitem"), _LI_NUM + ["l_returnflag"]), 2)


@query("agg_share_group", f"""
SELECT region, round(sum(total_amount) / (SELECT sum(total_amount) FROM {S}) * 100, 4) AS percentage
FROM {S} WHERE region IS NOT NULL GROUP BY region
""")
def q_share_group(spark, d):
    return rounded(ag.calculate_percentages(tb.sales(spark, d), "total_amount", "region"))


@query("agg_share_row", """
SELECT *, round(o_totalprice / (SELECT sum(o_totalprice) FROM orders) * 100, 8) AS percentage FROM orders
""")
def q_share_row(spark, d):
    return rounded(ag.calculate_percentages(tb.table(spark, d, "orders"), "o_totalprice"), 8)


@query("topk_top", f"SELECT * FROM ({ORDERS_NULLS_SQL}) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
def q_top(spark, d):
    return ag.top_n(orders_nulls(spark, d), "o_totalprice", 10, tie_breaker="o_orderkey")


@query("topk_top_asc", f"SELECT * FROM ({ORDERS_NULLS_SQL}) ORDER BY o_totalprice ASC NULLS LAST, o_orderkey LIMIT 25")
def q_top_asc(spark, d):
    return ag.top_n(orders_nulls(spark, d), "o_totalprice", 25, ascending=True, tie_breaker="o_orderkey")


@query("topk_bottom", "SELECT * FROM events ORDER BY value ASC NULLS LAST, event_id LIMIT 10")
def q_bottom(spark, d):
    return ag.bottom_n(tb.table(spark, d, "events"), "value", 10, tie_breaker="event_id")


@query("agg_compare_periods", """
WITH s AS (SELECT coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01'), 0) AS current,
                  coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01'), 0) AS previous
           FROM orders)
SELECT round(current, 2) AS current, round(previous, 2) AS previous, round(current - previous, 2) AS change,
       round(CASE WHEN previous <> 0 THEN (current - previous) / previous * 100 ELSE 0 END, 6) AS change_percentage
FROM s
""")
def q_compare_periods(spark, d):
    r = ag.compare_periods(tb.table(spark, d, "orders"), "o_orderdate", "o_totalprice", dt.datetime(2000, 1, 1),
                           dt.datetime(1999, 1, 1))
    return r.select(*[F.round(c, 2).alias(c) for c in ("current", "previous", "change")],
                    F.round("change_percentage", 6).alias("change_percentage"))


@query("agg_compare_periods_bounded", """
WITH s AS (SELECT coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01'), 0) AS current,
                  coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01'
                                                      AND o_orderdate >= TIMESTAMP '1999-01-01'), 0) AS previous
           FROM orders)
SELECT round(current, 2) AS current, round(previous, 2) AS previous, round(current - previous, 2) AS change,
       round(CASE WHEN previous <> 0 THEN (current - previous) / previous * 100 ELSE 0 END, 6) AS change_percentage
FROM s
""")
def q_compare_bounded(spark, d):
    r = ag.compare_periods(tb.table(spark, d, "orders"), "o_orderdate", "o_totalprice", dt.datetime(2000, 1, 1),
                           dt.datetime(1999, 1, 1), bounded=True)
    return r.select(*[F.round(c, 2).alias(c) for c in ("current", "previous", "change")],
                    F.round("change_percentage", 6).alias("change_percentage"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("agg_crosstab_count", "SELECT o_orderstatus, " + ", ".join(
    f"""count(*) FILTER (WHERE o_orderpriority = '{p}') AS "{p}\"""" for p in PRIORITIES)
    + f" FROM ({ORDERS_NULLS_SQL}) WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1")
def q_crosstab_count(spark, d):
    return ag.cross_tabulation(orders_nulls(spark, d), "o_orderstatus", "o_orderpriority")


@query("agg_crosstab_value", "SELECT o_orderstatus, " + ", ".join(
    f"""round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 4) AS "{p}\"""" for p in PRIORITIES)
    + f" FROM ({ORDERS_NULLS_SQL}) WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1")
def q_crosstab_value(spark, d):
    return rounded(ag.cross_tabulation(orders_nulls(spark, d), "o_orderstatus", "o_orderpriority", "o_totalprice",
                                       "mean", column_values=PRIORITIES))


@query("agg_crosstab_last", "SELECT o_orderstatus, " + ", ".join(
    f"""round(arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority = '{p}' AND o_totalprice IS NOT NULL), 4) AS "{p}\""""
    for p in PRIORITIES) + f" FROM ({ORDERS_NULLS_SQL}) WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1")
def q_crosstab_last(spark, d):
    return rounded(ag.cross_tabulation(orders_nulls(spark, d), "o_orderstatus", "o_orderpriority", "o_totalprice",
                                       "last", column_values=PRIORITIES, order_by="o_orderkey"))


@query("agg_percentiles", """
SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS p75 FROM lineitem
""")
def q_percentiles(spark, d):
    return rounded(ag.percentiles(tb.table(spark, d, "lineitem"), "l_extendedprice"))


@query("agg_total_row", f"""
SELECT region, round(coalesce(sum(total_amount), 0), 2) AS total_amount, round(coalesce(sum(quantity), 0), 2) AS quantity,
       false AS is_total FROM {S} WHERE region IS NOT NULL GROUP BY region
UNION ALL SELECT 'TOTAL', round(sum(total_amount), 2), round(sum(quantity), 2), true FROM {S} WHERE region IS NOT NULL
""")
def q_total_row(spark, d):
    from ..operators import transform as tr
    by_region = tr.aggregate(tb.sales(spark, d), "region", {"total_amount": "sum", "quantity": "sum"})
    return rounded(ag.add_total_row(by_region, "region", ["total_amount", "quantity"]), 2)


@query("agg_metrics", f"""
SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS key, round(sum(total_amount), 2) AS value FROM {S}
UNION ALL SELECT 'mean', NULL, round(avg(total_amount), 2) FROM {S}
UNION ALL SELECT 'max', NULL, round(max(total_amount), 2) FROM {S}
UNION ALL SELECT 'min', NULL, round(min(total_amount), 2) FROM {S}
UNION ALL SELECT 'by_region', region, round(sum(total_amount), 2) FROM {S} WHERE region IS NOT NULL GROUP BY region
UNION ALL SELECT 'by_category', category, round(sum(total_amount), 2) FROM {S} WHERE category IS NOT NULL GROUP BY category
""")
def q_metrics(spark, d):
    return rounded(ag.calculate_metrics(tb.sales(spark, d), "total_amount", ["region", "category"]), 2)


@query("agg_group_sheets", f"""
SELECT 'region' AS dimension, region AS key, round(sum(total_amount), 2) AS value FROM {S} WHERE region IS NOT NULL GROUP BY region
UNION ALL SELECT 'category', category, round(sum(total_amount), 2) FROM {S} WHERE category IS NOT NULL GROUP BY category
""")
def q_group_sheets(spark, d):
    return rounded(ag.group_sheets(tb.sales(spark, d), "total_amount", ["region", "category"]), 2)
