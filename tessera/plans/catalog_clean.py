"""Registered cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..sources import tables as tb
from .fixtures import ORDERS_NULLS_SQL, ORDERS_TEXT_SQL, orders_nan, orders_nulls, orders_text
from .registry import query, rounded

EV_SQL = "SELECT * FROM events"


@query("clean_dedup_first", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
""")
def q_dedup_first(spark, d):
    ev = tb.table(spark, d, "events")
    return cl.remove_duplicates(ev, ["user_id", "event_type"], keep="first", order_by=["ts", "event_id"])


@query("clean_dedup_last", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def q_dedup_last(spark, d):
    ev = tb.table(spark, d, "events")
    return cl.remove_duplicates(ev, ["user_id", "event_type"], keep="last", order_by=["ts", "event_id"])


@query("clean_dedup_none", """
SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1
""")
def q_dedup_none(spark, d):
    return cl.remove_duplicates(tb.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], keep=False)


@query("clean_dedup_rows", """
SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
""")
def q_dedup_rows(spark, d):
    o = tb.table(spark, d, "orders")
    return cl.remove_duplicates(o.unionByName(o.where(F.col("o_orderstatus") == "F")))


@query("clean_drop_nulls_any", f"""
SELECT * FROM ({ORDERS_NULLS_SQL}) WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL
  AND o_orderpriority IS NOT NULL
""")
def q_drop_any(spark, d):
    return cl.remove_nulls(orders_nulls(spark, d), how="any")


@query("clean_drop_nulls_all", f"""
SELECT * FROM ({ORDERS_NULLS_SQL}) WHERE o_totalprice IS NOT NULL OR o_orderpriority IS NOT NULL
""")
def q_drop_all(spark, d):
    return cl.remove_nulls(orders_nulls(spark, d), subset=["o_totalprice", "o_orderpriority"], how="all")


@query("clean_fill_value", f"""
SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, 'Unknown') AS o_orderstatus, o_totalprice, o_orderdate,
       coalesce(o_orderpriority, 'Unknown') AS o_orderpriority
FROM ({ORDERS_NULLS_SQL})
""")
def q_fill_value(spark, d):
    return cl.fill_nulls(orders_nulls(spark, d), value="Unknown")


@query("clean_fill_mean", f"""
WITH o AS ({ORDERS_NULLS_SQL})
SELECT o_orderkey, o_custkey, o_orderstatus, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM o)), 4)
       AS o_totalprice, o_orderdate, o_orderpriority FROM o
""")
def q_fill_mean(spark, d):
    return rounded(cl.fill_nulls(orders_nulls(spark, d), method="mean"))


@query("clean_fill_median", f"""
WITH o AS ({ORDERS_NULLS_SQL})
SELECT o_orderkey, o_custkey, o_orderstatus,
       round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM o)), 4) AS o_totalprice,
       o_orderdate, o_orderpriority FROM o
""")
def q_fill_median(spark, d):
    return rounded(cl.fill_nulls(orders_nulls(spark, d), method="median", columns=["o_totalprice"]))


@query("clean_fill_mode", f"""
WITH o AS ({ORDERS_NULLS_SQL}),
m AS (SELECT (SELECT o_orderstatus FROM o WHERE o_orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS ms,
             (SELECT o_orderpriority FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mp)
SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, ms) AS o_orderstatus, o_totalprice, o_orderdate,
       coalesce(o_orderpriority, mp) AS o_orderpriority
FROM o, m
""")
def q_fill_mode(spark, d):
    return cl.fill_nulls(orders_nulls(spark, d), method="mode", columns=["o_orderstatus", "o_orderpriority"])


@query("clean_to_datetime", f"""
SELECT o_orderkey, try_strptime(d_text, '%Y-%m-%d') AS d_text, p_text FROM ({ORDERS_TEXT_SQL})
""")
def q_to_datetime(spark, d):
    return cl.convert_types(orders_text(spark, d), {"d_text": "datetime"}, formats={"d_text": "yyyy-MM-dd"})


@query("clean_to_datetime_keep", f"""
SELECT * FROM ({ORDERS_TEXT_SQL})
""")
def q_to_datetime_keep(spark, d):
    # one unparsable value keeps the whole column unchanged (the reference's behaviour)
    return cl.convert_types(orders_text(spark, d), {"d_text": "datetime"}, on_error="keep",
                            formats={"d_text": "yyyy-MM-dd"})


@query("clean_to_numeric", f"""
SELECT o_orderkey, d_text, round(TRY_CAST(trim(p_text) AS DOUBLE), 4) AS p_text FROM ({ORDERS_TEXT_SQL})
""")
def q_to_numeric(spark, d):
    return rounded(cl.convert_types(orders_text(spark, d), {"p_text": "numeric"}))


@query("clean_astype", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def q_astype(spark, d):
    return cl.convert_types(tb.table(spark, d, "orders"), {"o_custkey": "str", "o_orderkey": "float64",
                                                           "no_such_column": "int"})


@query("clean_trim", r"""
SELECT c_custkey, regexp_replace(chr(9) || ' ' || c_name || ' ' || chr(10), '^\s+|\s+$', '', 'g') AS c_name,
       c_mktsegment FROM customer
""")
def q_trim(spark, d):
    c = tb.table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("\t "), "c_name", F.lit(" \n")).alias("c_name"), "c_mktsegment")
    return cl.trim_strings(c)


@query("clean_case_lower", "SELECT p_partkey, lower(p_name) AS p_name, lower(p_type) AS p_type FROM part")
def q_lower(spark, d):
    return cl.standardize_text(tb.table(spark, d, "part").select("p_partkey", "p_name", "p_type"),
                               ["p_name", "p_type"], "lower")


@query("clean_case_upper", "SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type FROM part")
def q_upper(spark, d):
    return cl.standardize_text(tb.table(spark, d, "part").select("p_partkey", "p_name", "p_type"),
                               ["p_name", "p_type"], "upper")


@query("clean_case_title", """
SELECT p_partkey,
  array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS p_name,
  array_to_string(list_transform(string_split(p_type, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS p_type
FROM part
""")
def q_title(spark, d):
    return cl.standardize_text(tb.table(spark, d, "part").select("p_partkey", "p_name", "p_type"),
                               ["p_name", "p_type"], "title")


@query("clean_outliers_iqr", """
WITH q1 AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem),
s1 AS (SELECT l.* FROM lineitem l, q1 WHERE l_extendedprice BETWEEN a - 0.25 * (b - a) AND b + 0.25 * (b - a)),
q2 AS (SELECT quantile_cont(l_quantity, 0.25) AS a, quantile_cont(l_quantity, 0.75) AS b FROM s1)
SELECT s1.* FROM s1, q2 WHERE l_quantity BETWEEN a - 0.2 * (b - a) AND b + 0.2 * (b - a)
""")
def q_outliers_iqr(spark, d):
    li = tb.table(spark, d, "lineitem")
    step1 = cl.remove_outliers(li, ["l_extendedprice"], "iqr", 0.25)
    return cl.remove_outliers(step1, ["l_quantity", "l_returnflag"], "iqr", 0.2)


@query("clean_outliers_zscore", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
SELECT o.* FROM orders o, s WHERE abs(o_totalprice - m) / sd <= 2
""")
def q_outliers_z(spark, d):
    return cl.remove_outliers(tb.table(spark, d, "orders"), "o_totalprice", "zscore", 2.0)


@query("clean_rename", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice AS amount, o_orderdate,
       o_orderpriority FROM orders
""")
def q_rename(spark, d):
    return cl.rename_columns(tb.table(spark, d, "orders"), {"o_orderkey": "order_id", "o_custkey": "customer_id",
                                                            "o_totalprice": "amount", "missing": "x"})


@query("clean_drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def q_drop_cols(spark, d):
    return cl.drop_columns(tb.table(spark, d, "orders"),
                           ["o_orderstatus", "o_totalprice", "o_orderpriority", "missing"])


@query("clean_summary", f"""
WITH o AS ({ORDERS_NULLS_SQL}),
s0 AS (SELECT count(*) AS n FROM o),
d AS (SELECT DISTINCT * FROM o),
s1 AS (SELECT count(*) AS n FROM d),
nn AS (SELECT * FROM d WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL),
s2 AS (SELECT count(*) AS n FROM nn),
z AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM nn),
s3 AS (SELECT count(*) AS n FROM nn, z WHERE abs(o_totalprice - m) / sd <= 2)
SELECT 1 AS step, 'remove_duplicates' AS operation, s0.n AS rows_before, s1.n AS rows_after, s0.n - s1.n AS rows_removed,
       6 AS columns_after FROM s0, s1
UNION ALL SELECT 2, 'remove_nulls', s1.n, s2.n, s1.n - s2.n, 6 FROM s1, s2
UNION ALL SELECT 3, 'remove_outliers', s2.n, s3.n, s2.n - s3.n, 6 FROM s2, s3
""")
def q_summary(spark, d):
    log = cl.CleaningLog(orders_nulls(spark, d))
    log.apply("remove_duplicates", cl.remove_duplicates)
    log.apply("remove_nulls", cl.remove_nulls)
    log.apply("remove_outliers", cl.remove_outliers, "o_totalprice", "zscore", 2.0)
    log.df.write.format("noop").mode("overwrite").save()   # the one action; counts are observed on the way
    return log.to_frame(spark)


# ---- NaN counts as missing; NULL order keys come last ----
@query("clean_fill_mean_nan", f"""
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM ({ORDERS_NULLS_SQL}))), 4) AS o_totalprice
FROM ({ORDERS_NULLS_SQL})
""")
def q_fill_mean_nan(spark, d):
    o = orders_nan(spark, d).select("o_orderkey", "o_totalprice")
    return rounded(cl.fill_nulls(o, method="mean", columns=["o_totalprice"]))


@query("clean_fill_median_nan", f"""
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM ({ORDERS_NULLS_SQL}))), 4)
       AS o_totalprice
FROM ({ORDERS_NULLS_SQL})
""")
def q_fill_median_nan(spark, d):
    o = orders_nan(spark, d).select("o_orderkey", "o_totalprice")
    return rounded(cl.fill_nulls(o, method="median", columns=["o_totalprice"]))


@query("clean_outliers_zscore_nan", f"""
WITH o AS ({ORDERS_NULLS_SQL}), s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM o)
SELECT o.* FROM o, s WHERE abs(o_totalprice - m) / sd <= 1.5
""")
def q_zscore_nan(spark, d):
    return cl.remove_outliers(orders_nan(spark, d), "o_totalprice", "zscore", 1.5)


@query("agg_group_nan", f"""
SELECT o_orderpriority, count(o_totalprice) AS o_totalprice_count, round(avg(o_totalprice), 4) AS o_totalprice_mean,
       round(sum(o_totalprice), 2) AS o_totalprice_sum
FROM ({ORDERS_NULLS_SQL}) WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""")
def q_group_nan(spark, d):
    from ..operators import transform as tr
    g = tr.aggregate(orders_nan(spark, d), "o_orderpriority", {"o_totalprice": ["count", "mean", "sum"]})
    return rounded(g).withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


@query("topk_top_nan", f"""
SELECT o_orderkey, o_totalprice FROM ({ORDERS_NULLS_SQL}) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10
""")
def q_top_nan(spark, d):
    from ..operators import aggregate as ag
    return ag.top_n(orders_nan(spark, d).select("o_orderkey", "o_totalprice"), "o_totalprice", 10, tie_breaker="o_orderkey")


@query("clean_dedup_first_null_order", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority NULLS LAST, o_totalprice NULLS LAST,
             o_orderkey) AS rn FROM ({ORDERS_NULLS_SQL})) WHERE rn = 1
""")
def q_dedup_null_order(spark, d):
    return cl.remove_duplicates(orders_nulls(spark, d), "o_custkey", "first",
                                order_by=["o_orderpriority", "o_totalprice", "o_orderkey"])
