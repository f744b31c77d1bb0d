"""Registered transformation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import transform as tr
from ..sources import tables as tb
from .fixtures import ORDERS_NULLS_SQL, orders_nulls
from .registry import query, rounded
from .steps import apply_transformations


@query("tx_add_literal", "SELECT *, 'Q1' AS batch, CAST(1.5 AS DOUBLE) AS weight FROM orders")
def q_add_literal(spark, d):
    o = tr.add_column(tb.table(spark, d, "orders"), "batch", "Q1")
    return tr.add_column(o, "weight", 1.5)


@query("tx_add_formula", """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS adjusted,
       o_orderkey + o_custkey AS key_sum
FROM orders
""")
def q_add_formula(spark, d):
    o = tb.table(spark, d, "orders")
    o = tr.add_column(o, "adjusted", formula=lambda r: r["o_totalprice"] * 2 if r["o_orderstatus"] == "F"
                      else r["o_totalprice"])
    return tr.add_column(o, "key_sum", formula="o_orderkey + o_custkey")


@query("tx_calculate", """
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_tax = 0 THEN NULL ELSE (l_extendedprice * l_discount / l_tax) * 100 END, 4) AS tax_ratio,
       round(l_extendedprice * (1 - l_discount), 4) AS net
FROM lineitem
""")
def q_calculate(spark, d):
    li = tb.table(spark, d, "lineitem")
    li = tr.calculate_column(li, "tax_ratio", "(l_extendedprice * l_discount / l_tax) * 100")
    li = tr.calculate_column(li, "net", "l_extendedprice * (1 - l_discount)")
    return rounded(li.select("l_orderkey", "l_linenumber", "tax_ratio", "net"))


@query("tx_aggregate", f"""
WITH s AS ({tb.SALES_SQL})
SELECT region, category, round(coalesce(sum(total_amount), 0), 4) AS total_amount,
       round(avg(quantity), 4) AS quantity_mean, max(quantity) AS quantity_max, count(quantity) AS quantity_count,
       count(DISTINCT customer_id) AS customer_id
FROM s WHERE region IS NOT NULL AND category IS NOT NULL GROUP BY region, category
""")
def q_aggregate(spark, d):
    return rounded(tr.aggregate(tb.sales(spark, d), ["region", "category"],
                                {"total_amount": "sum", "quantity": ["mean", "max", "count"],
                                 "customer_id": "nunique"}))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pivot_sql(src: str, index: str, col: str, val: str) -> str:
    cells = ",\n".join(
        f"""round(CASE WHEN count(*) FILTER (WHERE {col} = '{p}') > 0
              THEN coalesce(sum({val}) FILTER (WHERE {col} = '{p}'), 0) END, 4) AS "{p}\""""
        for p in PRIORITIES)
    return f"SELECT {index}, {cells} FROM ({src}) WHERE {index} IS NOT NULL AND {col} IS NOT NULL GROUP BY {index}"


@query("tx_pivot", _pivot_sql(ORDERS_NULLS_SQL, "o_orderstatus", "o_orderpriority", "o_totalprice"))
def q_pivot(spark, d):
    return rounded(tr.pivot(orders_nulls(spark, d), "o_orderstatus", "o_orderpriority", "o_totalprice", "sum",
                            column_values=PRIORITIES))


@query("tx_pivot_discover", _pivot_sql("SELECT * FROM orders", "o_orderstatus", "o_orderpriority", "o_totalprice"))
def q_pivot_discover(spark, d):
    return rounded(tr.pivot(tb.table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice"))


_EDGE = ["o_orderdate", "o_orderkey"]


@query("tx_pivot_first", "SELECT o_orderstatus, " + ", ".join(
    f"""round(arg_min(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderpriority = '{p}' AND o_totalprice IS NOT NULL), 4) AS "{p}\""""
    for p in PRIORITIES) + f" FROM ({ORDERS_NULLS_SQL}) WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1")
def q_pivot_first(spark, d):
    return rounded(tr.pivot(orders_nulls(spark, d), "o_orderstatus", "o_orderpriority", "o_totalprice", "first",
                            column_values=PRIORITIES, order_by=_EDGE))


@query("tx_resample_last", f"""
WITH b AS (SELECT date_trunc('month', o_orderdate) AS m,
                  arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_totalprice IS NOT NULL) AS p
           FROM ({ORDERS_NULLS_SQL}) GROUP BY 1),
s AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM b)
SELECT CAST(last_day(s.m) AS TIMESTAMP) AS o_orderdate, round(b.p, 4) AS o_totalprice FROM s LEFT JOIN b ON s.m = b.m
""")
def q_resample_last(spark, d):
    o = orders_nulls(spark, d).select("o_orderdate", "o_totalprice", F.col("o_orderkey").cast("string").alias("key"),
                                      F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("padded"))
    out = tr.resample_time(o, "o_orderdate", "M", "last", order_by=["o_orderdate", "padded"])
    return rounded(out.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")))


@query("tx_aggregate_more", """
WITH v AS (SELECT *, 1 + l_discount / 10000 AS f FROM lineitem),
m AS (SELECT l_returnflag, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_suppkey) AS k
      FROM lineitem GROUP BY 1, 2)
SELECT v.l_returnflag, round(product(f), 4) AS f, bool_or(l_tax <> 0) AS l_tax_any, bool_and(l_tax <> 0) AS l_tax_all,
       round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS l_quantity_sem, round(skewness(l_quantity), 6) AS l_quantity_skew,
       round(quantile_cont(l_extendedprice, 0.9), 4) AS l_extendedprice_q90, any_value(m.l_suppkey) AS l_suppkey
FROM v JOIN m ON m.l_returnflag = v.l_returnflag AND m.k = 1 GROUP BY 1
""")
def q_aggregate_more(spark, d):
    li = tb.table(spark, d, "lineitem").withColumn("f", 1 + F.col("l_discount") / 10000)
    out = tr.aggregate(li, "l_returnflag", {"f": "prod", "l_tax": ["any", "all"], "l_quantity": ["sem", "skew"],
                                            "l_extendedprice": ["q90"], "l_suppkey": "mode"})
    return (out.withColumns({"f": F.round("f", 4), "l_extendedprice_q90": F.round("l_extendedprice_q90", 4)})
            .withColumns({c: F.round(c, 6) for c in ("l_quantity_sem", "l_quantity_skew")}))


@query("tx_melt", """
SELECT o_orderkey, 'o_totalprice' AS variable, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders
""")
def q_melt(spark, d):
    o = tb.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return tr.melt(o, "o_orderkey", ["o_totalprice", "o_custkey"])


@query("tx_sort", f"SELECT * FROM ({ORDERS_NULLS_SQL}) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey")
def q_sort(spark, d):
    return tr.sort(orders_nulls(spark, d), ["o_totalprice", "o_orderkey"], [False, True])


_FILTERS = {
    "eq": ("o_orderpriority", "eq", "1-URGENT", "o_orderpriority = '1-URGENT'"),
    "ne": ("o_orderpriority", "ne", "1-URGENT", "o_orderpriority IS DISTINCT FROM '1-URGENT'"),
    "gt": ("o_totalprice", "gt", 200000.0, "o_totalprice > 200000"),
    "lt": ("o_totalprice", "lt", 50000.0, "o_totalprice < 50000"),
    "gte": ("o_totalprice", "gte", 150000.0, "o_totalprice >= 150000"),
    "lte": ("o_totalprice", "lte", 100000.0, "o_totalprice <= 100000"),
    "in": ("o_orderpriority", "in", ["1-URGENT", "5-LOW", None],
           "(o_orderpriority IN ('1-URGENT', '5-LOW') OR o_orderpriority IS NULL)"),
    "contains": ("o_orderpriority", "contains", "URG|SPEC",
                 "coalesce(regexp_matches(o_orderpriority, 'URG|SPEC'), false)"),
}


def _filter_query(name, column, cond, value, where):
    @query(f"tx_filter_{name}", f"SELECT * FROM ({ORDERS_NULLS_SQL}) WHERE {where}")
    def q(spark, d):
        return tr.filter_rows(orders_nulls(spark, d), column, cond, value)
    return q


for _n, (_c, _cond, _v, _w) in _FILTERS.items():
    _filter_query(_n, _c, _cond, _v, _w)


@query("tx_filter_all", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def q_filter_all(spark, d):
    return tr.filter_all(tb.table(spark, d, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


def _join_inputs(spark, d):
    c = tb.table(spark, d, "customer")
    n = tb.table(spark, d, "nation")
    left = c.select("c_custkey", F.col("c_name").alias("name"),
                    F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_nationkey")).alias("nkey"))
    right = n.select(F.when(F.col("n_nationkey") % 7 == 0, None).otherwise(F.col("n_nationkey")).alias("nkey"),
                     F.col("n_name").alias("name"), "n_regionkey")
    return left, right


_JL = "(SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nkey FROM customer)"
_JR = "(SELECT CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_nationkey END AS nkey, n_name AS name, n_regionkey FROM nation)"


def _join_query(how, sql_how, key_expr):
    @query(f"tx_join_{how}", f"""
    SELECT l.c_custkey, l.name AS name_x, {key_expr} AS nkey, r.name AS name_y, r.n_regionkey
    FROM {_JL} l {sql_how} JOIN {_JR} r ON l.nkey IS NOT DISTINCT FROM r.nkey
    """)
    def q(spark, d):
        left, right = _join_inputs(spark, d)
        return tr.join(left, right, "nkey", how)
    return q


_join_query("left", "LEFT", "l.nkey")
_join_query("right", "RIGHT", "coalesce(l.nkey, r.nkey)")
_join_query("inner", "INNER", "l.nkey")
_join_query("outer", "FULL OUTER", "coalesce(l.nkey, r.nkey)")


@query("tx_apply", "SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS first_word FROM part")
def q_apply(spark, d):
    p = tb.table(spark, d, "part").select("p_partkey", "p_name")
    return tr.apply_function(p, "p_name", lambda s: s.split(" ")[0], "first_word", "string")


_RESAMPLE_LABEL = {
    "D": "CAST({s} AS DATE)",
    "W": "CAST({s} AS DATE) + 6",
    "M": "last_day({s})",
    "Q": "last_day({s} + INTERVAL 2 MONTH)",
    "Y": "make_date(year({s}), 12, 31)",
}
_RESAMPLE_TRUNC = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
_RESAMPLE_STEP = {"D": "1 day", "W": "7 days", "M": "1 month", "Q": "3 months", "Y": "1 year"}
_RESAMPLE_FUNC = {"D": "sum", "W": "mean", "M": "sum", "Q": "max", "Y": "sum"}
_SQL_AGG = {"sum": "coalesce(sum({c}), 0)", "mean": "avg({c})", "max": "max({c})"}


def _resample_query(freq):
    func = _RESAMPLE_FUNC[freq]
    agg = _SQL_AGG[func]
    fill = "coalesce({}, 0)" if func == "sum" else "{}"
    sql = f"""
    WITH b AS (SELECT CAST(date_trunc('{_RESAMPLE_TRUNC[freq]}', o_orderdate) AS DATE) AS s,
                      {agg.format(c='o_totalprice')} AS o_totalprice, {agg.format(c='o_custkey')} AS o_custkey
               FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
    sp AS (SELECT CAST(unnest(generate_series(min(s), max(s), INTERVAL '{_RESAMPLE_STEP[freq]}')) AS DATE) AS s FROM b)
    SELECT CAST({_RESAMPLE_LABEL[freq].format(s='sp.s')} AS TIMESTAMP) AS o_orderdate,
           round({fill.format('b.o_totalprice')}, 4) AS o_totalprice,
           round(CAST({fill.format('b.o_custkey')} AS DOUBLE), 4) AS o_custkey
    FROM sp LEFT JOIN b ON sp.s = b.s
    """

    @query(f"tx_resample_{freq}", sql)
    def q(spark, d):
        o = tb.table(spark, d, "orders").select("o_orderdate", "o_totalprice", "o_custkey")
        r = tr.resample_time(o, "o_orderdate", freq, func)
        return rounded(r.withColumn("o_custkey", F.col("o_custkey").cast("double")))
    return q


for _f in ("D", "W", "M", "Q", "Y"):
    _resample_query(_f)


MONTHLY_STEPS = [
    {"type": "aggregate", "groupby": ["department"],
     "metrics": {"revenue": "sum", "costs": "sum", "profit": "sum", "headcount": "mean",
                 "productivity_index": "mean", "customer_count": "last", "new_customers": "sum",
                 "churned_customers": "sum"}},
    {"type": "calculate", "name": "profit_margin", "expression": "(profit / revenue) * 100"},
    {"type": "calculate", "name": "net_customer_growth", "expression": "new_customers - churned_customers"},
    {"type": "filter", "column": "revenue", "condition": "gt", "value": 0},
    {"type": "sort", "by": "profit", "ascending": False},
]


@query("tx_steps", f"""
WITH m AS ({tb.MONTHLY_SQL}),
a AS (SELECT department, sum(revenue) AS revenue, sum(costs) AS costs, sum(profit) AS profit,
             avg(headcount) AS headcount, avg(productivity_index) AS productivity_index,
             arg_max(customer_count, date) AS customer_count, sum(new_customers) AS new_customers,
             sum(churned_customers) AS churned_customers
      FROM m WHERE department IS NOT NULL GROUP BY department)
SELECT department, round(revenue, 4) AS revenue, round(costs, 4) AS costs, round(profit, 4) AS profit,
       round(headcount, 4) AS headcount, round(productivity_index, 4) AS productivity_index, customer_count,
       new_customers, churned_customers, round(profit / revenue * 100, 4) AS profit_margin,
       new_customers - churned_customers AS net_customer_growth
FROM a WHERE revenue > 0 ORDER BY profit DESC
""")
def q_steps(spark, d):
    # money columns have 4 exact decimals (price × (1 - discount)); rounding to 2 would sit on ties
    return rounded(apply_transformations(tb.monthly(spark, d), MONTHLY_STEPS, order_by="date"), 4)


@query("tx_aggregate_median", f"""
WITH s AS ({tb.SALES_SQL})
SELECT region, round(quantile_cont(total_amount, 0.5), 4) AS total_amount_median,
       round(avg(total_amount), 4) AS total_amount_mean, round(quantile_cont(quantity, 0.5), 4) AS quantity
FROM s WHERE region IS NOT NULL GROUP BY region
""")
def q_aggregate_median(spark, d):
    return rounded(tr.aggregate(tb.sales(spark, d), "region",
                                {"total_amount": ["median", "mean"], "quantity": "median"}))
