"""Registered period, chart, data-quality and run-history queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.time import trunc_ntz
from ..operators import charts as ch
from ..operators import history as hi
from ..operators import periods as pe
from ..operators import quality as dq
from ..sources import tables as tb
from .fixtures import (EXECUTIONS_SQL, LOGS_SQL, ORDERS_NULLS_SQL, ORDERS_TEXT_SQL, execution_logs, executions,
                       orders_nulls, orders_text, status_events)
from .registry import query, rounded

# ---- periods: day/week periods over events (as of Wed 2024-01-17), month and longer over orders ----
_EV_AS_OF = dt.date(2024, 1, 17)
_OR_AS_OF = dt.date(2000, 3, 15)
_PERIOD_SQL = {
    "today": ("events", "ts", "TIMESTAMP '2024-01-17'", "TIMESTAMP '2024-01-18'"),
    "yesterday": ("events", "ts", "TIMESTAMP '2024-01-16'", "TIMESTAMP '2024-01-17'"),
    "this_week": ("events", "ts", "TIMESTAMP '2024-01-15'", "TIMESTAMP '2024-01-22'"),
    "last_week": ("events", "ts", "TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-15'"),
    "this_month": ("orders", "o_orderdate", "TIMESTAMP '2000-03-01'", "TIMESTAMP '2000-04-01'"),
    "last_month": ("orders", "o_orderdate", "TIMESTAMP '2000-02-01'", "TIMESTAMP '2000-03-01'"),
    "this_quarter": ("orders", "o_orderdate", "TIMESTAMP '2000-01-01'", "TIMESTAMP '2000-04-01'"),
    "this_year": ("orders", "o_orderdate", "TIMESTAMP '2000-01-01'", "TIMESTAMP '2001-01-01'"),
}


def _period_query(period):
    table, col, lo, hi_ = _PERIOD_SQL[period]

    @query(f"period_{period}", f"SELECT * FROM {table} WHERE {col} >= {lo} AND {col} < {hi_}")
    def q(spark, d):
        as_of = _EV_AS_OF if table == "events" else _OR_AS_OF
        return pe.filter_period(tb.table(spark, d, table), col, period, as_of)
    return q


for _p in pe.PERIODS:
    _period_query(_p)


# ---- chart data ----
@query("chart_histogram", """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) * (20 / (hi - lo))) + 1, 20) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, b GROUP BY 1),
s AS (SELECT CAST(unnest(generate_series(1, 20)) AS INTEGER) AS bin)
SELECT s.bin, round(lo + (s.bin - 1) * (hi - lo) / 20, 4) AS bin_start,
       round(CASE WHEN s.bin = 20 THEN hi ELSE lo + s.bin * (hi - lo) / 20 END, 4) AS bin_end, coalesce(n, 0) AS count
FROM s CROSS JOIN b LEFT JOIN c ON s.bin = c.bin
""")
def q_histogram(spark, d):
    return rounded(ch.histogram(tb.table(spark, d, "lineitem"), "l_extendedprice", 20))


@query("chart_pie_share", f"""
WITH g AS (SELECT region, sum(total_amount) AS total_amount FROM ({tb.SALES_SQL}) WHERE region IS NOT NULL GROUP BY 1)
SELECT region, round(total_amount, 2) AS total_amount, round(total_amount / (SELECT sum(total_amount) FROM g) * 100, 1)
       AS percentage FROM g
""")
def q_pie(spark, d):
    p = ch.pie_share(tb.sales(spark, d), "region", "total_amount")
    return p.withColumn("total_amount", F.round("total_amount", 2))


_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("chart_heatmap", "SELECT o_orderstatus, " + ", ".join(
    f"""round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 2) AS "{p}\"""" for p in _PRI)
    + " FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1")
def q_heatmap(spark, d):
    return ch.heatmap(tb.table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice", "mean", _PRI)


@query("chart_series", f"""
WITH g AS (SELECT date_trunc('day', date) AS day, team, coalesce(sum(sales_amount), 0) AS sales_amount,
                  coalesce(sum(calls_handled), 0) AS calls_handled
           FROM ({tb.PERFORMANCE_SQL}) WHERE date IS NOT NULL AND team IS NOT NULL GROUP BY 1, 2)
SELECT day, team, 'sales_amount' AS series, round(sales_amount, 4) AS y FROM g
UNION ALL SELECT day, team, 'calls_handled', CAST(calls_handled AS DOUBLE) FROM g
""")
def q_series(spark, d):
    perf = tb.performance(spark, d).withColumn("day", trunc_ntz(F.col("date"), "day"))
    s = ch.series(perf.withColumn("calls_handled", F.col("calls_handled").cast("double")), "day",
                  ["sales_amount", "calls_handled"], color="team")
    return rounded(s)


# ---- data quality ----
def _emails(spark, d):
    c = tb.table(spark, d, "customer")
    mail = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("bad#"), F.col("c_custkey").cast("string"), F.lit("@x")))
    mail = mail.when(F.col("c_custkey") % 10 == 0, F.lit(None))
    mail = mail.otherwise(F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@mail.example.com")))
    return c.select("c_custkey", mail.alias("email"), "c_mktsegment", "c_acctbal")


_EMAILS_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'bad#' || CAST(c_custkey AS VARCHAR) || '@x'
                       WHEN c_custkey % 10 = 0 THEN NULL
                       ELSE lower(replace(c_name, '#', '.')) || '@mail.example.com' END AS email,
       c_mktsegment, c_acctbal FROM customer
"""
_EMAIL_RE = dq.EMAIL_PATTERN


@query("dq_email", f"""
SELECT c_custkey, email, (email IS NULL OR regexp_full_match(email, '{_EMAIL_RE}')) AS valid FROM ({_EMAILS_SQL})
""")
def q_dq_email(spark, d):
    r = dq.email("email")
    return _emails(spark, d).select("c_custkey", "email", r.passes.alias("valid"))


@query("dq_date", f"""
SELECT o_orderkey, d_text, (d_text IS NULL OR try_strptime(d_text, '%Y-%m-%d') IS NOT NULL) AS valid FROM ({ORDERS_TEXT_SQL})
""")
def q_dq_date(spark, d):
    return orders_text(spark, d).select("o_orderkey", "d_text", dq.date("d_text").passes.alias("valid"))


@query("dq_date_range", """
SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate, (o_orderdate <= l_shipdate) AS valid
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def q_dq_date_range(spark, d):
    li = tb.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = tb.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    return j.select("*", dq.date_range("o_orderdate", "l_shipdate").passes.alias("valid"))


@query("dq_numeric_range", """
SELECT l_orderkey, l_linenumber, l_discount, (l_discount BETWEEN 0 AND 0.05) AS valid FROM lineitem
""")
def q_dq_numeric(spark, d):
    li = tb.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return li.withColumn("valid", dq.numeric_range("l_discount", 0, 0.05).passes)


@query("dq_length", "SELECT p_partkey, p_name, (length(p_name) BETWEEN 20 AND 40) AS valid FROM part")
def q_dq_length(spark, d):
    p = tb.table(spark, d, "part").select("p_partkey", "p_name")
    return p.withColumn("valid", dq.length("p_name", 20, 40).passes)


@query("dq_choice", f"""
SELECT o_orderkey, o_orderpriority, (o_orderpriority IS NULL OR o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
       AS valid FROM ({ORDERS_NULLS_SQL})
""")
def q_dq_choice(spark, d):
    o = orders_nulls(spark, d).select("o_orderkey", "o_orderpriority")
    return o.withColumn("valid", dq.choice("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).passes)


@query("dq_table", """
SELECT [] :: VARCHAR[] AS missing_columns, count(*) AS row_count, (count(*) >= 1 AND count(*) <= 10000000) AS ok
FROM lineitem
""")
def q_dq_table(spark, d):
    return dq.validate_table(tb.table(spark, d, "lineitem"), ["l_orderkey", "l_quantity"], 1, 10_000_000)


def _rules():
    return [dq.email("email"), dq.numeric_range("c_acctbal", 0, None, name="acctbal_non_negative"),
            dq.choice("c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"]), dq.not_null("email")]


_RULES_SQL = [
    ("email_email", "email", f"NOT (email IS NULL OR regexp_full_match(email, '{_EMAIL_RE}'))", "count(email)"),
    ("acctbal_non_negative", "c_acctbal", "NOT (c_acctbal IS NULL OR c_acctbal >= 0)", "count(c_acctbal)"),
    ("c_mktsegment_choice", "c_mktsegment",
     "NOT (c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY'))", "count(c_mktsegment)"),
    ("email_not_null", "email", "email IS NULL", "count(*)"),
]


@query("dq_report", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, {chk} AS checked, count(*) FILTER (WHERE {fail}) AS failed FROM ({_EMAILS_SQL})"
    for n, _, fail, chk in _RULES_SQL))
def q_dq_report(spark, d):
    return dq.quality_report(_emails(spark, d), _rules())


@query("dq_quarantine", f"""
SELECT c_custkey, email, c_mktsegment, c_acctbal,
       concat_ws(',', {', '.join(f"CASE WHEN {fail} THEN '{n}' END" for n, _, fail, _c in _RULES_SQL)}) AS failed_rules
FROM ({_EMAILS_SQL})
WHERE {' OR '.join(f'({fail})' for _n, _, fail, _c in _RULES_SQL)}
""")
def q_dq_quarantine(spark, d):
    _good, bad = dq.split(_emails(spark, d), _rules())
    return bad.withColumn("failed_rules", F.array_join("failed_rules", ","))


# ---- run history ----
@query("hist_recent", f"""
SELECT id, report_name, status, created_at FROM ({EXECUTIONS_SQL}) ORDER BY created_at DESC NULLS LAST, id LIMIT 10
""")
def q_hist_recent(spark, d):
    return hi.recent(executions(spark, d), 10).select("id", "report_name", "status", "created_at")


@query("hist_by_report", f"SELECT id, status, created_at FROM ({EXECUTIONS_SQL}) WHERE report_name = 'report_1'")
def q_hist_by_report(spark, d):
    return hi.by_report(executions(spark, d), "report_1").select("id", "status", "created_at")


@query("hist_logs", f"""
SELECT execution_id, timestamp, level, message, step FROM ({LOGS_SQL})
WHERE execution_id IN (SELECT id FROM ({EXECUTIONS_SQL}) WHERE status = 'failed')
""")
def q_hist_logs(spark, d):
    runs = executions(spark, d).where(F.col("status") == "failed")
    return hi.logs_of(execution_logs(spark, d), runs).drop("details")


@query("hist_purge", f"""
SELECT execution_id, timestamp, level, message, step FROM ({LOGS_SQL})
WHERE execution_id NOT IN (SELECT id FROM ({EXECUTIONS_SQL}) WHERE created_at < TIMESTAMP '1998-01-01')
""")
def q_hist_purge(spark, d):
    _kept, kept_logs, _n = hi.purge(executions(spark, d), execution_logs(spark, d), dt.datetime(1998, 1, 1))
    return kept_logs.drop("details")


@query("hist_purge_count", f"""
SELECT count(*) FILTER (WHERE created_at < TIMESTAMP '1998-01-01') AS removed_runs FROM ({EXECUTIONS_SQL})
""")
def q_hist_purge_count(spark, d):
    return hi.purge(executions(spark, d), execution_logs(spark, d), dt.datetime(1998, 1, 1))[2]


@query("hist_duration", f"""
SELECT id, report_name, status, CAST(epoch_us(completed_at) - epoch_us(started_at) AS DOUBLE) / 1e6 AS duration_seconds,
       status IN ('success', 'failed', 'cancelled') AS is_finished,
       (status = 'failed' AND retry_count < max_retries) AS can_retry
FROM ({EXECUTIONS_SQL})
""")
def q_hist_duration(spark, d):
    return hi.durations(executions(spark, d))


@query("hist_steps", f"""
SELECT id, 0 AS step_index, 'extract' AS step_name, 'success' AS step_status,
       CAST(epoch_us(started_at) - epoch_us(created_at) AS DOUBLE) / 1e6 AS step_seconds FROM ({EXECUTIONS_SQL})
UNION ALL
SELECT id, 1, 'transform', status, CAST(epoch_us(completed_at) - epoch_us(started_at) AS DOUBLE) / 1e6
FROM ({EXECUTIONS_SQL})
""")
def q_hist_steps(spark, d):
    return hi.step_rows(executions(spark, d))


@query("hist_current_step", f"""
SELECT id, CASE WHEN status = 'running' THEN 'transform' END AS current_step FROM ({EXECUTIONS_SQL})
""")
def q_hist_current_step(spark, d):
    return hi.current_step(executions(spark, d))


_RUN_JSON_SQL = """
WITH r AS (
  SELECT o.*, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failed' END AS st,
         o_orderdate + to_minutes(CAST(o_custkey % 60 AS INTEGER)) AS started
  FROM orders o),
r2 AS (SELECT *, CASE WHEN st IN ('success', 'failed') THEN started + to_seconds(CAST(o_orderkey % 3600 AS INTEGER)) END
              AS completed,
              CASE WHEN st = 'failed' THEN 'error in step transform' END AS err FROM r)
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS id, CAST(to_json({
  'id': 'run-' || CAST(o_orderkey AS VARCHAR), 'report_name': 'report_' || substr(o_orderpriority, 1, 1),
  'status': st, 'trigger': ['manual', 'scheduled', 'api', 'retry'][CAST(o_custkey % 4 + 1 AS INTEGER)],
  'created_at': strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'started_at': strftime(started, '%Y-%m-%d %H:%M:%S'),
  'completed_at': strftime(completed, '%Y-%m-%d %H:%M:%S'),
  'output_path': '/reports/run-' || CAST(o_orderkey AS VARCHAR) || '.xlsx', 'row_count': o_custkey,
  'file_size': CAST(trunc(o_totalprice) AS BIGINT), 'error_message': err,
  'retry_count': CAST(o_orderkey % 4 AS INTEGER), 'max_retries': 3,
  'steps': [{'name': 'extract', 'status': 'success', 'started_at': strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
             'completed_at': strftime(started, '%Y-%m-%d %H:%M:%S'), 'error': CAST(NULL AS VARCHAR)},
            {'name': 'transform', 'status': st, 'started_at': strftime(started, '%Y-%m-%d %H:%M:%S'),
             'completed_at': strftime(completed, '%Y-%m-%d %H:%M:%S'), 'error': err}],
  'metadata': MAP {'priority': o_orderpriority}}) AS VARCHAR) AS json
FROM r2
"""


@query("hist_json", _RUN_JSON_SQL)
def q_hist_json(spark, d):
    return hi.to_json(executions(spark, d))


@query("hist_log_json", f"""
SELECT to_json({{'execution_id': execution_id, 'timestamp': strftime(timestamp, '%Y-%m-%d %H:%M:%S'),
                 'level': level, 'message': message, 'step': step}}) AS json
FROM ({LOGS_SQL})
""")
def q_hist_log_json(spark, d):
    return hi.log_json(execution_logs(spark, d))


@query("hist_latest_status", f"""
SELECT id AS run_id, status, coalesce(completed_at, started_at) AS updated_at FROM ({EXECUTIONS_SQL})
""")
def q_hist_latest(spark, d):
    return hi.latest_status(status_events(spark, d))
