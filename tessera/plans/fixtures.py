"""Derived inputs over the test tables (FIXTURES.md §5).

No column of the test tables holds a NULL, so the null rules are exercised on
``orders`` with NULLs injected by a fixed rule on the key; both the Spark form
and the SQL form below compute the same table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import tables as tb


def orders_nulls(spark, d):
    o = tb.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 11 == 0, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 5 == 0, None).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


ORDERS_NULLS_SQL = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""


def orders_nan(spark, d):
    """``orders_nulls`` with NaN in place of the missing prices (the SQL form has NULL there)."""
    price = F.coalesce("o_totalprice", F.lit(float("nan")))
    return orders_nulls(spark, d).withColumn("o_totalprice", price)


def orders_text(spark, d):
    """String-typed copies of order fields with unparsable values mixed in."""
    o = tb.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 13 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d_text"),
        F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.lit(" 7 ")).when(k % 19 == 0, F.lit(""))
        .otherwise(F.col("o_totalprice").cast("string")).alias("p_text"),
    )


ORDERS_TEXT_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d_text,
       CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 THEN ' 7 ' WHEN o_orderkey % 19 = 0 THEN ''
            ELSE CAST(o_totalprice AS VARCHAR) END AS p_text
FROM orders
"""


# ---- run-history tables derived from orders (runs) and lineitem (log lines) ----

def executions(spark, d):
    o = tb.table(spark, d, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "running")
              .otherwise("failed"))
    started = F.timestamp_add("MINUTE", (F.col("o_custkey") % 60).cast("int"), F.col("o_orderdate"))
    completed = F.when(status.isin("success", "failed"),
                       F.timestamp_add("SECOND", (F.col("o_orderkey") % 3600).cast("int"), started))
    err = F.when(status == "failed", F.lit("error in step transform"))
    step_status = F.when(status == "running", "running").otherwise(status)
    steps = F.array(
        F.struct(F.lit("extract").alias("name"), F.lit("success").alias("status"),
                 F.col("o_orderdate").alias("started_at"), started.alias("completed_at"),
                 F.lit(None).cast("string").alias("error")),
        F.struct(F.lit("transform").alias("name"), step_status.alias("status"), started.alias("started_at"),
                 completed.alias("completed_at"), err.alias("error")))
    return o.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("report_"), F.substring("o_orderpriority", 1, 1)).alias("report_name"),
        status.alias("status"),
        F.element_at(F.array(*[F.lit(t) for t in ("manual", "scheduled", "api", "retry")]),
                     (F.col("o_custkey") % 4 + 1).cast("int")).alias("trigger"),
        F.col("o_orderdate").alias("created_at"), started.alias("started_at"), completed.alias("completed_at"),
        F.concat(F.lit("/reports/run-"), F.col("o_orderkey").cast("string"), F.lit(".xlsx")).alias("output_path"),
        F.col("o_custkey").alias("row_count"), F.col("o_totalprice").cast("long").alias("file_size"),
        err.alias("error_message"), (F.col("o_orderkey") % 4).cast("int").alias("retry_count"),
        F.lit(3).alias("max_retries"), steps.alias("steps"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("metadata"))


EXECUTIONS_SQL = """
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS id, 'report_' || substr(o_orderpriority, 1, 1) AS report_name,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
       ['manual', 'scheduled', 'api', 'retry'][CAST(o_custkey % 4 + 1 AS INTEGER)] AS trigger,
       o_orderdate AS created_at,
       o_orderdate + to_minutes(CAST(o_custkey % 60 AS INTEGER)) AS started_at,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_minutes(CAST(o_custkey % 60 AS INTEGER))
            + to_seconds(CAST(o_orderkey % 3600 AS INTEGER)) END AS completed_at,
       CAST(o_orderkey % 4 AS INTEGER) AS retry_count, 3 AS max_retries, o_custkey AS row_count
FROM orders
"""


def execution_logs(spark, d):
    li = tb.table(spark, d, "lineitem")
    return li.select(
        F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")).alias("execution_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_returnflag") == "R", "ERROR").when(F.col("l_returnflag") == "A", "WARNING")
        .otherwise("INFO").alias("level"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("message"),
        F.concat(F.lit("step_"), F.col("l_linenumber").cast("string")).alias("step"),
        F.create_map(F.lit("qty"), F.col("l_quantity").cast("string")).alias("details"))


LOGS_SQL = """
SELECT 'run-' || CAST(l_orderkey AS VARCHAR) AS execution_id, l_shipdate AS timestamp,
       CASE l_returnflag WHEN 'R' THEN 'ERROR' WHEN 'A' THEN 'WARNING' ELSE 'INFO' END AS level,
       'line ' || CAST(l_linenumber AS VARCHAR) AS message, 'step_' || CAST(l_linenumber AS VARCHAR) AS step
FROM lineitem
"""


def status_events(spark, d):
    e = executions(spark, d)
    q = e.select(F.col("id").alias("run_id"), F.col("created_at").alias("ts"), F.lit("queued").alias("status"),
                 F.lit(0).alias("seq"))
    r = e.select(F.col("id").alias("run_id"), F.col("started_at").alias("ts"), F.lit("running").alias("status"),
                 F.lit(1).alias("seq"))
    c = e.where(F.col("completed_at").isNotNull()).select(
        F.col("id").alias("run_id"), F.col("completed_at").alias("ts"), "status", F.lit(2).alias("seq"))
    return q.unionByName(r).unionByName(c)
