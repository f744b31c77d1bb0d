"""Parquet tables of a data folder and the report roles built on them.

The reports of the reference read four source tables (sales, performance
metrics, monthly summary, training records). Over the TPC-H-like test data
they are views (see FIXTURES.md §5). Dimension tables with a fixed size by
construction (nation: 25 rows, region: 5 rows) are broadcast explicitly;
every other join is left to Spark's size-checked planner (AQE picks a
broadcast hash join only when the runtime size is below
``spark.sql.autoBroadcastJoinThreshold``, else a sort-merge join).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import literal_like, trunc_ntz

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, data_dir: str) -> DataFrame:
    """sales(date, product_id, product_name, category, quantity, unit_price,
    total_amount, customer_id, region) = lineitem ⋈ part ⋈ orders ⋈ customer ⋈ nation ⋈ region."""
    t = lambda n: table(spark, data_dir, n)
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    part = t("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    orders = t("orders").select("o_orderkey", "o_custkey")
    cust = t("customer").select("c_custkey", "c_nationkey")
    geo = (F.broadcast(t("nation").select("n_nationkey", "n_regionkey"))
           .join(F.broadcast(t("region").select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (li.join(part, li.l_partkey == part.p_partkey)
            .join(orders, li.l_orderkey == orders.o_orderkey)
            .join(cust, orders.o_custkey == cust.c_custkey)
            .join(geo, cust.c_nationkey == geo.n_nationkey)
            .select(F.col("l_shipdate").alias("date"),
                    F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.col("l_quantity").alias("quantity"),
                    F.col("p_retailprice").alias("unit_price"),
                    F.col("l_extendedprice").alias("total_amount"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("r_name").alias("region")))


SALES_SQL = """
SELECT l.l_shipdate AS date, p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS category,
       l.l_quantity AS quantity, p.p_retailprice AS unit_price, l.l_extendedprice AS total_amount,
       o.o_custkey AS customer_id, r.r_name AS region
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def performance(spark: SparkSession, data_dir: str) -> DataFrame:
    """performance_metrics over events: agent = user_id, team = event_type,
    sales_amount = value, date = ts. The columns the events table lacks are
    derived from it: calls_handled = 1 per event, avg_handling_time = length
    of props, first_call_resolution = (event_type <> 'error'),
    customer_satisfaction = the k of props mod 5 + 1, conversion_rate =
    (event_type = 'purchase') as 0/1."""
    ev = table(spark, data_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        F.col("ts").alias("date"),
        F.col("user_id").alias("agent_id"),
        F.concat(F.lit("agent_"), F.col("user_id").cast("string")).alias("agent_name"),
        F.col("event_type").alias("team"),
        F.lit(1).cast("long").alias("calls_handled"),
        F.length("props").cast("long").alias("avg_handling_time"),
        (F.col("event_type") != "error").alias("first_call_resolution"),
        (k % 5 + 1).cast("double").alias("customer_satisfaction"),
        F.col("value").alias("sales_amount"),
        (F.col("event_type") == "purchase").cast("double").alias("conversion_rate"),
        F.col("event_id"),
    )


PERFORMANCE_SQL = """
SELECT ts AS date, user_id AS agent_id, 'agent_' || CAST(user_id AS VARCHAR) AS agent_name,
       event_type AS team, CAST(1 AS BIGINT) AS calls_handled, CAST(length(props) AS BIGINT) AS avg_handling_time,
       (event_type <> 'error') AS first_call_resolution,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1 AS DOUBLE) AS customer_satisfaction,
       value AS sales_amount, CAST(event_type = 'purchase' AS DOUBLE) AS conversion_rate, event_id
FROM events
"""


def monthly(spark: SparkSession, data_dir: str, since: dt.datetime | None = None,
            until: dt.datetime | None = None) -> DataFrame:
    """monthly_summary: one row per (month, department = nation name).

    ``since`` and ``until`` (starts of months, half-open) reach the scan of
    orders; lineitem is then semi-joined with those orders first. lineitem is
    reduced to one row per order before the other joins (partial aggregation
    map-side), so they and the final group-by see orders, not line items."""
    t = lambda n: table(spark, data_dir, n)
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t("lineitem")
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= literal_like(orders, "o_orderdate", since))
    if until is not None:
        orders = orders.where(F.col("o_orderdate") < literal_like(orders, "o_orderdate", until))
    if since is not None or until is not None:
        lines = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    li = (lines.groupBy("l_orderkey")
          .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"),
               F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("cost"),
               F.count(F.lit(1)).alias("lines")))
    cust = t("customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(t("nation").select("n_nationkey", "n_name"))
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    month = trunc_ntz(F.col("o_orderdate"), "month")
    return (j.groupBy(month.alias("date"), F.col("n_name").alias("department"))
            .agg(F.sum("rev").alias("revenue"),
                 F.sum("cost").alias("costs"),
                 F.count(F.lit(1)).alias("headcount"),
                 F.sum("lines").alias("customer_count"),
                 F.count_distinct("o_custkey").alias("new_customers"))
            .withColumn("profit", F.col("revenue") - F.col("costs"))
            .withColumn("productivity_index", F.try_divide(F.col("revenue"), F.col("headcount")))
            .withColumn("churned_customers", F.lit(0).cast("long")))


MONTHLY_SQL = """
SELECT CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP) AS date, n.n_name AS department,
       sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue, sum(l.l_extendedprice * l.l_tax) AS costs,
       count(DISTINCT o.o_orderkey) AS headcount, count(*) AS customer_count,
       count(DISTINCT o.o_custkey) AS new_customers,
       sum(l.l_extendedprice * (1 - l.l_discount)) - sum(l.l_extendedprice * l.l_tax) AS profit,
       sum(l.l_extendedprice * (1 - l.l_discount)) / count(DISTINCT o.o_orderkey) AS productivity_index,
       CAST(0 AS BIGINT) AS churned_customers
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
"""


def training(spark: SparkSession, data_dir: str) -> DataFrame:
    """training_records = labels ⋈ documents: completed = quality, score = n_chars,
    certified = 1 - toxic, hours = n_chars / 1000, employee = source,
    completion_date = a day of 2024 by doc_id."""
    lab = table(spark, data_dir, "labels")
    docs = table(spark, data_dir, "documents").select("doc_id", "n_chars", "source", "lang")
    j = lab.join(docs, "doc_id")
    return j.select(
        "doc_id",
        F.col("source").alias("employee"),
        F.col("lang").alias("course"),
        (F.col("quality") == 1).alias("completed"),
        (F.col("toxic") == 0).alias("certified"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") / 1000.0).alias("hours"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(365)).cast("int")).alias("completion_date"),
    )


TRAINING_SQL = """
SELECT l.doc_id, d.source AS employee, d.lang AS course, (l.quality = 1) AS completed, (l.toxic = 0) AS certified,
       CAST(d.n_chars AS DOUBLE) AS score, d.n_chars / 1000.0 AS hours,
       DATE '2024-01-01' + CAST(l.doc_id % 365 AS INTEGER) AS completion_date
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""
