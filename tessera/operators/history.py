"""Run-history tables: executions (one row per run) and execution_logs.

Schemas (as the reference's run record, re-aimed to tables):
  executions: id, report_name, status, trigger, created_at, started_at, completed_at,
              output_path, row_count, file_size, error_message, retry_count, max_retries,
              steps array<struct<name,status,started_at,completed_at,error>>, metadata map<string,string>
  execution_logs: execution_id, timestamp, level, message, step, details map<string,string>
  status_events: run_id, ts, status   (append-only; the latest event wins)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import literal_like, seconds_between, wall_text

FINISHED = ("success", "failed", "cancelled")


def recent(executions: DataFrame, limit: int = 10) -> DataFrame:
    """Newest ``limit`` runs by created_at (id breaks ties)."""
    return executions.orderBy(F.col("created_at").desc_nulls_last(), F.col("id").asc()).limit(limit)


def by_report(executions: DataFrame, report_name: str) -> DataFrame:
    return executions.where(F.col("report_name") == report_name)


def get_execution(executions: DataFrame, execution_id: str) -> DataFrame:
    return executions.where(F.col("id") == execution_id)


def logs_of(logs: DataFrame, runs: DataFrame) -> DataFrame:
    """Log lines of the given runs (semi-join on the run id)."""
    return logs.join(runs.select(F.col("id").alias("execution_id")), "execution_id", "left_semi")


def purge(executions: DataFrame, logs: DataFrame, cutoff: dt.datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop runs created before ``cutoff`` and their logs.

    Returns (kept runs, kept logs, one-row count of removed runs). The caller
    writes the kept tables (overwrite) — nothing is deleted in place.
    """
    old = F.col("created_at") < literal_like(executions, "created_at", cutoff)
    kept = executions.where(~F.coalesce(old, F.lit(False)))
    removed = executions.where(old).select(F.col("id").alias("execution_id"))
    kept_logs = logs.join(removed, "execution_id", "left_anti")
    n = executions.agg(F.count_if(old).alias("removed_runs"))
    return kept, kept_logs, n


def durations(executions: DataFrame) -> DataFrame:
    """duration_seconds (NULL while open), is_finished, can_retry."""
    dur = seconds_between(F.col("started_at"), F.col("completed_at"))
    return executions.select(
        "id", "report_name", "status", dur.alias("duration_seconds"),
        F.col("status").isin(*FINISHED).alias("is_finished"),
        ((F.col("status") == "failed") & (F.col("retry_count") < F.col("max_retries"))).alias("can_retry"))


def step_rows(executions: DataFrame) -> DataFrame:
    """One row per step (runs without steps keep one row with NULL step), with duration."""
    s = executions.select("id", F.posexplode_outer("steps").alias("step_index", "step"))
    dur = seconds_between(F.col("step.started_at"), F.col("step.completed_at"))
    return s.select("id", "step_index", F.col("step.name").alias("step_name"),
                    F.col("step.status").alias("step_status"), dur.alias("step_seconds"))


def current_step(executions: DataFrame) -> DataFrame:
    """First running step of each run (NULL when none)."""
    running = F.filter("steps", lambda s: s["status"] == "running")
    return executions.select("id", F.try_element_at(running, F.lit(1))["name"].alias("current_step"))


_TS = ("created_at", "started_at", "completed_at")


def to_json(executions: DataFrame) -> DataFrame:
    """JSON form of each run record: timestamps as wall-clock text, NULL fields kept."""
    steps = F.transform("steps", lambda s: F.struct(
        s["name"].alias("name"), s["status"].alias("status"), wall_text(s["started_at"]).alias("started_at"),
        wall_text(s["completed_at"]).alias("completed_at"), s["error"].alias("error")))
    fields = [wall_text(F.col(c)).alias(c) if c in _TS else steps.alias(c) if c == "steps" else F.col(c)
              for c in executions.columns]
    return executions.select("id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))


def log_json(logs: DataFrame) -> DataFrame:
    """JSON form of each log line (timestamp as wall-clock text)."""
    return logs.select(F.to_json(F.struct(
        "execution_id", wall_text(F.col("timestamp")).alias("timestamp"), "level", "message", "step")).alias("json"))


def latest_status(events: DataFrame) -> DataFrame:
    """Latest status per run from the append-only event table: ``max_by`` (partial
    aggregation, so a run with a huge event count is combined map-side)."""
    return events.groupBy("run_id").agg(
        F.max_by("status", F.struct("ts", "seq")).alias("status"), F.max("ts").alias("updated_at"))
