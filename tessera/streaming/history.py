"""Run status and daily KPI trend maintained incrementally from landed files.

The run-history event table is append-only (one row per state change), so its
latest-status view is a streaming aggregate: ``max_by(status, (ts, seq))`` per
run, kept in the state store and emitted in update mode. The daily trend of
the weekly report is a tumbling one-day window over the performance events,
with a watermark so finished days are emitted once and their state dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STATUS_EVENT_SCHEMA = "run_id string, ts timestamp, status string, seq int"


def status_event_stream(spark: SparkSession, path: str, schema: StructType | str = STATUS_EVENT_SCHEMA,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def latest_status(events: DataFrame) -> DataFrame:
    """Same logic as operators.history.latest_status, valid on a streaming frame."""
    return events.groupBy("run_id").agg(F.max_by("status", F.struct("ts", "seq")).alias("status"),
                                        F.max("ts").alias("updated_at"))


def daily_trend(performance: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Calls and sales per day and team; rows for a day are final once the
    watermark passes the day's end."""
    return (performance.withWatermark("date", watermark)
            .groupBy(F.window("date", "1 day").alias("day"), "team")
            .agg(F.count(F.lit(1)).alias("calls_handled"), F.sum("sales_amount").alias("sales_amount"))
            .select(F.col("day.start").alias("day"), "team", "calls_handled", "sales_amount"))


def start_to_folder(df: DataFrame, folder: str, checkpoint: str, mode: str = "update",
                    available_now: bool = True):
    """Run a streaming aggregate in update mode into a Parquet folder: each
    micro-batch appends its changed rows tagged with ``batch_id`` (idempotent:
    a replayed batch overwrites its own partition). ``read_latest`` gives the
    current value per key. Without a table format that supports MERGE, this
    is the append-only form of an upsert."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(folder))

    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """Latest row per key across the appended micro-batches (``max_by`` on batch_id,
    partial aggregation, so a key updated in every batch is combined map-side)."""
    rows = spark.read.parquet(folder)
    others = [c for c in rows.columns if c not in keys and c != "batch_id"]
    g = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("batch_id")).alias("__r"))
    return g.select(*keys, *[F.col("__r")[c].alias(c) for c in others])
