import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import history as hi
from tessera.plans.fixtures import status_events
from tessera.streaming import history as sh
from tests.conftest import SF


def test_streaming_latest_status_matches_batch(spark, tmp_dir):
    ev = status_events(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    src = f"{tmp_dir}/events"
    for seq in (0, 1, 2):                       # land the events in three batches
        ev.where(F.col("seq") == seq).write.mode("append").parquet(src)
    stream = sh.latest_status(sh.status_event_stream(spark, src, max_files_per_trigger=2))
    q = (stream.writeStream.outputMode("complete").format("memory").queryName("latest_status_t")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("latest_status_t")
    want = hi.latest_status(ev)
    assert got.count() == want.count()
    assert got.join(want, ["run_id", "status"]).count() == want.count()


def test_streaming_to_folder_latest(spark, tmp_dir):
    ev = status_events(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    src = f"{tmp_dir}/ev2"
    for seq in (0, 1, 2):
        ev.where(F.col("seq") == seq).write.mode("append").parquet(src)
    stream = sh.latest_status(sh.status_event_stream(spark, src, max_files_per_trigger=1))
    q = sh.start_to_folder(stream, f"{tmp_dir}/latest", f"{tmp_dir}/ckpt2")
    q.awaitTermination(300)
    got = sh.read_latest(spark, f"{tmp_dir}/latest", ["run_id"])
    want = hi.latest_status(ev)
    assert got.count() == want.count()
    assert got.join(want, ["run_id", "status"]).count() == want.count()


def test_daily_trend_stream(spark, tmp_dir):
    from tessera.sources import tables as tb
    perf = tb.performance(spark, SF).select(F.col("date").cast("timestamp").alias("date"), "team", "sales_amount")
    src = f"{tmp_dir}/perf"
    perf.write.parquet(src)
    stream = sh.daily_trend(spark.readStream.schema(perf.schema).parquet(src))
    q = (stream.writeStream.outputMode("append").format("memory").queryName("trend_t")
         .option("checkpointLocation", f"{tmp_dir}/ckpt3").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("trend_t")
    batch = perf.groupBy(F.date_trunc("day", "date").alias("day"), "team").count()
    # append mode emits a day once the watermark passes it: every emitted day is complete
    assert got.join(batch, ["day", "team"]).where(F.col("calls_handled") != F.col("count")).count() == 0


def test_entry_and_registry_consistent(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 150
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "bench.py"))


def test_queries_without_the_tokenizer_files():
    """Where the training-data operators cannot be imported, all other queries stay."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); "
            "print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True, text=True, timeout=120)
    n, training, same = out.stdout.split()[-3:]
    assert int(n) >= 178 and training == "False" and same == "True"


def test_existing_shuffle_partitions_stay_off_local_masters(spark):
    from tessera.session import get_spark

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert get_spark().conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
