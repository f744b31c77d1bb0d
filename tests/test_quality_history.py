import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import history as hi
from tessera.operators import periods as pe
from tessera.operators import quality as dq
from tessera.plans.fixtures import execution_logs, executions, status_events
from tests.conftest import SF


def test_rules(spark):
    df = spark.createDataFrame([("a.b@x.org", "2024-1-5", 5, "ok"), ("bad@", "2024-01-05", 50, "no"),
                                (None, "nope", None, None)], "e string, d string, n long, c string")
    rules = [dq.email("e"), dq.date("d"), dq.numeric_range("n", 0, 10), dq.choice("c", ["ok"]), dq.not_null("e"),
             dq.length("c", 2, 2)]
    rep = {r["rule"]: (r["checked"], r["failed"]) for r in dq.quality_report(df, rules).collect()}
    assert rep["e_email"] == (2, 1) and rep["d_date"] == (3, 1) and rep["n_range"] == (2, 1)
    assert rep["c_choice"] == (2, 1) and rep["e_not_null"] == (3, 1)
    good, bad = dq.split(df, rules)
    assert good.count() == 1 and bad.count() == 2
    t = dq.validate_table(df, ["e", "zz"], min_rows=1).first()
    assert t["missing_columns"] == ["zz"] and t["row_count"] == 3 and t["ok"] is False


def test_history_tables(spark):
    runs = executions(spark, SF)
    logs = execution_logs(spark, SF)
    kept, kept_logs, n = hi.purge(runs, logs, dt.datetime(1998, 1, 1))
    removed = n.first()["removed_runs"]
    assert kept.count() + removed == runs.count()
    old_ids = runs.where(F.col("created_at") < F.lit(dt.datetime(1998, 1, 1))).select("id")
    assert kept_logs.join(old_ids.withColumnRenamed("id", "execution_id"), "execution_id").count() == 0
    d = hi.durations(runs).where("status = 'running'").select("duration_seconds").distinct().collect()
    assert d == [(None,)] or all(r[0] is None for r in d)
    latest = hi.latest_status(status_events(spark, SF))
    joined = latest.join(runs.select(F.col("id").alias("run_id"), F.col("status").alias("s")), "run_id")
    assert joined.where(F.col("status") != F.col("s")).count() == 0
    assert hi.recent(runs, 3).count() == 3
    assert hi.current_step(runs).where("current_step is not null").count() == runs.where("status='running'").count()


@pytest.mark.parametrize("period,start,end", [
    ("today", "2024-01-17", "2024-01-18"), ("yesterday", "2024-01-16", "2024-01-17"),
    ("this_week", "2024-01-15", "2024-01-22"), ("last_week", "2024-01-08", "2024-01-15"),
    ("this_month", "2024-01-01", "2024-02-01"), ("last_month", "2023-12-01", "2024-01-01"),
    ("this_quarter", "2024-01-01", "2024-04-01"), ("this_year", "2024-01-01", "2025-01-01")])
def test_periods(period, start, end):
    s, e = pe.date_range(period, dt.date(2024, 1, 17))
    assert (s, e) == (dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end))


def test_unknown_period():
    with pytest.raises(ValueError):
        pe.date_range("someday", dt.date(2024, 1, 1))
