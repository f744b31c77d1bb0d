import pytest
from pyspark.sql import functions as F

from tessera.operators import kpi as K
from tessera.operators import transform as tr


def test_agent_aggregates(kpi_frame):
    calls = {r["agent_id"]: r["calls_handled"] for r in tr.aggregate(kpi_frame, "agent_id",
                                                                     {"calls_handled": "sum"}).collect()}
    assert calls == {1: 158, 2: 93, 3: 122}
    sat = {r["agent_id"]: r["customer_satisfaction"] for r in tr.aggregate(
        kpi_frame, "agent_id", {"customer_satisfaction": "mean"}).collect()}
    assert sat[1] == pytest.approx(4.5) and sat[2] == pytest.approx(4.25) and sat[3] == pytest.approx(4.75)


def test_fused_kpis(kpi_frame):
    kpis = [K.customer_satisfaction_score("customer_satisfaction"), K.total_revenue("sales_amount"),
            K.average_handling_time("avg_handling_time"), K.productivity_rate("sales_amount", "calls_handled")]
    row = K.kpi_frame(kpi_frame, kpis).first()
    assert row["customer_satisfaction_score"] == pytest.approx(90.0)
    assert row["total_revenue"] == 36800
    summary = K.kpi_summary(kpi_frame, kpis).collect()
    assert {r["category"] for r in summary} == {"customer", "sales", "performance"}


def test_growth_rate_not_recorded_when_previous_zero(kpi_frame):
    k = K.growth_rate(F.lit(1000.0), F.lit(800.0))
    assert K.kpi_frame(kpi_frame, [k]).first()["growth_rate"] == pytest.approx(25.0)
    z = K.growth_rate(F.lit(1000.0), F.lit(0.0))
    assert K.kpi_frame(kpi_frame, [z]).first()["growth_rate"] == 0
    assert K.kpi_summary(kpi_frame, [z]).count() == 0


def test_rates_and_nps(spark):
    df = spark.createDataFrame([(10, True), (9, False), (6, True), (None, None), (7, True)], "s long, f boolean")
    r = K.kpi_frame(df, [K.net_promoter_score("s"), K.churn_rate("f"), K.first_call_resolution("f")]).first()
    assert r["net_promoter_score"] == pytest.approx((2 - 1) / 5 * 100)       # NULL only in the denominator
    assert r["churn_rate"] == pytest.approx(60.0)
    empty = df.where("false")
    assert K.kpi_frame(empty, [K.churn_rate("f")]).first()["churn_rate"] == 0


def test_training_hours_and_aov(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0), (2, None, 5.0)], "o long, e string, h double")
    r = K.kpi_frame(df, [K.training_hours_per_employee("h", "e")]).first()
    assert r["training_hours_per_employee"] == pytest.approx(5.0)
    assert K.average_order_value_by_order(df, "h", "o").first()[0] == pytest.approx(5.0)


def test_compare(kpi_frame):
    cur = kpi_frame.where("agent_id = 1")
    prev = kpi_frame.where("agent_id = 2")
    out = {r["kpi_name"]: r for r in K.compare_kpis(cur, prev, [K.total_revenue("sales_amount")]).collect()}
    r = out["total_revenue"]
    assert (r["current"], r["previous"], r["trend"]) == (15300, 9300, "up")
    assert r["change_percentage"] == pytest.approx(6000 / 9300 * 100)


def test_formats(spark):
    df = spark.createDataFrame([(30.0,), (1527.0,), (7200.0,)], "s double")
    out = [r["d"] for r in df.select(K.format_duration(F.col("s")).alias("d")).collect()]
    assert out == ["30.0s", "25.4m", "2.0h"]                       # rounds like Python's format
    v = df.select(K.format_value(F.lit(1234567.891), "currency").alias("c"),
                  K.format_value(F.lit(12.345), "percentage").alias("p")).first()
    assert v["c"] == "$1,234,567.89" and v["p"] == "12.3%"
