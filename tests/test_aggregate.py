import datetime as dt

import numpy as np
import pytest

from tessera.functions import stats as st
from tessera.operators import aggregate as ag
from tessera.operators import charts as ch


def test_share(sales):
    p = {r["category"]: r["percentage"] for r in ag.calculate_percentages(sales, "total_amount", "category").collect()}
    assert p["Electronics"] == pytest.approx(86.48648648) and p["Clothing"] == pytest.approx(13.51351351)
    rows = ag.calculate_percentages(sales, "total_amount").collect()
    assert sum(r["percentage"] for r in rows) == pytest.approx(100.0)


def test_percentiles(kpi_frame):
    r = ag.percentiles(kpi_frame, "sales_amount").first()
    assert (r["p25"], r["p50"], r["p75"]) == (4900, 5100, 5600)


def test_exact_quantiles_match_numpy_with_narrowing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 50.0, 5000), 1)
    vals[:1500] = 42.0                                                       # a hot value: 30 % of the rows
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    expected = np.quantile(vals, qs)
    assert st.exact_quantiles(df, "x", qs) == pytest.approx(list(expected))
    monkeypatch.setattr(st, "SKETCH_K", 200)
    for error in (2.296 / 200 ** 0.9021, 0.0002):              # several passes; ranks outside their brackets
        monkeypatch.setattr(st, "RANK_ERROR", error)
        assert st.exact_quantiles(df, "x", [0.25, 0.5, 0.99]) == pytest.approx(list(np.quantile(vals, [0.25, 0.5, 0.99])))


def test_mode(nulls):
    assert st.mode_and_count(nulls, "category") == ("A", 2)


def test_describe(employees):
    d = {r["column"]: r for r in ag.summarize(employees).collect()}
    assert set(d) == {"id", "salary"}                                        # booleans excluded
    assert d["salary"]["q25"] == 50000 and d["salary"]["count"] == 5
    a = {r["column"]: r for r in ag.summarize(employees, numeric_only=False).collect()}
    assert a["department"]["unique"] == 3 and a["department"]["top"] == "IT" and a["department"]["freq"] == 2


def test_totals_topk_bottom(employees):
    t = {r["column"]: r["total"] for r in ag.calculate_totals(employees, ["salary", "name"]).collect()}
    assert t == {"salary": 275000}
    assert [r["name"] for r in ag.top_n(employees, "salary", 2).collect()] == ["Eve", "Bob"]
    assert [r["name"] for r in ag.bottom_n(employees, "salary", 1).collect()] == ["David"]


def test_compare_periods(sales):
    r = ag.compare_periods(sales, "date", "total_amount", dt.datetime(2024, 1, 16)).first()
    assert r["current"] + r["previous"] == 18500
    assert r["change"] == r["current"] - r["previous"]
    zero = ag.compare_periods(sales, "date", "total_amount", dt.datetime(2023, 1, 1)).first()
    assert zero["change_percentage"] == 0


def test_crosstab(sales):
    c = {r["category"]: r for r in ag.cross_tabulation(sales, "category", "product").collect()}
    assert c["Electronics"]["A"] == 10 and c["Electronics"]["B"] == 0          # absent cell = 0 (N20)
    v = {r["category"]: r for r in ag.cross_tabulation(sales, "category", "product", "quantity", "mean").collect()}
    assert v["Clothing"]["B"] == 5 and v["Clothing"]["A"] is None


def test_total_row_metrics_sheets(sales):
    t = ag.add_total_row(ag.group_by(sales, "region", {"total_amount": "sum"}), "region", ["total_amount"])
    total = t.where("is_total").first()
    assert total["region"] == "TOTAL" and total["total_amount"] == 18500
    m = {(r["metric"], r["key"]): r["value"] for r in ag.calculate_metrics(sales, "total_amount",
                                                                           ["region", "product"]).collect()}
    assert m[("total", None)] == 18500 and m[("by_product", "A")] == 10000 and m[("by_region", "South")] == 2500
    sheets = ag.split_sheets(ag.group_sheets(sales, "total_amount", ["region", "category"]), ["region", "category"])
    assert {r["category"]: r["value"] for r in sheets["category"].collect()} == {"Electronics": 16000,
                                                                                 "Clothing": 2500}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(0, 1, 2000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    h = [r["count"] for r in ch.histogram(df, "x", 20).orderBy("bin").collect()]
    assert h == list(np.histogram(vals, 20)[0])
    one = ch.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x").collect()
    assert len(one) == 1 and one[0]["count"] == 2


def test_pie_heatmap_series(sales):
    pie = {r["category"]: r["percentage"] for r in ch.pie_share(sales, "category", "total_amount").collect()}
    assert pie == {"Electronics": 86.5, "Clothing": 13.5}
    hm = {r["category"]: r for r in ch.heatmap(sales, "category", "product", "unit_price").collect()}
    assert hm["Electronics"]["C"] == 75.0
    s = ch.series(sales, "region", ["total_amount", "quantity"])
    assert s.count() == 6


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_medians_share_one_index(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    got = ag.group_by(li, ["l_returnflag"], {c: ["median", "sum"] for c in cols})
    assert _scans(got) == 1                        # the other half; the medians read their written index
    want = li.toPandas().astype({c: float for c in cols}).groupby("l_returnflag")[cols].median()
    for r in got.collect():
        assert [r[f"{c}_median"] for c in cols] == pytest.approx(want.loc[r.l_returnflag].tolist())
    rows = [("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0), (None, 9.0, 9.0), ("c", None, None)]
    odd = ag.group_by(spark.createDataFrame(rows, "k string, x double, y double"), "k", {"x": "median", "y": "median"})
    assert sorted(map(tuple, odd.collect())) == [("a", 2.0, None), ("b", None, 2.0), ("c", None, None)]


def test_metrics_roll_up_from_one_aggregate(spark):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), (None, "x", 4.0), ("b", None, None), ("a", "x", float("nan"))]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    got = ag.calculate_metrics(df, "v", ["k", "m"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert {(r.metric, r.key): r.value for r in got.collect()} == pytest.approx({
        ("total", None): 7.0, ("mean", None): 7 / 3, ("max", None): 4.0, ("min", None): 1.0, ("by_k", "a"): 3.0, ("by_k", "b"): 0.0,
        ("by_m", "x"): 5.0, ("by_m", "y"): 2.0})
    sheets = ag.group_sheets(df, "v", ["k", "m"])
    assert {tuple(r) for r in sheets.collect()} == {("k", "a", 3.0), ("k", "b", 0.0), ("m", "x", 5.0), ("m", "y", 2.0)}
    assert {tuple(r) for r in ag.calculate_metrics(df.limit(0), "v", ["k"]).collect()} == {
        ("total", None, 0.0), ("mean", None, None), ("max", None, None), ("min", None, None)}


def test_describe_of_strings_from_one_index(spark):
    df = spark.createDataFrame([("a", "z"), ("b", None), ("b", "y"), ("a", "z"), (None, "q")], "s string, t string")
    got = {r.column: (r["count"], r.unique, r.top, r.freq) for r in ag.summarize(df, numeric_only=False).collect()}
    assert got == {"s": (4.0, 2, "a", 2), "t": (4.0, 3, "z", 2)}
    none = ag.summarize(df.limit(0), numeric_only=False).collect()
    assert [(r["count"], r.unique, r.top, r.freq) for r in none] == [(0.0, 0, None, None)] * 2
