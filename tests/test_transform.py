import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import transform as tr
from tessera.plans.steps import apply_transformations


def test_filters(employees, nulls):
    assert tr.filter_rows(employees, "department", "eq", "Sales").count() == 2
    assert tr.filter_rows(employees, "salary", "gte", 60000).count() == 2
    assert tr.filter_rows(employees, "salary", "nope", 1).count() == 5          # unknown → unchanged
    assert tr.filter_rows(nulls, "name", "ne", "Alice").count() == 4            # != keeps NULL (N6)
    assert tr.filter_rows(nulls, "category", "in", ["A", None]).count() == 3    # None matches NULL (N7)
    assert tr.filter_rows(nulls, "name", "contains", "^[AC]").count() == 2      # regex, NULL → False (N8)
    assert tr.filter_all(employees, {"department": "IT", "active": True}).count() == 2


def test_sort(employees, nulls):
    s = [r["salary"] for r in tr.sort(employees, "salary", ascending=False).collect()]
    assert s[0] == 65000 and s[-1] == 45000
    asc = [r["value"] for r in tr.sort(nulls, "value").collect()]
    desc = [r["value"] for r in tr.sort(nulls, "value", ascending=False).collect()]
    assert asc[-1] is None and desc[-1] is None                                 # NULLs last (N9)


def test_aggregate(sales):
    by_cat = {r["category"]: r for r in tr.aggregate(sales, "category", {"total_amount": "sum"}).collect()}
    assert by_cat["Electronics"]["total_amount"] == 16000 and by_cat["Clothing"]["total_amount"] == 2500
    by_prod = {r["product"]: r for r in tr.aggregate(sales, "product", {"total_amount": "sum",
                                                                         "quantity": ["sum", "mean"]}).collect()}
    assert (by_prod["A"]["total_amount"], by_prod["B"]["total_amount"], by_prod["C"]["total_amount"]) == \
        (10000, 2500, 6000)
    assert (by_prod["A"]["quantity_sum"], by_prod["C"]["quantity_mean"]) == (100, 8.0)
    last = tr.aggregate(sales, "category", {"product": "last"}, order_by="date")
    assert {r["category"]: r["product"] for r in last.collect()} == {"Electronics": "C", "Clothing": "B"}


def test_aggregate_null_keys_and_empty_sum(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None)], "k string, v double")
    out = tr.aggregate(df, "k", {"v": "sum"}).collect()
    assert len(out) == 1 and out[0]["v"] == 0                                 # N1, N2


def test_pivot(sales):
    p = {r["category"]: r for r in tr.pivot(sales, "category", "product", "total_amount").collect()}
    assert p["Electronics"]["A"] == 10000 and p["Electronics"]["C"] == 6000 and p["Electronics"]["B"] is None
    assert p["Clothing"]["B"] == 2500 and p["Clothing"]["A"] is None


def test_melt(spark):
    df = spark.createDataFrame([(1, 2, 3.5)], "id long, a long, b double")
    rows = {r["variable"]: r["value"] for r in tr.melt(df, "id").collect()}
    assert rows == {"a": 2.0, "b": 3.5}
    mixed = spark.createDataFrame([(1, 2, "x")], "id long, a long, s string")
    assert {r["value"] for r in tr.melt(mixed, ["id"]).collect()} == {"2", "x"}   # N24


def test_join_null_keys_and_suffixes(spark):
    left = spark.createDataFrame([(None, "l0"), (1, "l1")], "k long, v string")
    right = spark.createDataFrame([(None, "r0"), (2, "r2")], "k long, v string")
    inner = tr.join(left, right, "k", "inner").collect()
    assert len(inner) == 1 and inner[0]["v_x"] == "l0" and inner[0]["v_y"] == "r0"      # N4, N5
    outer = tr.join(left, right, "k", "outer")
    assert sorted((r["k"] is None, r["k"]) for r in outer.collect()) == [(False, 1), (False, 2), (True, None)]


def test_calculate_and_add(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "profit double, revenue double")
    out = [r["m"] for r in tr.calculate_column(df, "m", "(profit / revenue) * 100").collect()]
    assert out == [None, 250.0]                                                # N18: NULL, not inf
    row_fn = tr.add_column(df, "s", formula=lambda r: r["profit"] + r["revenue"]).collect()
    assert [r["s"] for r in row_fn] == [10.0, 14.0]
    assert tr.add_column(df, "c", "x").first()["c"] == "x"
    cmp = tr.calculate_column(df, "big", "revenue > 1 and not profit < 5").collect()
    assert [r["big"] for r in cmp] == [False, True]


def test_apply_function(employees):
    out = tr.apply_function(employees, "name", lambda s: s[::-1], "rev", "string")
    assert out.where("id = 1").first()["rev"] == "ecilA"


def test_resample(sales):
    m = tr.resample_time(sales, "date", "M").collect()
    assert len(m) == 1 and m[0]["date"] == dt.datetime(2024, 1, 31) and m[0]["total_amount"] == 18500
    w = tr.resample_time(sales, "date", "W").orderBy("date").collect()
    assert w[0]["date"] == dt.datetime(2024, 1, 7)                             # weeks end on Sunday
    gap = sales.where(F.dayofmonth("date").isin(1, 5))
    d = tr.resample_time(gap, "date", "D").orderBy("date").collect()
    assert len(d) == 5 and d[1]["total_amount"] == 0                           # empty bins present, sum → 0
    dm = tr.resample_time(gap, "date", "D", "mean").orderBy("date").collect()
    assert dm[1]["total_amount"] is None                                       # mean of an empty bin → NULL
    q = tr.resample_time(sales, "date", "Q").first()
    assert q["date"] == dt.datetime(2024, 3, 31)


def test_steps(sales):
    steps = [{"type": "aggregate", "groupby": ["category"], "metrics": {"total_amount": "sum"}},
             {"type": "calculate", "name": "k", "expression": "total_amount / 1000"},
             {"type": "filter", "column": "k", "condition": "gt", "value": 3},
             {"type": "sort", "by": "total_amount", "ascending": False}]
    out = apply_transformations(sales, steps).collect()
    assert [(r["category"], r["k"]) for r in out] == [("Electronics", 16.0)]
    with pytest.raises(ValueError):
        apply_transformations(sales, [{"type": "mystery"}])


def test_grouped_median_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(5)
    g = np.where(rng.random(3000) < 0.6, "hot", rng.choice(["a", "b", "c"], 3000))
    v = np.round(rng.normal(10, 3, 3000), 1)
    v[::17] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame([(a, None if np.isnan(b) else float(b)) for a, b in zip(g, v)], "g string, v double")
    ours = {r["g"]: r["v"] for r in tr.aggregate(df, "g", {"v": "median"}).collect()}
    theirs = pdf.groupby("g")["v"].median().to_dict()
    assert ours == pytest.approx(theirs)
    multi = tr.aggregate(df, "g", {"v": ["median", "count"]}).columns
    assert multi == ["g", "v_median", "v_count"]
    cells = {r["g"]: r for r in tr.pivot(df.withColumn("k", F.lit("x")), "g", "k", "v", "median").collect()}
    assert cells["hot"]["x"] == pytest.approx(theirs["hot"])


def test_expressions_like_pandas_eval(spark):
    df = spark.createDataFrame([(1, -7, 3), (2, 7, -3), (3, 7, 0), (4, None, 3), (5, 6, 3)], "i int, a int, b int")
    out = {r["i"]: r for r in df.select("i", *[tr.expressions.to_column(e).alias(n) for n, e in (
        ("m", "a % b"), ("ne", "a != 6"), ("both", "(a > 0) & (b > 0)"), ("any", "(a > 0) | (b > 0)"))]).collect()}
    assert [out[i]["m"] for i in range(1, 6)] == [2, -2, None, None, 0]
    assert [out[i]["ne"] for i in range(1, 6)] == [True, True, True, True, False]
    assert [out[i]["both"] for i in range(1, 6)] == [False, False, False, False, True]
    assert [out[i]["any"] for i in range(1, 6)] == [True, True, True, True, True]


def test_more_aggregate_names_match_pandas(spark):
    import pandas as pd
    rows = [("a", 1.0, True), ("a", 2.0, False), ("a", 2.0, True), ("a", 9.0, None), ("a", None, True), ("b", 3.0, None), ("b", 3.0, None),
            ("b", 3.0, None), ("c", None, None), ("d", 0.0, False), ("d", 4.0, False)]
    df = spark.createDataFrame(rows, "k string, x double, t boolean")
    names = ["prod", "sem", "skew", "q25", "mode", "any", "all"]
    got = {r.k: r for r in tr.aggregate(df, "k", {"x": names, "t": ["any", "all"]}).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "x", "t"])
    for k, x in pdf.groupby("k").x:
        v = x.dropna()
        want = [v.prod(), v.sem(), v.skew(), v.quantile(0.25), v.mode().min(), bool((v != 0).any()), bool((v != 0).all())]
        assert [got[k][f"x_{n}"] for n in names] == [None if w != w else pytest.approx(w) for w in want], k
    assert [(got[k].t_any, got[k].t_all) for k in "abd"] == [(True, False), (False, True), (False, False)]


def test_first_and_last_need_an_order(spark):
    rows = [("a", "p", 2, 5.0), ("a", "p", 1, None), ("a", "q", 1, 7.0), ("a", "q", None, 8.0), ("b", "p", 1, 1.0)]
    df = spark.createDataFrame(rows, "i string, c string, o long, v double")
    with pytest.raises(ValueError, match="order_by"):
        tr.pivot(df, "i", "c", "v", "first", column_values=["p", "q"])
    for func, want in (("first", [("a", 5.0, 7.0), ("b", 1.0, None)]), ("last", [("a", 5.0, 8.0), ("b", 1.0, None)])):
        assert sorted(map(tuple, tr.pivot(df, "i", "c", "v", func, column_values=["p", "q"], order_by=["o"]).collect())) == want
