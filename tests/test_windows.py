"""Two-pass window forms against the plain window, and against pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import windows as W
from tessera.plans.fixtures import orders_nulls
from tests.conftest import SF

ORDER = ["o_orderdate", "o_orderkey"]


def same(a, b, key, col):
    x = a.select(key, F.col(col).alias("a")).join(b.select(key, F.col(col).alias("b")), key, "full")
    near = F.coalesce(F.abs(F.col("a") - F.col("b")) <= 1e-6 * F.abs(F.col("b")), F.lit(False))
    bad = x.where(~(F.col("a").eqNullSafe(F.col("b")) | near))
    return bad.count() == 0 and x.count() == a.count() == b.count()


@pytest.fixture(scope="module")
def orders(spark):
    return orders_nulls(spark, SF).cache()


def test_cumsum_two_pass(orders):
    for pb in (None, "o_orderpriority"):
        a = W.cumulative_sum(orders, "o_totalprice", ORDER, pb, n_buckets=5, two_pass=True)
        b = W.cumulative_sum(orders, "o_totalprice", ORDER, pb, two_pass=False)
        assert same(a, b, "o_orderkey", "o_totalprice_cumsum")


@pytest.mark.parametrize("method", ["dense", "min", "max", "average", "first"])
@pytest.mark.parametrize("ascending", [True, False])
def test_rank_two_pass(orders, method, ascending):
    o = orders.withColumn("p", F.round(F.col("o_totalprice") / 20000))
    a = W.rank(o, "p", ascending, method, order_by=["o_orderkey"], n_buckets=4, two_pass=True)
    b = W.rank(o, "p", ascending, method, order_by=["o_orderkey"], two_pass=False)
    assert same(a, b, "o_orderkey", "p_rank")


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_fill_two_pass(orders, direction):
    cols = ["o_totalprice", "o_orderpriority"]
    a = W.fill_forward_backward(orders, cols, ORDER, direction=direction, n_buckets=6, two_pass=True)
    b = W.fill_forward_backward(orders, cols, ORDER, direction=direction, two_pass=False)
    assert same(a, b, "o_orderkey", "o_totalprice")
    a2, b2 = (x.withColumn("h", F.hash("o_orderpriority")) for x in (a, b))
    assert same(a2, b2, "o_orderkey", "h")


@pytest.mark.parametrize("func", ["mean", "sum", "min", "max", "std"])
def test_rolling_of_wide_windows(orders, func):
    """Windows of several stretches and of none, groups shorter than a window, nulls."""
    col = f"o_totalprice_rolling_{func}"
    for window, rows, group in ((1, 10, None), (2, 5, "o_orderpriority"), (64, 10, "o_orderpriority"), (300, 700, None), (10 ** 6, 50, None)):
        part = orders.where("o_orderkey % 3 > 0 OR o_totalprice IS NOT NULL")
        a = W.rolling(part, "o_totalprice", window, func, ORDER, group, n_buckets=4, block_rows=rows)
        b = W.rolling(part, "o_totalprice", window, func, ORDER, group, two_pass=False)
        assert same(a, b, "o_orderkey", col)


@pytest.mark.parametrize("func", ["mean", "sum", "min", "max", "std"])
def test_rolling_two_pass(orders, func):
    a = W.rolling(orders, "o_totalprice", 5, func, ORDER, n_buckets=4, block_rows=37, two_pass=True)
    b = W.rolling(orders, "o_totalprice", 5, func, ORDER, two_pass=False)
    assert same(a, b, "o_orderkey", f"o_totalprice_rolling_{func}")


def test_row_number_grouped(orders):
    a = W.row_number(orders, ORDER, "o_orderstatus", n_buckets=5, two_pass=True)
    b = W.row_number(orders, ORDER, "o_orderstatus", two_pass=False)
    assert same(a, b, "o_orderkey", "row_number")


def test_hot_group_is_split(spark, orders):
    """A group holding most rows spreads over several buckets."""
    o = orders.withColumn("g", F.when(F.col("o_orderkey") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")))
    b = W.with_range_bucket(o, ["g", *ORDER], 8)
    per = {r["__bucket"]: r["count"] for r in b.where(F.col("g") == "hot").groupBy("__bucket").count().collect()}
    assert len(per) >= 5


def test_explain_has_no_single_partition_scan_exchange(orders):
    plan = W.cumulative_sum(orders, "o_totalprice", ORDER, n_buckets=4, two_pass=True)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "hashpartitioning(__bucket" in text


values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_rank_matches_pandas(spark, vals):
    pdf = pd.DataFrame({"i": range(len(vals)), "v": pd.Series(vals, dtype="float64")})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    for method in ("dense", "min", "max", "average", "first"):
        ours = {r["i"]: r["v_rank"] for r in W.rank(df, "v", False, method, order_by=["i"], n_buckets=3, two_pass=True).collect()}
        theirs = pdf["v"].rank(method=method, ascending=False)
        for i, t in zip(pdf["i"], theirs):
            o = ours[int(i)]
            assert (o is None and math.isnan(t)) or o == pytest.approx(t)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_cumsum_and_rolling_match_pandas(spark, vals):
    pdf = pd.DataFrame({"i": range(len(vals)), "v": pd.Series(vals, dtype="float64")})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    cs = {r["i"]: r["v_cumsum"] for r in W.cumulative_sum(df, "v", "i", n_buckets=3, two_pass=True).collect()}
    for i, t in zip(pdf["i"], pdf["v"].cumsum()):
        assert (cs[int(i)] is None and math.isnan(t)) or cs[int(i)] == pytest.approx(t)
    rm = {r["i"]: r["v_rolling_mean"] for r in W.rolling(df, "v", 3, "mean", "i", n_buckets=3,
                                                          block_rows=4, two_pass=True).collect()}
    for i, t in zip(pdf["i"], pdf["v"].rolling(3).mean()):
        assert (rm[int(i)] is None and math.isnan(t)) or rm[int(i)] == pytest.approx(t)
    ff = {r["i"]: r["v"] for r in W.fill_forward_backward(df, ["v"], "i", n_buckets=3, two_pass=True).collect()}
    for i, t in zip(pdf["i"], pdf["v"].ffill()):
        assert (ff[int(i)] is None and np.isnan(t)) or ff[int(i)] == t


def test_grouped_and_backward_match_plain(orders):
    """Groups that go on over several buckets, backward carries and ties."""
    a =W.cumulative_sum(orders, "o_totalprice", ORDER, "o_orderpriority", n_buckets=6, two_pass=True)
    b = W.cumulative_sum(orders, "o_totalprice", ORDER, "o_orderpriority", two_pass=False)
    assert same(a, b, "o_orderkey", "o_totalprice_cumsum")
    c = W.fill_forward_backward(orders, ["o_totalprice"], ORDER, direction="backward", n_buckets=5, two_pass=True)
    d = W.fill_forward_backward(orders, ["o_totalprice"], ORDER, direction="backward", two_pass=False)
    assert same(c, d, "o_orderkey", "o_totalprice")
    o = orders.withColumn("p", F.round(F.col("o_totalprice") / 20000))
    e = W.rank(o, "p", False, "min", n_buckets=5, two_pass=True)
    f = W.rank(o, "p", False, "min", two_pass=False)
    assert same(e, f, "o_orderkey", "p_rank")


def test_null_groups_and_order_keys(spark):
    """NULL groups form one window and NULL order keys come last, in the plain and the two-pass form."""
    rows = [(i, None if i % 4 == 0 else i % 3, None if i % 5 == 0 else i * 7 % 11, float(i)) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "id long, g long, o long, v double")
    for pb in (None, "g"):
        for two in (False, True):
            kw = dict(order_by=["o", "id"], partition_by=pb, two_pass=two)
            got = {r["id"]: (r["row_number"], r["v_cumsum"]) for r in
                   W.cumulative_sum(W.row_number(df, **kw), "v", **kw).collect()}
            want, n, total = {}, {}, {}
            for i, g, o, v in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
                k = g if pb else 0
                n[k], total[k] = n.get(k, 0) + 1, total.get(k, 0) + v
                want[i] = (n[k], None if pb and g is None else total[k])
            assert got == want


@pytest.mark.parametrize("two_pass", [True, False])
def test_backward_fill_reads_no_frame_to_the_end(spark, two_pass):
    """Frames up to the partition's end are evaluated anew for every row; values as pandas has them, NULL order keys last."""
    rows = [(g, None if i == 29 else i, None if i % 3 else float(i), None if i % 5 else str(i))
            for g in (None, "a", "b") for i in range(30)]
    df = spark.createDataFrame(rows, "g string, i long, v double, s string")
    out = W.fill_forward_backward(df, ["v", "s"], "i", "g", "backward", two_pass=two_pass, n_buckets=4)
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    want = pd.DataFrame(rows, columns=["g", "i", "v", "s"])
    want[["v", "s"]] = want.groupby("g", dropna=False)[["v", "s"]].bfill()
    norm = lambda r: tuple(None if pd.isna(x) else x for x in r)
    key = lambda r: tuple((x is None, x or 0) for x in r[1:2]) + (r[0] or "",)
    assert sorted(map(norm, out.select("g", "i", "v", "s").collect()), key=key) == \
        sorted(map(norm, want.itertuples(index=False)), key=key)
