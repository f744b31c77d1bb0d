"""One key, value or group holding a third of all rows: results stay whole and exact."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import cleaning as cl
from tessera.operators import transform as tr
from tessera.operators import windows as W

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    key = np.where(np.arange(N) % 3 == 0, 0, rng.integers(1, 200, N))        # key 0 holds a third
    val = np.round(rng.normal(50, 10, N), 0)
    val[np.arange(N) % 3 == 1] = 42.0                                         # value 42 holds a third
    pdf = pd.DataFrame({"id": np.arange(N), "k": key, "v": val})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_dedup_hot_key(skewed):
    pdf, df = skewed
    first = cl.remove_duplicates(df, "k", "first", order_by="id")
    want = pdf.sort_values("id").drop_duplicates("k", keep="first")
    assert sorted(r["id"] for r in first.collect()) == sorted(want["id"].tolist())
    last = cl.remove_duplicates(df, "k", "last", order_by="id")
    want_last = pdf.sort_values("id").drop_duplicates("k", keep="last")
    assert sorted(r["id"] for r in last.collect()) == sorted(want_last["id"].tolist())
    none = cl.remove_duplicates(df, "k", keep=False).count()
    assert none == len(pdf.drop_duplicates("k", keep=False))


def test_join_hot_key(spark, skewed):
    pdf, df = skewed
    dim = spark.createDataFrame([(0, "hot"), (1, "one")], "k long, name string")
    j = tr.join(df, dim, "k", "inner")
    assert j.count() == int((pdf["k"] <= 1).sum())


def test_grouped_cumsum_hot_group_two_pass(skewed):
    pdf, df = skewed
    got = {r["id"]: r["v_cumsum"] for r in W.cumulative_sum(df, "v", "id", "k", two_pass=True,
                                                              n_buckets=6).collect()}
    want = pdf.sort_values("id").groupby("k")["v"].cumsum()
    for i, w in zip(pdf.sort_values("id")["id"], want):
        assert got[int(i)] == pytest.approx(w)


def test_rank_hot_value_two_pass(skewed):
    pdf, df = skewed
    got = {r["id"]: r["v_rank"] for r in W.rank(df, "v", False, "average", two_pass=True, n_buckets=5).collect()}
    want = pdf["v"].rank(method="average", ascending=False)
    for i, w in zip(pdf["id"], want):
        assert got[int(i)] == pytest.approx(w)


def test_hot_value_median(skewed):
    pdf, df = skewed
    got = {r["k"]: r["v"] for r in tr.aggregate(df.withColumn("g", F.lit(1)), "g", {"v": "median"})
           .withColumnRenamed("g", "k").collect()}
    assert got[1] == pytest.approx(pdf["v"].median())
