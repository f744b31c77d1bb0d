from pyspark.sql import functions as F

from tessera.operators import cleaning as cl


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_dedup_keep_first_last_none(duplicates):
    assert ids(cl.remove_duplicates(duplicates)) == [1, 2, 3]
    assert ids(cl.remove_duplicates(duplicates, "name", "first", order_by="id")) == [1, 2, 3]
    assert ids(cl.remove_duplicates(duplicates, ["name"], "last", order_by="id")) == [1, 2, 3]
    assert ids(cl.remove_duplicates(duplicates, keep=False)) == [1]
    assert ids(cl.remove_duplicates(duplicates, ["name"], keep=False)) == [1]


def test_dedup_first_uses_order(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (1, "c", 2)], "k long, v string, o long")
    assert cl.remove_duplicates(df, "k", "first", order_by="o").first()["v"] == "b"
    assert cl.remove_duplicates(df, "k", "last", order_by="o").first()["v"] == "a"


def test_drop_nulls(nulls):
    # the fixture has exactly one complete row (id 1)
    assert ids(cl.remove_nulls(nulls)) == [1]
    assert ids(cl.remove_nulls(nulls, how="all")) == [1, 2, 3, 4, 5]
    assert ids(cl.remove_nulls(nulls, subset=["value"])) == [1, 2, 4, 5]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id long, v double")
    assert ids(cl.remove_nulls(df)) == [2]


def test_fill_statistics(nulls):
    mean = cl.fill_nulls(nulls, method="mean").where("id = 3").first()
    assert mean["value"] == 300.0
    median = cl.fill_nulls(nulls, method="median", columns=["value"]).where("id = 3").first()
    assert median["value"] == 300.0
    mode = {r["id"]: r for r in cl.fill_nulls(nulls, method="mode", columns=["name", "category"]).collect()}
    assert mode[2]["name"] == "Alice" and mode[4]["category"] == "A"
    filled = cl.fill_nulls(nulls, value="Unknown")
    assert filled.where(F.col("name").isNull()).count() == 0
    assert filled.where(F.col("value").isNull()).count() == 1


def test_fill_mean_text_falls_through_to_value(nulls):
    out = cl.fill_nulls(nulls, value="Unknown", method="mean", columns=["value", "name"])
    assert out.where(F.col("name") == "Unknown").count() == 2 and out.where("value is null").count() == 0


def test_ffill_bfill(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "t long, v double")
    f = [r["v"] for r in cl.fill_nulls(df, method="ffill", columns=["v"], order_by="t").orderBy("t").collect()]
    b = [r["v"] for r in cl.fill_nulls(df, method="bfill", columns=["v"], order_by="t").orderBy("t").collect()]
    assert f == [None, 5.0, 5.0, 7.0, 7.0]
    assert b == [5.0, 5.0, 7.0, 7.0, None]


def test_convert_types(spark):
    df = spark.createDataFrame([(" 7 ",), ("1e3",), ("",), ("x",)], "s string")
    out = [r["s"] for r in cl.convert_types(df, {"s": "numeric"}).collect()]
    assert out == [7.0, 1000.0, None, None]
    kept = cl.convert_types(df, {"s": "numeric"}, on_error="keep")
    assert kept.schema["s"].dataType.simpleString() == "string"
    dates = spark.createDataFrame([("2024-01-05",), ("2024-02-30",)], "d string")
    parsed = cl.convert_types(dates, {"d": "datetime"}, formats={"d": "yyyy-MM-dd"}).collect()
    assert parsed[0]["d"].day == 5 and parsed[1]["d"] is None


def test_trim_and_case(spark):
    df = spark.createDataFrame([("\t o'neil foo-bar 3rd \n",)], "s string")
    t = cl.trim_strings(df).first()["s"]
    assert t == "o'neil foo-bar 3rd"
    title = cl.standardize_text(cl.trim_strings(df), "s", "title").first()["s"]
    assert title == "O'Neil Foo-Bar 3Rd"
    assert cl.standardize_text(df, "s", "nonsense").first()["s"] == df.first()["s"]


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    kept = sorted(r["x"] for r in cl.remove_outliers(df, "x", "iqr").collect())
    assert kept == [1.0, 2.0, 3.0, 4.0]
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert cl.remove_outliers(const, "x", "zscore").count() == 0     # std 0 drops everything
    z = cl.remove_outliers(df, "x", "zscore", threshold=1.0)
    assert sorted(r["x"] for r in z.collect()) == [1.0, 2.0, 3.0, 4.0]


def test_rename_drop(employees):
    out = cl.drop_columns(cl.rename_columns(employees, {"name": "full_name", "nope": "x"}), ["salary", "nope"])
    assert "full_name" in out.columns and "salary" not in out.columns


def test_cleaning_log(spark, duplicates):
    log = cl.CleaningLog(duplicates).apply("dedup", cl.remove_duplicates)
    log.df.write.format("noop").mode("overwrite").save()
    row = log.to_frame(spark).first()
    assert (row["rows_before"], row["rows_after"], row["rows_removed"]) == (5, 3, 2)
    log2 = cl.CleaningLog(duplicates).apply("drop", cl.drop_columns, ["value"])
    log2.df.write.format("noop").mode("overwrite").save()
    assert log2.to_frame(spark).first()["columns_after"] == 2


def test_dedup_keeps_rows_whose_order_key_is_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (2, None, "c")], "k long, o long, v string")
    for keep, two in (("first", "b"), ("last", "c")):
        got = cl.remove_duplicates(df, "k", keep=keep, order_by="o").collect()
        assert {(r["k"], r["v"]) for r in got} == {(1, "a"), (2, two)}
