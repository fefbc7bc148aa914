"""Summaries and column profile."""

from pyspark.sql import functions as F

from lotwise.operators.profile import column_profile, column_samples
from lotwise.operators.summaries import (
    count_by_year_wide,
    histogram,
    units_by,
    with_densities,
)


def test_units_by(spark):
    df = spark.createDataFrame(
        [("a", 1965.0, None), ("a", 1965.0, None), ("a", 1966.0, 2), ("a", 1966.0, 3),
         ("a", 1964.0, 9), (None, 1970.0, 1), ("b", None, 1)],
        "COUNTY string, YRBUILT double, UNITS int",
    )
    got = units_by(df, ["COUNTY", "YRBUILT"], 1965).collect()
    assert sorted(map(tuple, got)) == [("a", 1965.0, 0), ("a", 1966.0, 5)]


def test_pivot_with_and_without_years(spark):
    df = spark.createDataFrame(
        [("a", 2010.0, 1), ("a", 2010.0, None), ("b", 2012.0, 1), ("b", 2009.0, 1)],
        "COUNTY string, YRBUILT double, geometry int",
    )
    got = count_by_year_wide(df, "COUNTY", 2010)
    assert got.columns == ["COUNTY", "2010", "2012"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, None), ("b", None, 1)]
    wide = count_by_year_wide(df, "COUNTY", 2010, [2010, 2011])
    assert wide.columns == ["COUNTY", "2010", "2011"]


def test_densities(spark):
    df = spark.createDataFrame(
        [(4, 2.0, "10"), (4, 0.0, "junk"), (None, 1.0, None)],
        "UNITS int, CALCACRES double, APPRTOT string",
    )
    got = with_densities(df).select("UNITS_PER_ACRE", "VALPERACRE").collect()
    assert [tuple(r) for r in got] == [(2.0, 5.0), (None, None), (None, None)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 10)] + [(None,)], "v double")
    got = {r["bin"]: (r["bin_start"], r["n"]) for r in histogram(df, "v", 5).collect()}
    assert got == {0: (0.0, 2), 1: (2.0, 2), 4: (8.0, 1)}
    flat = histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 5).collect()
    assert [tuple(r) for r in flat] == [(0, 3.0, 2)]


def test_profile(spark):
    df = spark.createDataFrame(
        [(0, "0", " ", 1.5), (0, "x", None, None), (2, "y", None, 0.0), (3, "z", "q", -0.0)],
        "n int, t string, b string, d double",
    )
    got = {r["column_name"]: r for r in column_profile(df).collect()}
    assert {c: r["unique_values"] for c, r in got.items()} == {"n": 3, "t": 4, "b": 3, "d": 3}
    assert got["n"]["is_zero_int"] == "2 (50%)" and got["n"]["is_zero_chr"] == ""
    assert got["t"]["is_zero_chr"] == "1 (25%)" and got["t"]["is_zero_int"] == ""
    assert got["b"]["is_empty"] == "1 (25%)" and got["b"]["is_null"] == "2 (50%)"
    assert got["d"]["is_zero_int"] == "2 (50%)"
    assert sorted(got["b"]["column_sample"].split("; ")) == [" ", "None", "q"]


def test_profile_shuffles_the_values_once(spark):
    df = column_profile(spark.range(100).select("id", (F.col("id") % 7).alias("b")))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_samples_are_ten_distinct_values(spark):
    df = spark.range(5000).select((F.col("id") % 700).cast("string").alias("a"), F.lit(1).alias("b"))
    got = {r["column_name"]: r["column_sample"].split("; ") for r in column_samples(df).collect()}
    assert len(set(got["a"])) == 10 and got["b"] == ["1"]
    again = column_samples(df.repartition(7)).collect()
    assert {r["column_name"]: r["column_sample"].split("; ") for r in again} == got
    plan = column_samples(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
