"""Value functions: one table of cases per rule."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lotwise.functions import values as V


def mapped(spark, inputs, make, schema="v string"):
    df = spark.createDataFrame([(v,) for v in inputs], schema)
    rows = df.select("v", make("v").alias("out")).collect()
    return {r["v"]: r["out"] for r in rows}


def test_to_number_takes_what_a_number_parser_takes(spark):
    cases = {
        "1e3": 1000.0, " 12 ": 12.0, "+5": 5.0, ".5": 0.5, "inf": float("inf"), "7": 7.0,
        "": None, "1,000": None, "0x10": None, "1d": None, "1f": None, "2.5D ": None,
        "N/A": None, "nan": None, None: None,
    }
    assert mapped(spark, cases, V.to_number) == cases


def test_strict_number_fails_on_junk(spark):
    df = spark.createDataFrame([("12",), ("x",)], "v string")
    assert df.where("v = '12'").select(V.to_number_strict("v")).first()[0] == 12.0
    with pytest.raises(PySparkException):
        df.select(V.to_number_strict("v")).collect()


def test_id_text(spark):
    cases = {"007": "7", "-5": "-5", "7.5": "7.5", "junk": None, "": None, None: None, " 42 ": "42"}
    assert mapped(spark, cases, V.id_text) == cases


def test_last_part_keeps_an_empty_end(spark):
    cases = {"1900|1950|": "", "1900|1950": "1950", "1900": "1900", "": "", None: None}
    assert mapped(spark, cases, V.last_part) == cases


def test_prefix_is_false_for_missing_text(spark):
    cases = {"W01": True, "OUT": True, "x": False, None: False, "w": True}
    assert mapped(spark, cases, lambda c: V.has_prefix(c, ("OUT", "W", "w"))) == cases


def test_inequality_keeps_missing_values(spark):
    cases = {"nan": False, "MF": True, None: True}
    assert mapped(spark, cases, lambda c: V.differs(c, "nan")) == cases


def test_paths(spark):
    df = spark.createDataFrame([("a/b/c.tar.zip",), ("plain",)], "v string")
    rows = df.select(V.base_name("v"), V.folder_name("v"), V.extension("v")).collect()
    assert [tuple(r) for r in rows] == [("c.tar.zip", "a/b", "zip"), ("plain", "", "plain")]


def test_housing_type(spark):
    df = spark.createDataFrame(
        [
            ("0.75", "510", "SF-SL"),
            ("0.76", "510", "SF-LL"),
            ("0.1", "501", "SF-SL"),
            ("9", "505", "SF-LL"),
            ("9", "506", None),
            (None, "510", None),
            (None, "520", "SF-A"),
            ("1", "550", "SF-A"),
            ("1", "402", "MF"),
            ("1", "404", None),
            ("1", None, None),
        ],
        "acres string, luc string, want string",
    )
    rows = df.select("want", V.housing_type("acres", "luc").alias("got")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]


def test_ratio_by_zero_is_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(V.ratio("a", "b")).collect()] == [None, None, 2.0]


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame(
        [(1, 200, "1 (0%)"), (3, 200, "3 (2%)"), (0, 5, ""), (5, 5, "5 (100%)")],
        "n long, total long, want string",
    )
    rows = df.select("want", V.count_with_percent(F.col("n"), F.col("total")).alias("got"))
    assert all(r["want"] == r["got"] for r in rows.collect())


def test_find_all_and_first_digits(spark):
    df = spark.createDataFrame([("{'count': 1234, 'b': 9}",), ("none",)], "v string")
    rows = df.select(V.first_digits("v"), V.find_all("v", "[0-9]+")).collect()
    assert [tuple(r) for r in rows] == [(1234, ["1234", "9"]), (None, [])]
