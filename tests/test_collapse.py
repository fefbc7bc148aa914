"""Collapse rules: first non-null in row order, null keys, geometry keys."""

from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.operators import skew
from lotwise.operators.cards import all_cards, latest_effective_year, latest_year, rows_per_key
from lotwise.operators.collapse import collapse, distinct_rows
from lotwise.operators.joins import (
    inner_complete,
    keep_named_in,
    left_join,
    left_join_many,
)
from lotwise.schema import with_srid
from tests.shapes import LONG, STRING, rectangle, shape_table


def test_first_passes_over_nulls_in_row_order(spark):
    rows = [(3, "k", "c3", 5), (1, "k", None, 9), (2, "k", "c2", None), (4, None, "x", 1)]
    df = spark.createDataFrame(rows, "row_id long, id string, c string, n int")
    out = collapse(df.repartition(4), ["id"], ["c"], ["n"]).collect()
    assert [r.asDict() for r in out] == [{"id": "k", "c": "c2", "n": 9}]


def test_geometry_key_compares_vertex_lists(spark):
    a, b = rectangle(0, 0, 1, 1), rectangle(0, 0, 1, 2)
    turned = [[a[0][0][1:] + a[0][0][1:2]]]
    rows = [(1, "p", a), (2, "q", a), (3, "r", b), (4, "s", turned), (5, "t", None)]
    df = with_srid(shape_table(spark, rows, ("row_id", LONG), ("id", STRING)), 3735)
    out = collapse(df, ["geometry"], ["id"], keep_order=True)
    assert sorted((r["id"], r["row_id"]) for r in out.collect()) == [("p", 1), ("r", 3), ("s", 4)]
    assert out.schema["geometry"].metadata == {"srid": 3735}
    again = collapse(out, ["geometry"], ["id"], keep_order=True)
    assert again.select("id").exceptAll(out.select("id")).count() == 0


def test_text_maximum_is_by_letter(spark):
    df = spark.createDataFrame([("k", "9"), ("k", "10")], "id string, y string")
    assert latest_year(df, "id", "y").first()["YRBUILT"] == "9"


def test_effective_year_drops_incomplete_cards(spark):
    df = spark.createDataFrame(
        [("k", "1", "1990", "1995"), ("k", "2", "2001", None), ("m", "1", None, "1999")],
        "id string, card string, built string, eff string",
    )
    out = latest_effective_year(df, "id", "built", "eff").collect()
    assert [tuple(r) for r in out] == [("k", "1995")]


def test_distinct_rows_ignore_the_key(spark):
    a = rectangle(0, 0, 1, 1)
    rows = [("p2", 1, a), ("p1", 1, a), ("p3", None, a), ("p4", None, a), ("p5", 1, None)]
    df = shape_table(spark, rows, ("id", STRING), ("n", LONG))
    out = distinct_rows(df, "id")
    assert sorted(r["id"] for r in out.collect()) == ["p1", "p3", "p5"]
    assert out.where("id = 'p1'").select(G.area("geometry")).first()[0] == 1.0


def test_joins_repeat_and_match_as_stated(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, l int")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, r int")
    plain = sorted((r["l"], r["r"] or 0) for r in left_join(left, right, "k").collect())
    assert plain == [(1, 10), (1, 11), (2, 0), (3, 0)]
    nulls = left_join(left, right, "k", nulls_match=True).collect()
    assert sorted((r["l"], r["r"] or 0) for r in nulls) == [(1, 10), (1, 11), (2, 12), (3, 0)]
    many = left_join_many(left, [right, right.withColumnRenamed("r", "s")], "k")
    assert many.where("k = 'a'").count() == 4
    inner = inner_complete(left, right, "k").collect()
    assert sorted((r["l"], r["r"]) for r in inner) == [(1, 10), (1, 11)]


def test_semi_join_title_cases_the_other_side(spark):
    df = spark.createDataFrame([("Franklin",), ("franklin",), ("Knox",)], "c string")
    names = spark.createDataFrame([("franklin",), ("franklin",)], "n string")
    assert [r["c"] for r in keep_named_in(df, "c", names, "n").collect()] == ["Franklin"]


def test_cards_union_by_name_and_counts(spark):
    a = spark.createDataFrame([("p", 1)], "id string, n int")
    b = spark.createDataFrame([(2, "q"), (3, "q"), (None, "q")], "n int, id string")
    out = rows_per_key(all_cards(a, b), "id", "n").collect()
    assert [tuple(r) for r in out] == [("q", 2), ("p", 1)]
    assert all_cards(a, b).where(F.col("n").isNull()).count() == 1


def test_hot_and_missing_left_keys_are_salted(spark, monkeypatch):
    """A third of the rows under one id, a third without: no task gets them all."""
    original = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda counts, keys: original(counts, keys, 100))
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
    left = spark.range(0, 3000, 1, 4).select(
        key.otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    right = left.groupBy("k").agg(F.count("id").alias("n"))
    twice = right.where("k = 'hot'").unionByName(right)

    salted, _, on = skew.salted_left(left, [right], ["k"])
    assert on == ["k", skew.SALT]
    salts = {r["k"]: r["n"] for r in salted.groupBy("k").agg(
        F.count_distinct(skew.SALT).alias("n")).where("n > 1").collect()}
    assert salts == {"hot": 10, None: 10}

    def rows(df):
        return sorted(map(str, df.collect()))

    def plain(how, other=right, condition=None):
        other = other.withColumnRenamed("k", "_k")
        same = F.col("k") == F.col("_k") if condition is None else condition
        return left.join(other, same, how).drop("_k")

    assert rows(left_join(left, right, "k")) == rows(plain("left"))
    assert rows(left_join(left, twice, "k")) == rows(plain("left", twice))
    null_safe = F.col("k").eqNullSafe(F.col("_k"))
    assert rows(left_join(left, right, "k", nulls_match=True)) == rows(
        plain("left", condition=null_safe)
    )
    assert rows(inner_complete(left, right, "k")) == rows(plain("inner"))
    assert rows(inner_complete(right, left, "k").select("k", "id", "n")) == rows(plain("inner"))
    names = spark.createDataFrame([("HOT",), ("5",)], "n string")
    lower = left.withColumn("k", F.initcap("k"))
    assert keep_named_in(lower, "k", names, "n").count() == 1000 + 1


def test_equal_rows_of_a_hot_key_are_spread(spark, monkeypatch):
    """Rows that agree in every column: no salt holds more than its share of them."""
    original = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda counts, keys: original(counts, keys, 100))
    left = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") < 3000, "").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("x").alias("class"),
    )
    right = left.groupBy("k").agg(F.count("class").alias("n"))
    hot = skew.find_hot(skew.key_counts(left, ["k"]), ["k"])
    (salts,) = [r[skew.SALTS] for r in hot.collect()]
    salted, _, _ = skew.salted_left(left, [right], ["k"])
    held = [r["count"] for r in salted.where("k = ''").groupBy(skew.SALT).count().collect()]
    assert len(held) == salts and max(held) <= 2 * 3000 / salts
    joined = left_join(left, right, "k")
    assert joined.count() == 4000 and joined.where("n is null").count() == 0


def test_as_many_keys_are_spread_as_the_cluster_has_shares(spark, monkeypatch):
    original = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda counts, keys: original(counts, keys, 1))
    left = spark.range(0, 4000, 1, 4).select((F.col("id") % 2000).alias("k"))
    hot = skew.find_hot(skew.key_counts(left, ["k"]), ["k"])
    shares = skew.most_shares(left)
    assert shares == skew.SHARES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert hot.count() == min(2000, shares)
