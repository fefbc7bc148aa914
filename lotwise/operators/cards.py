"""Assessment cards: several building and dwelling cards per parcel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_cards(*tables: DataFrame) -> DataFrame:
    """Building and dwelling cards in one table, columns by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def latest_year(cards: DataFrame, key: str, year: str, out: str = "YRBUILT") -> DataFrame:
    """Largest year per parcel, text as text and numbers as numbers.

    The maximum is the same with or without repeated cards and per-table maxima, so
    one grouping does: each map task keeps one row per parcel for the shuffle.
    """
    return (
        cards.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(year).alias(out))
    )


def latest_effective_year(
    cards: DataFrame, key: str, built: str, effective: str, out: str = "YRBUILT"
) -> DataFrame:
    """Cards without any missing value, then the largest effective year per parcel.

    The year built stands in for a missing effective year; after the first step
    there is none, which keeps the result of the job this replaces.
    """
    whole = cards.dropna(how="any")
    year = F.coalesce(F.col(effective), F.col(built))
    return latest_year(whole.select(key, year.alias("_year")), key, "_year", out)


def rows_per_key(df: DataFrame, key: str, value: str, out: str = "n") -> DataFrame:
    """Non-null values per key, largest count first, ties by key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(value).alias(out))
        .orderBy(F.col(out).desc(), F.col(key))
    )
