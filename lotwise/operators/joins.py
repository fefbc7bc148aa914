"""Key joins.

The right sides are aggregated to one row per key first wherever the result allows. The
left sides may have hot keys (blank or missing ids, an id that repeats): those are
found beforehand and salted (see ``skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.values import title_case
from lotwise.operators.skew import SALT, salted_left, spread_join


def left_join_many(
    left: DataFrame, rights: list[DataFrame], on: str, nulls_match: bool = False
) -> DataFrame:
    """Left joins on one key column that all tables have.

    A key repeated on the right repeats the row. With ``nulls_match`` a missing key
    meets missing keys. The left side is shuffled once, its partitioning serves every
    further join; its hot keys are looked for once.
    """
    columns = [c for c in left.columns]
    left, rights, keys = salted_left(left, rights, [on])
    for i, right in enumerate(rights):
        columns += [c for c in right.columns if c not in (on, SALT)]
        named = right.withColumnsRenamed({k: f"_right_{i}_{k}" for k in keys})
        same = None
        for k in keys:
            theirs = F.col(f"`_right_{i}_{k}`")
            equal = F.col(f"`{k}`").eqNullSafe(theirs) if nulls_match else F.col(f"`{k}`") == theirs
            same = equal if same is None else same & equal
        left = left.join(named, same, "left").drop(*[f"_right_{i}_{k}" for k in keys])
    return left.select(*[F.col(f"`{c}`") for c in columns])


def left_join(
    left: DataFrame, right: DataFrame, on: str, right_on: str | None = None, nulls_match=False
) -> DataFrame:
    """Left join on a key; ``right_on`` is the right side's name of it."""
    return left_join_many(left, [right.withColumnRenamed(right_on or on, on)], on, nulls_match)


def inner_complete(left: DataFrame, right: DataFrame, on: str, right_on: str | None = None):
    """Rows with a partner and without any missing value."""
    right = right.withColumnRenamed(right_on or on, on)
    return spread_join(left, right, [on]).select(
        *[F.col(f"`{c}`") for c in [*left.columns, *[c for c in right.columns if c != on]]]
    ).dropna(how="any")


def keep_named_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose name, as it stands, is among the title-cased names of another table."""
    names = other.select(title_case(other_column).alias(column)).distinct()
    left, (names,), keys = salted_left(df, [names], [column])
    return left.join(names, keys, "left_semi").select(*df.columns)
