"""Hot join keys: find them cheaply, spread their rows over several tasks.

A key is hot when it has more than ROWS_PER_TASK rows, which is what one task copes with
anyway, and is among the keys with most rows: as many of them as ``most_shares`` says,
a multiple of the shuffle partitions. Any other key holds less than that share of all
rows, whatever the data, so it is well below what a task gets in an even deal. The list
of hot keys grows with the cluster, not with the data, and is safe to broadcast.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import durable

ROWS_PER_TASK = 100_000
SHARES_PER_PARTITION = 4

SALT = "_salt"
SALTS = "_salts"


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, as ``_n``; counts combine in the map tasks."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))


def most_shares(df: DataFrame) -> int:
    """Into how many shares the rows are cut at most: several for each shuffle partition."""
    return SHARES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hot keys and the number of salts to spread each over, from rows per key.

    Ranking is a distributed top-k. The limit is on the list of keys to salt, never on
    rows.
    """
    n, most = F.col("_n"), most_shares(counts)
    names = [F.col(f"`{k}`") for k in keys]
    return (
        counts.where(n > rows_per_task)
        # keys break ties: every use of the list must see the same keys
        .orderBy(n.desc(), *names)
        .limit(most)
        .select(
            *names,
            F.least(F.ceil(n / F.lit(rows_per_task)), F.lit(most)).cast("int").alias(SALTS),
        )
    )


def numbered(df: DataFrame) -> DataFrame:
    """The rows with a number each, as ``_row``, written: equal rows differ in it, and a
    task that runs again reads the same numbers."""
    return durable(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def spread(
    df: DataFrame, keys: list[str], hot: DataFrame, by: Column, salt: str = SALT
) -> DataFrame:
    """Give each row one salt, from a hash ``by`` which rows of one key must differ; it
    must not change when a task runs again. A missing key may be hot as well."""
    salts = F.coalesce(F.col(SALTS), F.lit(1)).cast("bigint")
    return (
        _with_salts(df.withColumn("_hash", by), keys, hot)
        .withColumn(salt, F.pmod(F.col("_hash"), salts).cast("int"))
        .drop(SALTS, "_hash")
    )


def spread_rows(df: DataFrame, keys: list[str], hot: DataFrame, salt: str = SALT) -> DataFrame:
    """Spread every row of a hot key, also rows that are equal in all columns."""
    return spread(numbered(df), keys, hot, F.xxhash64("_row"), salt).drop("_row")


def replicate(df: DataFrame, keys: list[str], hot: DataFrame, salt: str = SALT) -> DataFrame:
    """Give each row every salt of its key: one copy for keys that are not hot."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)
    return _with_salts(df, keys, hot).withColumn(salt, F.explode(salts)).drop(SALTS)


def _with_salts(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    listed = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_hot_{k}`")) for k in keys])
    return df.join(F.broadcast(listed), same, "left").drop(*[f"_hot_{k}" for k in keys])


def find_hot(counts: DataFrame, keys: list[str]) -> DataFrame | None:
    """The hot keys, or None where there are none.

    A job of its own: both sides of a join must work from one list, and without hot
    keys the join stays a plain one.
    """
    hot = hot_keys(counts, keys)
    rows = hot.collect()  # at most most_shares
    return counts.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def salted_left(
    left: DataFrame,
    rights: list[DataFrame],
    keys: list[str],
    left_counts: DataFrame | None = None,
) -> tuple[DataFrame, list[DataFrame], list[str]]:
    """Both sides of joins whose left keys may be hot, and the columns to join on.

    A hot left key's rows are spread over its salts and each of its right rows is
    copied to all of them, so inner, left, semi and anti joins on the returned columns
    give what they give on the keys alone. Adaptive execution cannot do this where the
    right side comes straight from a grouping by the key. ``left_counts`` (keys, ``_n``)
    saves the counting where the counts are known.
    """
    counts = key_counts(left, keys) if left_counts is None else left_counts
    hot = find_hot(counts, keys)
    if hot is None:
        return left, rights, keys
    return spread_rows(left, keys, hot), [replicate(r, keys, hot) for r in rights], [*keys, SALT]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_counts: DataFrame | None = None,
    right_counts: DataFrame | None = None,
    right_even: bool = False,
) -> DataFrame:
    """Inner equi-join whose keys may be hot on either side.

    Rows of a key that is hot on the left are spread over the left salts and meet
    copies of its right rows, and the other way round. ``right_even`` says that no key
    is hot on the right.
    """
    right_hot = None
    if not right_even:
        right_hot = find_hot(key_counts(right, keys) if right_counts is None else right_counts, keys)
    left, (right,), on = salted_left(left, [right], keys, left_counts)
    if right_hot is not None:
        right = spread_rows(right, keys, right_hot, "_salt_right")
        left = replicate(left, keys, right_hot, "_salt_right")
        on = [*on, "_salt_right"]
    return left.join(right, on).drop(SALT, "_salt_right")
