"""Remove duplicates: one row per id, per shape, or per distinct row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.geometry import fingerprint
from lotwise.schema import SHAPE


def first_value(column: str, order: str) -> Column:
    """First non-null value in row order. ``first`` has no order after a shuffle."""
    # min_by passes over rows whose ordering value is null
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.col(order)))


def collapse(
    df: DataFrame,
    by: list[str],
    first: list[str] = (),
    largest: list[str] = (),
    order: str = "row_id",
    keep_order: bool = False,
) -> DataFrame:
    """One row per ``by``: first non-null of some columns, largest of others.

    Rows with a null key are dropped. A geometry key compares vertex lists. Its hash
    leads the grouping key, so that the sort-based aggregate compares long vertex
    lists only where the hashes agree. Maps combine before the shuffle, so a key
    with very many copies is no burden. ``keep_order`` adds the lowest order value.
    """
    shapes = [c for c in by if df.schema[c].dataType == SHAPE]
    metadata = {f.name: f.metadata for f in df.schema.fields}
    keys = [F.xxhash64(c).alias(f"_hash_{c}") for c in shapes] + [F.col(c) for c in by]
    aggregates = [first_value(c, order).alias(c) for c in first]
    aggregates += [F.max(c).alias(c) for c in largest]
    if keep_order or not aggregates:
        aggregates.append(F.min(order).alias(order))
    for c in by:
        df = df.where(F.col(c).isNotNull())
    out = df.groupBy(*keys).agg(*aggregates).drop(*[f"_hash_{c}" for c in shapes])
    if not keep_order and not first and not largest:
        out = out.drop(order)
    for c in out.columns:
        if metadata.get(c):
            out = out.withMetadata(c, metadata[c])
    return out


def distinct_rows(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Distinct rows with ``key`` left out of the comparison; the first key stays.

    Geometry columns are compared by fingerprint, and carried once per group.
    """
    order = order or key
    values = [c for c in df.columns if c not in (key, order)]
    shapes = [c for c in values if df.schema[c].dataType == SHAPE]
    plain = [F.col(c) for c in values if c not in shapes]
    prints = [fingerprint(c).alias(f"_print_{c}") for c in shapes]
    out = df.groupBy(*plain, *prints).agg(
        F.min_by(key, order).alias(key),
        *[F.any_value(c).alias(c, metadata=df.schema[c].metadata) for c in shapes],
    )
    return out.select(key, *values)
