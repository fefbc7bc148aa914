"""Columns that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, **values: Column) -> DataFrame:
    """Add (or replace) columns whose value is not folded into what uses them.

    A plain projection may be repeated by the optimizer inside every filter and join
    condition above it. That is free for a sum of two columns, not for a centroid. A
    generator of one row is never repeated: filters on its output stay above it.
    """
    one = F.inline(F.array(F.struct(*[v.alias(name) for name, v in values.items()])))
    metadata = {f.name: f.metadata for f in df.schema.fields}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
    out = df.select(*kept, one)
    for name in values:
        if metadata.get(name):
            out = out.withMetadata(name, metadata[name])
    return out
