"""Parcel analytics on Spark: every operator is a DataFrame or Column function."""

from lotwise.session import configure, durable, shared_dir

__all__ = ["configure", "durable", "shared_dir"]
