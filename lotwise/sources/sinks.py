"""Writers. Folders are made by Spark; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_raw(df: DataFrame, path: str) -> None:
    """Keep a source as it came, before any cleaning."""
    df.write.mode("overwrite").parquet(path)


def write_counties(df: DataFrame, path: str) -> None:
    """Standard tables as one folder per county; only the counties in ``df`` are replaced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("COUNTY")
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Create the table, or add to it.

    With a ``batch`` the rows go to a folder of that name, a partition column of the
    table, which Spark replaces when it commits: an append that is done again after a
    failure, or twice, adds nothing.
    """
    if batch is None:
        df.write.mode("append").parquet(path)
        return
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )
