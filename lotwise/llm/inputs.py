"""The tables these operators read, and the settings they count on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lotwise.session import configure

# Rows of an Arrow batch hold whole texts, so batches are bounded in bytes, too.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    configure(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a list of plain columns and arrays, also inside tasks, where
    Spark's own reader of DDL does not run."""

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else ARROW[name]

    return pa.schema([(name, kind(of)) for name, of in (column.split() for column in ddl.split(", "))])
