"""Session settings and the shared folder for data that must survive executor loss."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. They salt hot join keys themselves; where
# adaptive execution can split a skewed partition as well, it may, also at the cost of
# one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Folders of local sessions that name none, by application.
_own_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators count on and hand the package to the executors."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Python workers import this package; Spark's file server takes it to them."""
    if any(f.endswith("lotwise.zip") for f in spark.sparkContext.listFiles):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lotwise-code-"), "lotwise")
    archive = shutil.make_archive(
        target, "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: what the cluster names in spark.checkpoint.dir.

    Only a local session that names none gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="lotwise-")
    return _own_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """The rows over all shuffle partitions, by columns where some are given. A number that
    is stated stays: adaptive execution would join them to one a core, whatever a task holds."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def durable(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    Parquet keeps column pruning and gives later joins real sizes to plan with.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
