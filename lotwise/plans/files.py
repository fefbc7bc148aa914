"""County jobs from their own files, with a manifest of what each was built from.

A county's files lie in ``<raw>/<county>/<table>``. Before a county is built, the names,
sizes and times of its files are summed up, one row a table; after its table is written the
sums go to ``<root>/manifest``. A county whose sums stand there already is not built again,
so a run that was cut short is run anew and does the rest only. No file is opened for it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import values as V
from lotwise.plans import counties, jobs
from lotwise.session import durable
from lotwise.sources import sinks, tables

Reader = Callable[[SparkSession, str], DataFrame]
Writer = Callable[[DataFrame, str, str], None]

# To be raised when the jobs change, so that all counties are built again.
RULES = 1
MANIFEST = "table string, n_files bigint, n_bytes bigint, sum bigint, rules int, county string"

layer: Reader = tables.read_layer


def delimited_text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Written once as a table: the jobs count keys before they join, and each reading of
    text would split and parse it again."""
    return durable(tables.read_delimited(spark, path, sep), "texts")


pipe_text: Reader = partial(delimited_text, sep="|")
comma_text: Reader = partial(delimited_text, sep=",")
records: Reader = partial(tables.read_xml_records, row_tag="Card")


@dataclass(frozen=True)
class Job:
    """``tables``: argument of ``build`` -> how its files are read."""

    tables: dict[str, Reader]
    build: Callable[..., DataFrame]
    write: Writer


def standard(df: DataFrame, name: str, root: str) -> None:
    jobs.save_county(df, name, root)


def points(df: DataFrame, name: str, root: str) -> None:
    """Housing-type points of several counties in one table; a county's are replaced."""
    columns = [V.to_number(c).alias(c) if c == "ACRES" else F.col(c) for c in ("OBJECTID", "CLASS", "ACRES", "UNITS", "TYPE", "x", "y")]
    sinks.append_rows(df.select(*columns), f"{root}/points", batch=name)


def cards(df: DataFrame, name: str, root: str) -> None:
    """One row per card, in a table of the county's own."""
    df.write.mode("overwrite").parquet(f"{root}/cards/{name}")


LAYERS = {"parcels": layer, "addresses": layer}
JOBS = {
    "madison": Job(
        LAYERS | dict.fromkeys(("building", "dwelling", "appraisal", "parcel_table"), records),
        counties.madison,
        standard,
    ),
    "knox": Job(
        LAYERS | dict.fromkeys(("extract", "building", "dwelling"), pipe_text), counties.knox, points
    ),
    "logan": Job(LAYERS | dict.fromkeys(("building", "dwelling"), comma_text), counties.logan, points),
    "morrow": Job(
        {"parcels": layer} | dict.fromkeys(("building", "dwelling"), pipe_text), counties.morrow, cards
    ),
}
for _name, _county in counties.STANDARD.items():
    JOBS[_name] = Job(
        LAYERS | ({"cards": comma_text} if _county.year_from_cards else {}),
        partial(counties.standard_table, _county),
        standard,
    )


def sums(spark: SparkSession, raw: str, name: str) -> DataFrame:
    """What a county's files are known by, one row a table; their contents are not read."""
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{raw}/{name}/{table}")
        .select(F.lit(table).alias("table"), "path", "length", "modificationTime")
        for table in JOBS[name].tables
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
            F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("sum"),
        )
        .withColumns({"rules": F.lit(RULES), "county": F.lit(name)})
    )


def recorded(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def build_changed(spark: SparkSession, raw: str, root: str, names: list[str]) -> list[str]:
    """Build the counties whose files are not those of the manifest; returns their names."""
    known = {tuple(r) for r in recorded(spark, root).collect()}  # a few rows a county
    built = []
    for name in names:
        now = [tuple(r) for r in sums(spark, raw, name).collect()]
        if {r for r in known if r[-1] == name} == set(now):
            continue
        job = JOBS[name]
        inputs = {t: read(spark, f"{raw}/{name}/{t}") for t, read in job.tables.items()}
        job.write(job.build(**inputs), name, root)
        # as it was before the county was read: files that came since are a change
        (
            spark.createDataFrame(now, MANIFEST)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("county")
            .parquet(f"{root}/manifest")
        )
        built.append(name)
    return built
