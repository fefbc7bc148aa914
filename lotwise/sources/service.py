"""Paged feature services: metadata, page plan, page scan, feature decoding.

Replies lie in a folder of any store that Spark reads:

    <root>/count/*           reply to the count request
    <root>/meta/*            service description
    <root>/pages/offset=<n>/*  the page that starts at record n

``offset`` is a partition column of the scan, so a filter on it skips pages unread, and
Spark packs many small pages into a task. Before the scan the landed pages are held
against the page plan by their names alone; in it the features of each page are counted
against what the plan says, so a page that is missing, landed twice or short fails the
job. Pages are decoded in the JVM (``from_json``), of each feature only the wanted fields.

A live service is scanned by ``fetched_pages``: the page plan, dealt out, and a function
that fetches one page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions import geometry as G
from lotwise.functions.values import first_digits
from lotwise.schema import require_columns, with_srid

META_SCHEMA = (
    "maxRecordCount int, extent struct<spatialReference:struct<latestWkid:int>>, "
    "fields array<struct<name:string>>"
)


# --- count, metadata, page plan (on columns) ----------------------------------


def record_count(reply: Column | str) -> Column:
    """Record count: the first run of digits in the reply."""
    return first_digits(reply)


def page_offsets(count: Column | str, page_size: Column | int) -> Column:
    """Offsets of all pages: 0, size, 2 * size, ... below the count."""
    n = F.col(count) if isinstance(count, str) else count
    size = F.lit(page_size) if isinstance(page_size, int) else page_size
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1, size.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )


def service_metadata(reply: Column | str) -> Column:
    """struct<page_size, srid, fields> from a service description."""
    meta = F.from_json(F.col(reply) if isinstance(reply, str) else reply, META_SCHEMA)
    return F.struct(
        meta["maxRecordCount"].alias("page_size"),
        meta["extent"]["spatialReference"]["latestWkid"].alias("srid"),
        F.transform(meta["fields"], lambda f: f["name"]).alias("fields"),
    )


# --- page scan ----------------------------------------------------------------


def reply(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(reply): the landed reply to one request, one row for each of its files."""
    return spark.read.option("wholetext", True).text(f"{root}/{name}").withColumnRenamed("value", "reply")


class Service:
    """What the service said of itself: three values, read on the driver."""

    def __init__(self, spark: SparkSession, root: str):
        counted = reply(spark, root, "count").select(record_count("reply").cast("bigint")).first()
        if counted is None or counted[0] is None:
            raise ValueError("the count reply holds no number")
        said = reply(spark, root, "meta").select(service_metadata("reply").alias("m")).first()["m"]
        self.count, self.page_size, self.srid, self.fields = counted[0], *said


def page_plan(spark: SparkSession, count: int, page_size: int) -> DataFrame:
    """(offset, expected): every page and the number of features it must hold."""
    offset = F.col("id") * page_size
    return spark.range(-(-count // page_size)).select(
        offset.alias("offset"), F.least(F.lit(page_size), F.lit(count) - offset).alias("expected")
    )


def reconcile(plan: DataFrame, spark: SparkSession, root: str) -> None:
    """Raise if a planned page has not landed just once, or one landed that is not planned.

    The files are listed, not read.
    """
    landed = spark.read.format("binaryFile").load(f"{root}/pages").select(F.col("offset").cast("bigint").alias("offset"))
    times = landed.groupBy("offset").agg(F.count(F.lit(1)).alias("times"))
    wrong = plan.withColumn("planned", F.lit(1)).join(times, "offset", "full").where(
        F.col("planned").isNull() | F.col("times").isNull() | (F.col("times") > 1)
    )
    found = wrong.orderBy("offset").limit(5).collect()
    if found:
        said = "; ".join(
            f"offset {r['offset']}: {'not planned' if r['planned'] is None else f'landed {r["times"] or 0} times'}" for r in found
        )
        raise ValueError(f"landed pages do not agree with the page plan: {said}")


def read_pages(
    spark: SparkSession, root: str, columns: list[str] = (), page_size: int | None = None
) -> DataFrame:
    """(offset, body, expected): the landed pages. ``columns`` must be fields of the
    service; ``page_size`` is what the service says unless given."""
    service = Service(spark, root)
    if columns:
        require_columns(list(service.fields), list(columns))
    size = page_size or service.page_size
    plan = page_plan(spark, service.count, size)
    if not service.count:
        return plan.select("offset", F.lit(None).cast("string").alias("body"), "expected")
    reconcile(plan, spark, root)
    pages = spark.read.option("wholetext", True).text(f"{root}/pages")
    offset = F.col("offset").cast("bigint")
    expected = F.least(F.lit(size).cast("bigint"), F.lit(service.count) - offset)
    return pages.select(offset.alias("offset"), F.col("value").alias("body"), expected.alias("expected"))


def fetched_pages(plan: DataFrame, fetch: Callable[[int, int], str], tasks: int) -> DataFrame:
    """(offset, body, expected): pages of a live service. ``fetch(offset, expected)`` runs in
    ``tasks`` tasks, page by page; a lost task fetches its pages again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for offset, expected in zip(batch.offset, batch.expected, strict=True):
                body = fetch(int(offset), int(expected))
                yield pd.DataFrame({"offset": [offset], "body": [body], "expected": [expected]})

    dealt = plan.repartitionByRange(tasks, "offset")
    return dealt.mapInPandas(run, "offset bigint, body string, expected bigint")


# --- decoding -------------------------------------------------------------------


def _inline(pages: DataFrame, body: str, member: str, members: str, geometry: str) -> DataFrame:
    schema = f"features array<struct<{member}:struct<{members}>,geometry:{geometry}>>"
    # a page that is cut off raises here; an error reply has no features
    features = F.from_json(F.col(body), schema, {"mode": "FAILFAST"})["features"]
    missing = F.raise_error(F.concat(F.lit("page without features: "), F.substring(F.col(body), 1, 200)))
    features = F.coalesce(features, F.when(F.col(body).isNotNull(), missing))
    if "expected" in pages.columns:
        short = F.concat_ws(
            " ", F.lit("page at offset"), "offset", F.lit("holds"), F.size(features), F.lit("features, not"), "expected"
        )
        features = F.when(F.size(features) == F.col("expected"), features).otherwise(F.raise_error(short))
    return pages.select(F.inline(features)).select(f"{member}.*", F.col("geometry").alias("_g"))


def geojson_features(
    pages: DataFrame, fields: str, kind: str = "shape", body: str = "body"
) -> DataFrame:
    """Features of GeoJSON pages; ``fields`` is the DDL of the wanted properties
    (``"LSN:bigint,NAME:string"``)."""
    rows = _inline(pages, body, "properties", fields, "struct<type:string,coordinates:string>")
    decode = G.from_geojson if kind == "shape" else G.point_from_geojson
    name = "geometry" if kind == "shape" else "point"
    return rows.withColumn(name, decode(F.col("_g.type"), F.col("_g.coordinates"))).drop("_g")


def esri_polygons(
    pages: DataFrame, fields: str, rings: str = "all", body: str = "body"
) -> DataFrame:
    """Features of Esri JSON pages with polygon rings.

    Outer rings run clockwise and start a part; the others are holes of the part
    before them. ``rings='first'`` keeps only the first ring of each feature.
    """
    rows = _inline(
        pages, body, "attributes", fields, "struct<rings:array<array<array<double>>>>"
    )
    decoded = G.shape_of_positions(F.col("_g.rings"))
    if rings == "first":
        shape = F.when(F.size(decoded) > 0, F.array(F.slice(decoded, 1, 1)))
    else:
        empty = F.array().cast("array<array<array<struct<x:double,y:double>>>>")

        def place(parts: Column, ring: Column) -> Column:
            n = F.size(parts)
            hole = (n > 0) & (G.ring_area(ring) > 0)
            return F.when(
                hole,
                F.concat(
                    F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))),
                    F.array(F.concat(F.element_at(parts, -1), F.array(ring))),
                ),
            ).otherwise(F.concat(parts, F.array(F.array(ring))))

        shape = F.when(
            F.col("_g.rings").isNotNull(), F.aggregate(decoded, empty, place)
        )
    return rows.withColumn("geometry", shape).drop("_g")


def esri_points(pages: DataFrame, fields: str, body: str = "body") -> DataFrame:
    """Features of Esri JSON pages with x, y, read by name."""
    rows = _inline(pages, body, "attributes", fields, "struct<x:double,y:double>")
    point = F.when(F.col("_g").isNotNull(), G.point("_g.x", "_g.y"))
    return rows.withColumn("point", point).drop("_g")


def read_service(
    spark: SparkSession,
    root: str,
    fields: str,
    kind: str = "shape",
    columns: list[str] = (),
    srid: int | str | None = "from_service",
    page_size: int | None = None,
) -> DataFrame:
    """All features of a paged GeoJSON service, its reference system declared.

    ``srid``: ``"from_service"``, a number, or None to leave it undeclared.
    """
    if columns:  # what is not wanted is not decoded
        known = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(fields)}
        require_columns(list(known), list(columns))
        fields = ",".join(f"`{c}`:{known[c]}" for c in columns)
    df = geojson_features(read_pages(spark, root, columns, page_size), fields, kind)
    if columns:
        df = df.select(*columns, df.columns[-1])
    if srid is None:
        return df
    code = Service(spark, root).srid if srid == "from_service" else int(srid)
    return with_srid(df, code, df.columns[-1])
