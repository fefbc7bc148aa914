"""Regional parcel table from the standard county tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions import values as V
from lotwise.functions.once import with_computed
from lotwise.functions.projection import (
    ACRES_PER_SQ_METRE,
    EQUAL_AREA,
    OHIO_SOUTH,
    reproject_shape,
    to_srid,
)
from lotwise.operators.spatial import assign_region
from lotwise.schema import srid_of, with_srid

# The counties of the region.
COUNTIES = ("franklin", "delaware", "licking", "union", "madison", "pickaway", "fairfield")


def with_acres(df: DataFrame, shape: str = "geometry", out: str = "CALCACRES") -> DataFrame:
    """Acres measured on an equal-area projection."""
    flat = reproject_shape(shape, srid_of(df, shape), EQUAL_AREA)
    return with_computed(df, **{out: G.area(flat) * ACRES_PER_SQ_METRE})


def one_unit_per_house(df: DataFrame) -> DataFrame:
    """Single-family lots count one unit, whatever the addresses say."""
    single = F.col("TYPE").isin(V.SMALL_LOT, V.LARGE_LOT)
    return df.withColumn("UNITS", V.value_where(single, 1, F.col("UNITS").cast("bigint")))


def located_parcels(parcels: DataFrame) -> DataFrame:
    """All that needs only the parcel itself: size, type, centroid, numbers."""
    df = to_srid(parcels, OHIO_SOUTH)
    df = with_acres(df).withColumn("TYPE", V.housing_type("CALCACRES", "CLASS"))
    df = df.where(F.col("geometry").isNotNull())
    df = with_srid(with_computed(df, centroid=G.centroid("geometry")), OHIO_SOUTH, "centroid")
    df = df.withColumn("x", G.x_of("centroid")).withColumn("y", G.y_of("centroid"))
    return one_unit_per_house(df.withColumn("YRBUILT", V.to_number("YRBUILT")))


def region_table(parcels: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    """The regional table: one row per parcel whose centroid lies in a jurisdiction.

    ``parcels`` is the union of the county tables with ``COUNTY``. The join moves
    centroids and ids next to the jurisdictions, with the shape along, as it is part
    of the result.
    """
    regions = to_srid(jurisdictions, OHIO_SOUTH)
    joined = assign_region(located_parcels(parcels), regions, "PLACECOMBO")
    return joined.drop("centroid")
