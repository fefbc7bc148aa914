"""County jobs: raw parcels, addresses and cards to the standard county table.

What differs between counties is data in a ``County``: which source column feeds
which standard column, how text turns into numbers, how duplicates collapse, which
address column is counted. ``standard_table`` runs any of the first seven; three
counties with a shape of their own follow.

The reference system is taken from the geometry column's metadata; results are in
Ohio South feet. Missing values stay null everywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions import values as V
from lotwise.functions.once import with_computed
from lotwise.functions.projection import OHIO_SOUTH, to_srid
from lotwise.operators.cards import all_cards, latest_effective_year, latest_year, rows_per_key
from lotwise.operators.collapse import collapse, distinct_rows
from lotwise.operators.dissolve import dissolve
from lotwise.operators.joins import inner_complete, left_join, left_join_many
from lotwise.operators.spatial import count_points
from lotwise.schema import with_srid
from lotwise.session import durable

ID = "OBJECTID"


@dataclass(frozen=True)
class County:
    """``columns``: source column -> standard column. ``convert``: standard column ->
    Column function, run after the rename. ``derive``: standard columns made of several
    source columns. ``collapse``: steps in order, of "dissolve", "id", "geometry",
    "id_geometry". ``drop_prefixes``: ids that are no parcels. ``year_from_cards``: the
    latest year of the cards becomes YRBUILT. ``units_first``: addresses are counted on
    the parcels as they come, before any collapse. ``numeric_ids``: ids are numbers in
    canonical text; a parcel whose id cannot be read is dropped after the collapse."""

    name: str
    columns: dict[str, str]
    address_id: str = "LSN"
    convert: dict[str, Callable[[str], Column]] = field(default_factory=dict)
    derive: dict[str, Callable[[], Column]] = field(default_factory=dict)
    collapse: tuple[str, ...] = ()
    id_suffix: str = ""
    drop_prefixes: tuple[str, ...] = ()
    drop_missing_ids: bool = False
    distinct: bool = False
    units_first: bool = False
    year_from_cards: bool = False
    numeric_ids: bool = False


# Column names of the sources, id prefixes that mark no parcel, the
# suffix of card ids, the word for an unreadable id.
JUNK_ID = "nan"
FRANKLIN = County(
    name="franklin",
    columns={"PARCELID": ID, "CLASSCD": "CLASS", "ACRES": "ACRES", "TOTVALUEBASE": "APPRTOT"},
    id_suffix="-00",
    drop_prefixes=("VNP", "OUT", "W", "w", "R", "r"),
    collapse=("dissolve", "geometry"),
    year_from_cards=True,
)
DELAWARE = County(
    name="delaware",
    columns={
        "OBJECTID": ID,
        "CLASS": "CLASS",
        "YRBUILT": "YRBUILT",
        "ACRES": "ACRES",
        "TAXABLE_TO": "APPRTOT",
    },
    convert={
        "CLASS": V.to_text,
        "YRBUILT": V.to_integer_strict,
        "ACRES": V.to_number_strict,
        "APPRTOT": V.to_number_strict,
    },
    collapse=("id", "geometry"),
    units_first=True,
)
FAIRFIELD = County(
    name="fairfield",
    columns={"PARID": ID, "LUC": "CLASS", "YRBLT": "YRBUILT"},
    derive={"APPRTOT": lambda: F.col("APRLAND") + F.col("APRBLDG")},
    convert={"YRBUILT": V.to_number, "APPRTOT": V.to_number},
    drop_missing_ids=True,
    collapse=("geometry",),
)
LICKING = County(
    name="licking",
    columns={
        "PARCEL": ID,
        "LUC": "CLASS",
        "GISACRES": "ACRES",
        "YEARBUILT": "YRBUILT",
        "NETTOTVAL": "APPRTOT",
    },
)
PICKAWAY = County(
    name="pickaway",
    columns={
        "Parcel": ID,
        "PPYearBuilt": "YRBUILT",
        "PPClassNumber": "CLASS",
        "PPAcres": "ACRES",
        "PPTotalValue": "APPRTOT",
    },
    convert={"YRBUILT": V.last_part},
)
UNION = County(
    name="union",
    columns={
        "ParcelNo": ID,
        "PARCELCLASS": "CLASS",
        "yearBuilt": "YRBUILT",
        "Acreage": "ACRES",
        "appraisedTotalValue": "APPRTOT",
    },
    convert={
        "YRBUILT": V.to_number,
        "ACRES": V.to_number,
        "APPRTOT": V.to_number,
    },
    address_id="AddressID",
    numeric_ids=True,
    distinct=True,
    collapse=("geometry", "id_geometry"),
)
# --- end of fixed values

LARGEST = ("YRBUILT", "ACRES", "APPRTOT")


def select_columns(parcels: DataFrame, county: County) -> DataFrame:
    """Wanted columns under their standard names, converted. ``row_id`` carries order."""
    chosen = [F.col(s).alias(t) for s, t in county.columns.items()]
    chosen += [make().alias(t) for t, make in county.derive.items()]
    df = parcels.select("row_id", *chosen, "geometry")
    for name, convert in county.convert.items():
        df = df.withColumn(name, convert(name))
    if county.numeric_ids:
        # a word, not null: an unreadable id in a group's first row must show
        df = df.withColumn(ID, F.coalesce(V.id_text(ID), F.lit(JUNK_ID)))
    if county.id_suffix:
        df = df.withColumn(ID, V.with_suffix(ID, county.id_suffix))
    if county.drop_prefixes:
        df = df.where(~V.has_prefix(ID, county.drop_prefixes))
    if county.drop_missing_ids:
        df = df.where(F.col(ID).isNotNull())
    return distinct_rows(df, "row_id") if county.distinct else df


def _collapsed(df: DataFrame, step: str, order: str) -> tuple[DataFrame, str]:
    """One collapse step, and the column that holds the row order after it."""
    present = [c for c in df.columns if c not in (ID, "geometry", "row_id")]
    largest = [c for c in LARGEST if c in present]
    if step == "dissolve":
        firsts = [c for c in present if c != ID]
        # rows come out by id
        return dissolve(df, ID, first=firsts, order=order), ID
    if step == "id":
        return collapse(df, [ID], ["CLASS", "geometry"], largest, order), ID
    if step == "geometry":
        return collapse(df, ["geometry"], [ID, "CLASS"], largest, order, True), order
    if step == "id_geometry":
        return collapse(df, [ID, "geometry"], ["CLASS"], largest, order, True), order
    raise ValueError(f"unknown collapse step {step!r}")


def collapse_parcels(df: DataFrame, county: County) -> DataFrame:
    order = "row_id"
    for step in county.collapse:
        if order == ID and step != "id":
            # the id becomes an aggregate below; keep the order beside it
            df, order = df.withColumn("_order", F.col(ID)), "_order"
        df, order = _collapsed(df, step, order)
    if county.numeric_ids:
        df = df.where(V.differs(ID, JUNK_ID))
    return df.drop("row_id", "_order")


def standard_table(
    county: County,
    parcels: DataFrame,
    addresses: DataFrame,
    cards: DataFrame | None = None,
) -> DataFrame:
    """Standard county table from raw parcels (``row_id``, source columns, ``geometry``),
    addresses (``point`` and the county's address id) and cards (``OBJECTID``, ``YRBLT``)."""
    raw = select_columns(parcels, county)
    # written where it took shuffles to make: what follows reads it several times
    df = durable(collapse_parcels(raw, county), "parcels") if county.collapse else raw.drop("row_id")
    addresses = addresses.select(county.address_id, "point")
    counted = raw if county.units_first else df
    # a collapse by geometry as the last step leaves no two rows with one shape
    units = count_points(counted, addresses, ID, county.address_id)
    tables = [units] + ([latest_year(cards, ID, "YRBLT")] if county.year_from_cards else [])
    return to_srid(left_join_many(df, tables, ID), OHIO_SOUTH)


# --- Madison: dissolved parcels and four XML tables -----------------------------


def madison(
    parcels: DataFrame,
    addresses: DataFrame,
    building: DataFrame,
    dwelling: DataFrame,
    appraisal: DataFrame,
    parcel_table: DataFrame,
) -> DataFrame:
    """Years and acres stay text, as the XML has them: the latest year is the largest
    text. Rows that agree in all but the id are one row."""
    lots = to_srid(parcels.select("row_id", "TAXPIN", "geometry"), OHIO_SOUTH)
    shapes = durable(dissolve(lots, "TAXPIN"), "parcels")
    units = count_points(
        shapes, to_srid(addresses.select("LSN", "point"), OHIO_SOUTH, "point"), "TAXPIN", "LSN"
    )
    columns = ["Parcel_Number", "Card", "Year_Built", "Year_Effective"]
    cards = all_cards(building.select(*columns), dwelling.select(*columns))
    years = latest_effective_year(cards, "Parcel_Number", "Year_Built", "Year_Effective")
    land_use = appraisal.select("Parcel_Number", F.col("Land_Use_Code").alias("CLASS"))
    value = appraisal.select(
        "Parcel_Number",
        (
            V.to_integer_strict("Total_Appraised_Improvement")
            + V.to_integer_strict("Total_Appraised_Land")
        ).alias("APPRTOT"),
    )
    acres = parcel_table.select("Parcel_Number", F.col("Acres").alias("ACRES"))
    # exact repeats would only multiply rows that the last step removes
    tables = [t.distinct() for t in (land_use, acres, value)]
    tables = [t.withColumnRenamed("Parcel_Number", "TAXPIN") for t in [*tables, years]]
    joined = left_join_many(shapes, [*tables, units], "TAXPIN")
    return distinct_rows(joined, "TAXPIN").withColumnRenamed("TAXPIN", ID)


# --- Knox: housing-type points ----------------------------------------------------


def knox(
    parcels: DataFrame,
    addresses: DataFrame,
    extract: DataFrame,
    building: DataFrame,
    dwelling: DataFrame,
) -> DataFrame:
    """One point per parcel and card year, with its housing type. Parcels without a land
    use are dropped. The id is the parcel's pin and the class the land use."""
    columns = ["PropertyNumber", "YearBuilt"]
    # cards enter by their year only; repeats would be removed at the end anyway
    years = all_cards(dwelling.select(*columns), building.select(*columns)).distinct()
    use = extract.select("mpropertyNumber", "mClassificationId", "macres").distinct()
    cama = left_join(use, years, "mpropertyNumber", "PropertyNumber").withColumn(
        "mpropertyNumber", V.digits_only("mpropertyNumber")
    )
    units = count_points(parcels, addresses.select("GlobalID", "point"), "PIN", "GlobalID")
    # the result is points: shapes stay out of the joins, their fingerprints tell
    # lots apart
    lots = as_points(
        parcels.select("row_id", "PIN", "geometry", G.fingerprint("geometry").alias("_print"))
    )
    df = left_join_many(lots, [cama.withColumnRenamed("mpropertyNumber", "PIN"), units], "PIN")
    numbers = df.where(F.col("mClassificationId").isNotNull()).select(
        F.struct("row_id", "PIN").alias("_first"),
        "_print",
        "geometry",
        F.col("mClassificationId").alias("CLASS"),
        V.to_number_strict("macres").alias("ACRES"),
        V.to_number_strict("YearBuilt").alias("YRBUILT"),
        "UNITS",
        "x",
        "y",
    )
    return (
        distinct_rows(numbers, "_first")
        .select(
            F.col("_first.PIN").alias(ID),
            "CLASS",
            "ACRES",
            "YRBUILT",
            "UNITS",
            V.housing_type("ACRES", "CLASS").alias("TYPE"),
            "geometry",
            "x",
            "y",
        )
        .where(V.differs("TYPE", "nan"))
    )


def as_points(df: DataFrame) -> DataFrame:
    """Shapes replaced by their centroids; rows without one are dropped."""
    return (
        with_computed(df, geometry=G.centroid("geometry"))
        .where(F.col("geometry").isNotNull())
        .withColumn("x", G.x_of("geometry"))
        .withColumn("y", G.y_of("geometry"))
    )


# --- Logan: housing-type points from spreadsheets ---------------------------------


def logan(
    parcels: DataFrame, addresses: DataFrame, building: DataFrame, dwelling: DataFrame
) -> DataFrame:
    """Parcels with a blank id are dropped, those without one stay. Years are numbers,
    as a spreadsheet holds them."""
    columns = ["Parcel Number U", "Year Effective"]
    cards = all_cards(building.select(*columns), dwelling.select(*columns)).withColumn(
        "Year Effective", V.to_number("Year Effective")
    )
    years = latest_year(cards, "Parcel Number U", "Year Effective")
    units = count_points(parcels, addresses.select("LSN", "point"), "Parcel_N_1", "LSN", "units")
    named = parcels.where(V.differs("Parcel_N_1", " ")).select(
        V.to_text("Parcel_N_1").alias("Parcel_N_1"), "Land_Use_C", "Acres", "geometry"
    )
    df = left_join_many(
        as_points(named),
        [units, years.withColumnRenamed("Parcel Number U", "Parcel_N_1")],
        "Parcel_N_1",
    )
    typed = df.withColumn("TYPE", V.housing_type("Acres", "Land_Use_C"))
    return typed.withColumnsRenamed(
        {"Parcel_N_1": ID, "Land_Use_C": "CLASS", "Acres": "ACRES", "units": "UNITS"}
    )


# --- Morrow: one row per card ------------------------------------------------------


def morrow(parcels: DataFrame, building: DataFrame, dwelling: DataFrame) -> DataFrame:
    """Cards with their parcel's shape and acreage; cards with anything missing drop out."""
    # a parcel is reprojected once, not once per card
    lots = to_srid(parcels.select("Name", "geometry", "A_Acreage"), OHIO_SOUTH)
    columns = ["PropertyNumber", "UseCode", "YearBuilt"]
    parts = [
        inner_complete(cards.select(*columns), lots, "PropertyNumber", "Name")
        for cards in (dwelling, building)
    ]
    df = parts[0].unionByName(parts[1]).select(
        F.col("PropertyNumber").alias("property"),
        F.col("A_Acreage").alias("acres"),
        F.col("UseCode").alias("land_use"),
        F.col("YearBuilt").alias("year_built"),
        "geometry",
    )
    return with_srid(df, OHIO_SOUTH).withColumn("county", F.lit("Morrow"))


# Fixed value: land-use prefix of buildings with several dwellings.
APARTMENT_PREFIX = ("40",)


def apartment_buildings(building: DataFrame) -> DataFrame:
    """Distinct (property, use, units) of apartment buildings, units as a number."""
    return (
        building.where(V.has_prefix("UseCode", APARTMENT_PREFIX))
        .select("PropertyNumber", "UseCode", V.to_number_strict("UnitCount").alias("UnitCount"))
        .distinct()
    )


def cards_per_property(dwelling: DataFrame) -> DataFrame:
    return rows_per_key(dwelling, "PropertyNumber", "CardNumber", "CardNumber")


STANDARD = {c.name: c for c in (FRANKLIN, DELAWARE, FAIRFIELD, LICKING, PICKAWAY, UNION)}
