"""County-shaped sources derived from the inputs, under the column names that the
county jobs expect. Every one covers all parcels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I

ACRES = "round((2 * w - cut) * h / 2 / 43560, 4)"


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.parcels(spark, sf_dir).withColumn("acres", F.expr(ACRES))


def addresses(spark: SparkSession, sf_dir: str, name: str = "LSN") -> DataFrame:
    return I.addresses(spark, sf_dir).withColumnRenamed("lsn", name)


def franklin(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "parcelid as PARCELID",
        "class as CLASSCD",
        "acres as ACRES",
        "aprland + aprbldg as TOTVALUEBASE",
        "geometry",
    )


def franklin_cards(spark, sf_dir):
    columns = ["concat(parcel_id, '-00') as OBJECTID", "try_cast(yrblt as double) as YRBLT"]
    return I.dwelling(spark, sf_dir).selectExpr(*columns).unionByName(
        I.building(spark, sf_dir).selectExpr(*columns)
    )


def delaware(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "parcelid as OBJECTID",
        "class as CLASS",
        "cast(1900 + row_id % 120 as string) as YRBUILT",
        "cast(acres as string) as ACRES",
        "cast(aprbldg as string) as TAXABLE_TO",
        "geometry",
    )


def fairfield(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "case when row_id % 10 = 0 then null else parcelid end as PARID",
        "class as LUC",
        "yrbuilt as YRBLT",
        "aprland as APRLAND",
        "aprbldg as APRBLDG",
        "geometry",
    )


def licking(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "parcelid as PARCEL",
        "class as LUC",
        "acres as GISACRES",
        "yrbuilt as YEARBUILT",
        "aprbldg as NETTOTVAL",
        "geometry",
    )


def pickaway(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "parcelid as Parcel",
        "yrhist as PPYearBuilt",
        "class as PPClassNumber",
        "acres as PPAcres",
        "aprbldg as PPTotalValue",
        "geometry",
    )


def union(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "row_id",
        "parcelid as ParcelNo",
        "class as PARCELCLASS",
        "yrbuilt as yearBuilt",
        "cast(acres as string) as Acreage",
        "cast(aprbldg as string) as appraisedTotalValue",
        "geometry",
    )


def madison(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr("row_id", "parcelid as TAXPIN", "geometry")


def madison_cards(cards):
    return cards.selectExpr(
        "parcel_id as Parcel_Number",
        "cast(card as string) as Card",
        "yrblt as Year_Built",
        "yreff as Year_Effective",
    )


def madison_appraisal(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "concat('0', lpad(cast(row_id as string), 9, '0')) as Parcel_Number",
        "class as Land_Use_Code",
        "cast(cast(floor(aprbldg) as bigint) as string) as Total_Appraised_Improvement",
        "cast(cast(floor(coalesce(aprland, 0)) as bigint) as string) as Total_Appraised_Land",
    )


def madison_parcel_table(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "concat('0', lpad(cast(row_id as string), 9, '0')) as Parcel_Number",
        "cast(cast(round(acres * 10000) as bigint) as string) as Acres",
    )


def knox(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr("row_id", "parcelid as PIN", "acres as Acres", "geometry")


def knox_extract(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "concat('P-0', lpad(cast(row_id as string), 9, '0')) as mpropertyNumber",
        "'1' as CardCount",
        "class as mClassificationId",
        "cast(acres as string) as macres",
    )


def knox_cards(cards):
    return cards.selectExpr(
        "concat('P-', parcel_id) as PropertyNumber",
        "cast(card as string) as CardNumber",
        "yrblt as YearBuilt",
    )


def logan(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr(
        "case row_id % 10 when 0 then ' ' when 5 then null else parcelid end as Parcel_N_1",
        "class as Land_Use_C",
        "cast(acres as string) as Acres",
        "geometry",
    )


def logan_cards(cards):
    return cards.selectExpr(
        "parcel_id as `Parcel Number U`",
        "cast(card as string) as Card",
        "yrblt as `Year Built`",
        "yreff as `Year Effective`",
    )


def morrow(spark, sf_dir):
    return lots(spark, sf_dir).selectExpr("parcelid as Name", "acres as A_Acreage", "geometry")


def morrow_cards(cards):
    if "use_code" not in cards.columns:
        cards = cards.selectExpr("*", "'510' as use_code", "1 as unit_count")
    return cards.selectExpr(
        "parcel_id as PropertyNumber",
        "use_code as UseCode",
        "yrblt as YearBuilt",
        "cast(unit_count as string) as UnitCount",
        "cast(card as string) as CardNumber",
    )
