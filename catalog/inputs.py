"""Parcel-shaped inputs derived from the given tables by SQL that runs unchanged in
Spark and DuckDB. Every one covers its whole source table.

Lots lie on a 200 ft grid in Ohio South feet. A lot is a right trapezoid with corners
(x0, y0), (x0+w, y0), (x0+w-cut, y0+h), (x0, y0+h). Every 7th lot repeats its
neighbour's shape, every 11th its neighbour's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import configure
from lotwise.functions import geometry as G
from lotwise.functions.once import with_computed
from lotwise.functions.projection import OHIO_SOUTH
from lotwise.schema import with_srid
from lotwise.session import dealt

PARCELS = """
select c_custkey as row_id,
  concat(case when c_custkey % 17 = 0 then 'W' when c_custkey % 19 = 0 then 'VNP' else '0' end,
    lpad(cast(case when c_custkey % 11 = 10 then c_custkey - 1 else c_custkey end as string), 9, '0'))
    as parcelid,
  case c_custkey % 12 when 0 then '510' when 1 then '511' when 2 then '501' when 3 then '505'
    when 4 then '506' when 5 then '520' when 6 then '550' when 7 then '401' when 8 then '403'
    when 9 then '340' when 10 then ' ' else null end as class,
  case when c_custkey % 9 = 0 then null when c_custkey % 13 = 0 then 'N/A'
    else cast(1900 + (c_custkey * 31) % 125 as string) end as yrbuilt,
  case when c_custkey % 8 = 0 then null when c_custkey % 8 = 1 then ''
    else concat(cast(1900 + c_custkey % 50 as string), '|', cast(1950 + c_custkey % 75 as string))
    end as yrhist,
  case when c_custkey % 23 = 0 then null else round(c_acctbal * 10, 2) end as aprland,
  round(c_acctbal * 20, 2) as aprbldg,
  case c_nationkey % 7 when 0 then 'franklin' when 1 then 'delaware' when 2 then 'licking'
    when 3 then 'union' when 4 then 'madison' when 5 then 'pickaway' else 'fairfield' end as county,
  g,
  cast(1800000 as double) + 200 * (g % 100) as x0,
  cast(700000 as double) + 200 * ((g - g % 100) / 100) as y0,
  100 + (g * 37) % 90 as w,
  80 + (g * 53) % 110 as h,
  (g % 3) * 20 as cut
from (
  select customer.*, case when c_custkey % 7 = 6 then c_custkey - 1 else c_custkey end as g
  from customer) q
"""

ADDRESSES = """
select o_orderkey as addr_id,
  case when o_orderkey % 29 = 0 then null else o_orderkey end as lsn,
  cast(1800000.5 as double) + 200 * (o_custkey % 100) + (o_orderkey * 17) % 200 as x,
  cast(700000.5 as double) + 200 * ((o_custkey - o_custkey % 100) / 100)
    + (o_orderkey * 13) % 200 as y
from orders
"""

# One dwelling card per order, one building card per order line.
DWELLING = """
select concat('0', lpad(cast(o_custkey as string), 9, '0')) as parcel_id,
  o_orderkey % 4 as card,
  cast(case when o_orderkey % 15 = 0 then null else 1900 + (o_orderkey * 31) % 125 end as string)
    as yrblt,
  cast(case when o_orderkey % 21 = 0 then null else 1950 + (o_orderkey * 7) % 75 end as string)
    as yreff
from orders
"""

BUILDING = """
select concat('0', lpad(cast(l_partkey as string), 9, '0')) as parcel_id,
  l_linenumber % 3 as card,
  cast(1900 + (l_orderkey * 17 + l_linenumber) % 125 as string) as yrblt,
  cast(case when l_orderkey % 10 = 0 then null else 1940 + (l_orderkey * 11) % 85 end as string)
    as yreff,
  case l_linenumber when 1 then '401' when 2 then '402' when 3 then '511' else '550' end as use_code,
  cast(l_quantity as integer) as unit_count
from lineitem
"""

# Rectangles of 5000 x 200 ft, four to a strip, offset so that no lot has its centroid
# on a border. A county is every seventh strip.
JURISDICTIONS = """
select s_suppkey as juris_id, concat('PLACE', cast(s_suppkey as string)) as placecombo,
  case strip % 7 when 0 then 'Franklin' when 1 then 'Delaware' when 2 then 'Licking'
    when 3 then 'Union' when 4 then 'Madison' when 5 then 'Pickaway' else 'Knox' end as county,
  strip,
  cast(1799990 as double) + 5000 * (s_suppkey % 4) as xmin,
  cast(1799990 as double) + 5000 * (s_suppkey % 4 + 1) as xmax,
  cast(699990 as double) + 200 * strip as ymin,
  cast(699990 as double) + 200 * (strip + 1) as ymax
from (select s_suppkey, (s_suppkey - s_suppkey % 4) / 4 as strip from supplier) q
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str, source: str, spread: bool = False) -> DataFrame:
    configure(spark)
    rows = table(spark, sf_dir, source)
    return spark.sql(
        sql.replace(f"from {source}", f"from {{{source}}}").replace(
            f"{source}.*", f"{{{source}}}.*"
        ),
        **{source: dealt(rows) if spread else rows},
    )


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a small file is one split, whatever its rows grow to
    return derived(spark, sf_dir, PARCELS, "customer", spread=True)


def ring_of_lot() -> list:
    x0, y0, w, h, cut = (F.col(c) for c in ("x0", "y0", "w", "h", "cut"))
    start = G.point(x0, y0)
    return [
        start,
        G.point(x0 + w, y0),
        G.point(x0 + w - cut, y0 + h),
        G.point(x0, y0 + h),
        start,
    ]


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = lots(spark, sf_dir)
    df = with_computed(df, geometry=G.polygon(G.ring(*ring_of_lot())))
    return with_srid(df, OHIO_SOUTH)


def _rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return G.polygon(G.ring(*[G.point(x, y) for x, y in corners]))


def lot_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, piece, geometry): the lot's w x h rectangle as a strip of 40 ft on the
    left and two pieces of different heights beside it."""
    df = lots(spark, sf_dir)
    x0, y0, w, h = (F.col(c) for c in ("x0", "y0", "w", "h"))
    pieces = [
        _rectangle(x0, y0, x0 + 40, y0 + h),
        _rectangle(x0 + 40, y0, x0 + w, y0 + 30),
        _rectangle(x0 + 40, y0 + 30, x0 + w, y0 + h),
    ]
    df = df.select("row_id", F.posexplode(F.array(*pieces)).alias("piece", "geometry"))
    return with_srid(df, OHIO_SOUTH)


# Two or three rectangles a lot: the lot, its neighbour (overlapping it, beside it or apart),
# and for every fifth lot one more inside the first.
OVERLAPPING = """
select row_id, piece, x0 + dx as xmin, y0 + dy as ymin, x0 + dx + width as xmax, y0 + dy + height as ymax
from (
  select row_id, x0, y0, 0 as piece, 0 as dx, 0 as dy, w as width, h as height from lots
  union all
  select row_id, x0, y0, 1, case row_id % 3 when 0 then w - 40 when 1 then w else w + 10 end, 20, 60, 50 from lots
  union all
  select row_id, x0, y0, 2, 10, 10, 30, 20 from lots where row_id % 5 = 0) q
"""

# Rectangles (sign -1: holes) of lots, of blocks of many sizes with a hole each, and of
# zones of twenty parts.
MIXED = """
select concat('lot', cast(row_id as string)) as id, 0 as part, 1 as sign,
  x0 as xmin, y0 as ymin, x0 + w as xmax, y0 + h as ymax from lots
union all
select id, 0, sign, x0 + inset, y0 + inset, x0 + side - inset, y0 + side - inset from (
  select concat('block', cast(s_suppkey as string)) as id, sign,
    cast(1800000 as double) + 200 * ((s_suppkey * 7) % 90) as x0,
    cast(700000 as double) + 200 * (s_suppkey % 11) as y0,
    100 * power(2, s_suppkey % 8) as side, case when sign > 0 then 0 else 30 end as inset
  from supplier cross join (values (1), (-1)) as signs(sign)) b
union all
select concat('zone', cast(n_nationkey as string)), part, 1,
  cast(1800000 as double) + 1000 * part + 30 * n_nationkey, cast(700000 as double),
  cast(1800000 as double) + 1000 * part + 30 * n_nationkey + 120, cast(700000 as double) + 400 * (n_nationkey + 1)
from nation cross join (values (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15), (16), (17), (18), (19)) as parts(part)
"""


def overlapping_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(OVERLAPPING.replace("from lots", "from {lots}"), lots=lots(spark, sf_dir))
    box = _rectangle(*[F.col(c).cast("double") for c in ("xmin", "ymin", "xmax", "ymax")])
    return with_srid(df.select("row_id", "piece", box.alias("geometry")), OHIO_SOUTH)


def mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, geometry): lots, holed blocks up to 128 times their size, and zones of parts."""
    tables = {t: table(spark, sf_dir, t) for t in ("supplier", "nation")} | {"lots": lots(spark, sf_dir)}
    sql = MIXED
    for t in tables:
        sql = sql.replace(f"from {t}", f"from {{{t}}}")
    df = spark.sql(sql, **tables)
    rings = F.transform(
        F.sort_array(F.collect_list(F.struct("part", -F.col("sign"), "box"))), lambda r: r["box"]
    )
    boxed = df.withColumn("box", _rectangle(*[F.col(c).cast("double") for c in ("xmin", "ymin", "xmax", "ymax")])[0][0])
    grouped = boxed.groupBy("id").agg(rings.alias("rings"), F.min("sign").alias("least"))
    # a hole stands in its outer ring's part, other rings are parts of their own
    shape = F.when(F.col("least") < 0, F.array("rings")).otherwise(F.transform("rings", lambda r: F.array(r)))
    return with_srid(grouped.select("id", shape.alias("geometry")), OHIO_SOUTH)


def turned_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, turn, geometry): each lot's ring as it is, and the other way round from
    another corner."""
    ring = ring_of_lot()
    other = [*ring[2::-1], ring[3], ring[2]]
    df = lots(spark, sf_dir)
    shapes = F.array(G.polygon(G.ring(*ring)), G.polygon(G.ring(*other)))
    df = df.select("row_id", F.posexplode(shapes).alias("turn", "geometry"))
    return with_srid(df, OHIO_SOUTH)


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, ADDRESSES, "orders")
    df = with_computed(df, point=G.point("x", "y")).drop("x", "y")
    return with_srid(df, OHIO_SOUTH, "point")


def dwelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, DWELLING, "orders")


def building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, BUILDING, "lineitem")


def jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, JURISDICTIONS, "supplier")
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax")]
    ring = G.ring(*[G.point(x, y) for x, y in [*corners, corners[0]]])
    df = with_computed(df, geometry=G.polygon(ring)).select(
        "juris_id",
        F.col("placecombo").alias("PLACECOMBO"),
        F.col("county").alias("COUNTY"),
        F.col("strip").cast("bigint").alias("strip"),
        "geometry",
    )
    return with_srid(df, OHIO_SOUTH)
