"""The SQL each query must agree with, for DuckDB over the same tables.

Lots are right trapezoids, so area, centroid and containment have formulas of their
own here, with nothing shared with the ring code that is tested.
"""

from __future__ import annotations

import math

from catalog import inputs as I
from catalog.queries import LINK, WINDOW, YEARS
from lotwise.plans.counties import FRANKLIN

# A lot's trapezoid: t is the length of its top edge.
LOT_AREA = "((2 * w - cut) * h / 2)"
LOT_CX = "(x0 + (w * w + w * (w - cut) + (w - cut) * (w - cut)) / (3 * (2 * w - cut)))"
LOT_CY = "(y0 + h * (w + 2 * (w - cut)) / (3 * (2 * w - cut)))"
ACRES = f"round({LOT_AREA} / 43560, 4)"


def feet(v: str) -> str:
    return f"round({v} + 0.00037, 3)"


def with_tables(*ctes: str) -> str:
    base = [
        f"fx_parcels as ({I.PARCELS})",
        f"fx_addr as ({I.ADDRESSES})",
        f"fx_dwelling as ({I.DWELLING})",
        f"fx_building as ({I.BUILDING})",
        f"fx_juris as ({I.JURISDICTIONS})",
        f"lots as (select *, {LOT_AREA} as area, {LOT_CX} as cx, {LOT_CY} as cy,"
        f" {ACRES} as acres from fx_parcels)",
        # one row per distinct shape, with the addresses on it, border included
        "shapes as (select distinct g, x0, y0, w, h, cut, area, cx, cy from lots)",
        """hits as (select s.g, a.addr_id, a.lsn from shapes s join fx_addr a
          on floor((a.x - 1800000) / 200) = floor((s.x0 - 1800000) / 200)
          and floor((a.y - 700000) / 200) = floor((s.y0 - 700000) / 200)
          and a.x >= s.x0 and a.y >= s.y0 and a.y <= s.y0 + s.h
          and (a.x - s.x0 - s.w) * s.h + s.cut * (a.y - s.y0) <= 0)""",
        "shape_units as (select g, count(lsn) as n from hits group by g)",
    ]
    return "with " + ",\n".join([*base, *ctes]) + "\n"


def per_id(source: str, key: str, name: str = "id_units") -> str:
    """Units per id: each row of the id brings the addresses on its shape."""
    return (
        f"{name} as (select {key} as id, cast(sum(n) as bigint) as units from {source}"
        f" join shape_units using (g) where {key} is not null group by {key})"
    )


def firsts(column: str, order: str = "row_id") -> str:
    return f"arg_min({column}, {order}) filter (where {column} is not null)"


def measures(prefix: str = "") -> str:
    return (
        f"round({prefix}area, 2) as area, {feet(prefix + 'cx')} as cx, {feet(prefix + 'cy')} as cy"
    )


TYPE = """case when class like '51%' or substr(class, 1, 3) in ('501', '502', '503', '504', '505')
  then case when {acres} > 0.75 then 'SF-LL' when {acres} <= 0.75 then 'SF-SL' end
  when substr(class, 1, 2) in ('52', '53', '54', '55') then 'SF-A'
  when substr(class, 1, 3) in ('401', '402', '403') then 'MF' end"""


def housing_type(acres: str) -> str:
    return TYPE.format(acres=acres)


# Words that start with a digit and hold only numbers in these tables.
YEAR = "try_cast(yrbuilt as double)"

# Merged parcels: the set of distinct shapes of an id, as text and as measures.
MERGED = """merged as (
  select {key} as id, {firsts}
    string_agg(distinct lpad(cast(g as string), 12, '0'), ',' order by lpad(cast(g as string), 12, '0'))
      as shape
  from {source} where {key} is not null group by {key}),
merged_shapes as (select distinct {key} as id, g from {source} where {key} is not null),
merged_measures as (
  select id, count(*) as parts, sum(area) as area, sum(area * cx) / sum(area) as cx,
    sum(area * cy) / sum(area) as cy
  from merged_shapes join shapes using (g) group by id),
merged_units as (
  select id, cast(sum(n) as bigint) as units from merged_shapes join shape_units using (g)
  group by id)"""


# --- projection in SQL --------------------------------------------------------------


def _num(v: float) -> str:
    return f"cast('{v!r}' as double)"


# Fixed values, nothing shared with the code that is tested. GRS80 (a = 6378137 m,
# 1/f = 298.257222101), the US survey foot, and the cone constants of EPSG 3735 (parallels
# 38 44' and 40 02', origin 38 N 82.5 W, easting 600000 m) and EPSG 5070 (29.5, 45.5, 23 N
# 96 W), worked out from these parameters in extended precision; and the series from the
# conformal to the geodetic latitude (Snyder 3-5).
AXIS, ECCENTRICITY, ECCENTRICITY_2 = 6378137.0, 0.08181919104281579, 0.006694380022900787
FOOT = 0.3048006096012192
SOUTH_N, SOUTH_AF, SOUTH_RHO0, SOUTH_EASTING, SOUTH_LON0 = (
    0.6345195367883056, 12478096.253413424, 7932869.037382869, 600000.0, -82.5,
)
ALBERS_N, ALBERS_C, ALBERS_RHO0, ALBERS_LON0 = 0.60290276906576, 1.3491820315609702, 9928937.004248783, -96.0
CONFORMAL = (0.0033565514853511422, 6.571872775293961e-06, 1.7645643646781633e-08, 5.3284785490533954e-11)


def project_ctes(corners: str) -> str:
    """From (row_id, corner, x, y) in Ohio South feet: degrees, and back to both planes."""
    e = _num(ECCENTRICITY)
    e2 = _num(ECCENTRICITY_2)
    series = " + ".join(f"{_num(c)} * sin({2 * i} * chi)" for i, c in enumerate(CONFORMAL, 1))
    rate = f"((1 - {e} * sin(phi)) / (1 + {e} * sin(phi)))"
    q = f"((1 - {e2}) * (sin(phi) / (1 - {e2} * sin(phi) * sin(phi)) - ln({rate}) / (2 * {e})))"
    return f"""
offsets as (select row_id, corner, x * {_num(FOOT)} - {_num(SOUTH_EASTING)} as dx,
  {_num(SOUTH_RHO0)} - y * {_num(FOOT)} as dy from {corners}),
chis as (select row_id, corner,
  {_num(math.pi / 2)} - 2 * atan(pow(sqrt(dx * dx + dy * dy) / {_num(SOUTH_AF)},
    {_num(1.0 / SOUTH_N)})) as chi,
  degrees(atan2(dx, dy) / {_num(SOUTH_N)}) + {_num(SOUTH_LON0)} as lon from offsets),
series as (select row_id, corner, lon, chi, sin(chi + {series}) as s from chis),
latitudes as (select row_id, corner, lon,
  degrees(2 * atan(tan({_num(math.pi / 4)} + chi / 2)
    * pow((1 + {e} * s) / (1 - {e} * s), {_num(ECCENTRICITY / 2)})) - {_num(math.pi / 2)}) as lat
  from series),
radian as (select row_id, corner, lon, lat, radians(lat) as phi from latitudes),
polar as (select row_id, corner, lon, lat,
  {_num(SOUTH_AF)} * pow(tan({_num(math.pi / 4)} - phi / 2)
    / pow({rate}, {_num(ECCENTRICITY / 2)}), {_num(SOUTH_N)}) as rho_s,
  {_num(SOUTH_N)} * (radians(lon) - {_num(math.radians(SOUTH_LON0))}) as theta_s,
  {_num(AXIS)} * sqrt({_num(ALBERS_C)} - {_num(ALBERS_N)} * {q}) / {_num(ALBERS_N)} as rho_a,
  {_num(ALBERS_N)} * (radians(lon) - {_num(math.radians(ALBERS_LON0))}) as theta_a from radian),
planes as (select row_id, corner, lon, lat,
  ({_num(SOUTH_EASTING)} + rho_s * sin(theta_s)) / {_num(FOOT)} as x_back,
  ({_num(SOUTH_RHO0)} - rho_s * cos(theta_s)) / {_num(FOOT)} as y_back,
  rho_a * sin(theta_a) as x_metres, {_num(ALBERS_RHO0)} - rho_a * cos(theta_a) as y_metres from polar)"""


CORNERS = """corners as (
  select row_id, 0 as corner, x0 as x, y0 as y from lots
  union all select row_id, 1, x0 + w, y0 from lots
  union all select row_id, 2, x0 + w - cut, y0 + h from lots
  union all select row_id, 3, x0, y0 + h from lots
  union all select row_id, 4, x0, y0 from lots)"""

# Shoelace over the projected corners, about the first one.
FLAT_ACRES = """flat as (
  select p.row_id, abs(sum((p.x_metres - o.x_metres) * (n.y_metres - o.y_metres)
    - (n.x_metres - o.x_metres) * (p.y_metres - o.y_metres))) / 2 * 0.0002471054 as calcacres
  from planes p join planes n on n.row_id = p.row_id and n.corner = p.corner + 1
  join planes o on o.row_id = p.row_id and o.corner = 0
  group by p.row_id)"""

REGION = f"""region_rows as (
  select l.parcelid as objectid, l.class, {YEAR} as yrbuilt, l.aprland + l.aprbldg as apprtot,
    case when {housing_type("calcacres")} in ('SF-SL', 'SF-LL') then 1 else u.units end as units,
    l.county, l.row_id, f.calcacres, {housing_type("calcacres")} as type,
    l.cx as x, l.cy as y, j.placecombo
  from lots l join flat f using (row_id)
  left join id_units u on u.id = l.parcelid
  join fx_juris j on l.cx >= j.xmin and l.cx <= j.xmax and l.cy >= j.ymin and l.cy <= j.ymax),
dense as (select *, units / nullif(calcacres, 0) as units_per_acre,
  apprtot / nullif(calcacres, 0) as valperacre from region_rows),
mapped as (select * from dense
  where units_per_acre is not null and county = 'franklin' and type is distinct from 'nan')"""


def region(select: str) -> str:
    return (
        with_tables(
            per_id("lots", "parcelid"), CORNERS, project_ctes("corners"), FLAT_ACRES, REGION
        )
        + select
    )


# --- profile --------------------------------------------------------------------------


def sample(table: str, column: str) -> str:
    """The ten values of lowest MD5, in its order, a missing value first."""
    return f"""(select string_agg(coalesce(v, 'None'), '; ' order by md5(v) nulls first)
    from (select distinct cast({column} as varchar) as v from {table}
      order by md5(v) nulls first limit 10) s)"""


def samples(table: str, columns: dict[str, bool]) -> str:
    return "\nunion all ".join(
        f"select '{c}' as column_name, {sample(table, c)} as column_sample" for c in columns
    )


def profile(table: str, columns: dict[str, bool]) -> str:
    """``columns``: name -> is it a number."""

    def share(n: str) -> str:
        # half to even, as the percent of a whole
        p = f"round_even({n} * 100.0 / count(*), 0)"
        text = f"concat(cast({n} as bigint), ' (', cast({p} as bigint), '%)')"
        return f"case when {text} = '0 (0%)' then '' else {text} end"

    def one(c: str, number: bool) -> str:
        zero_int = f"count(*) filter (where {c} = 0)" if number else "0"
        zero_chr = "0" if number else f"count(*) filter (where {c} = '0')"
        blank = "0" if number else f"count(*) filter (where {c} = ' ')"
        null = f"count(*) filter (where {c} is null)"
        return f"""select '{c}' as column_name,
  count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as unique_values,
  {share(blank)} as is_empty, {share(null)} as is_null,
  {share(zero_int)} as is_zero_int, {share(zero_chr)} as is_zero_chr,
  {sample(table, c)} as column_sample from {table}"""

    return "\nunion all ".join(one(c, number) for c, number in columns.items())


LINEITEM = {
    "l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True,
    "l_quantity": True, "l_extendedprice": True, "l_discount": True, "l_tax": True,
    "l_returnflag": False, "l_linestatus": False, "l_shipdate": None,
}
DOCUMENTS = {"doc_id": True, "text": False, "lang": False, "source": False, "n_chars": True}


def _profile_lineitem() -> str:
    # a date is neither number nor text: none of the zero and blank tests applies
    texts = {c: bool(n) for c, n in LINEITEM.items() if n is not None}
    dates = f"""select 'l_shipdate' as column_name,
  count(distinct l_shipdate) + max(case when l_shipdate is null then 1 else 0 end) as unique_values,
  '' as is_empty, '' as is_null, '' as is_zero_int, '' as is_zero_chr,
  {sample('lineitem', 'l_shipdate')} as column_sample from lineitem"""
    return profile("lineitem", texts) + "\nunion all " + dates


# --- queries --------------------------------------------------------------------------


def _collapsed(keys: str, first_id: bool, extra: str = "") -> str:
    group = "g" if keys == "geometry" else keys
    ids = f"{firsts('parcelid')} as parcelid" if first_id else "parcelid"
    return with_tables(
        f"""groups as (select {ids}, {firsts("class")} as class, {firsts("g")} as g,
          max({YEAR}) as yrbuilt, max(aprbldg) as aprbldg from lots group by {group})"""
    ) + f"select parcelid, class, yrbuilt, aprbldg, {measures()} from groups join shapes using (g)"


ALL_CARDS = """select parcel_id, card, yrblt, yreff from fx_dwelling
  union all select parcel_id, card, yrblt, yreff from fx_building"""
YEARS_OF_CARDS = f"""cards as ({ALL_CARDS}),
numbers as (select parcel_id, max(try_cast(yrblt as double)) as yrbuilt from cards
  group by parcel_id),
texts as (select parcel_id, max(yreff) as yreff from cards
  where yrblt is not null and yreff is not null and card is not null group by parcel_id)"""


def _county_rows(name: str, select: str, *ctes: str) -> tuple[str, str]:
    return f"county_{name}", with_tables(*ctes) + select


def _franklin() -> str:
    prefixes = " and ".join(f"not starts_with(id, '{p}')" for p in FRANKLIN.drop_prefixes)
    first = ", ".join(
        f"{firsts(c)} as {n}"
        for c, n in (("class", "class"), ("acres", "acres"), ("value", "apprtot"))
    )
    return (
        with_tables(
            f"""raw as (select * from (select concat(parcelid, '-00') as id, row_id, g, class, acres,
              aprland + aprbldg as value from lots) q where {prefixes})""",
            MERGED.format(key="id", source="raw", firsts=first + ","),
            f"""collapsed as (select shape, min(id) as id, {firsts("class", "id")} as class,
              max(acres) as acres, max(apprtot) as apprtot from merged group by shape)""",
            """years as (select concat(parcel_id, '-00') as id, max(try_cast(yrblt as double)) as yrbuilt
              from (select parcel_id, yrblt from fx_dwelling
                union all select parcel_id, yrblt from fx_building) q group by parcel_id)""",
        )
        + f"""select id as objectid, class, acres, apprtot, units, yrbuilt, {measures()}
        from collapsed join merged_measures using (id) left join merged_units using (id)
        left join years using (id)"""
    )


def _delaware() -> str:
    return (
        with_tables(
            per_id("lots", "parcelid"),
            f"""by_id as (select parcelid as id, {firsts("class")} as class,
              max(cast(1900 + row_id % 120 as bigint)) as yrbuilt, max(acres) as acres,
              {firsts("g")} as g, max(aprbldg) as apprtot from lots group by parcelid)""",
            f"""by_shape as (select g, min(id) as id, {firsts("class", "id")} as class,
              max(yrbuilt) as yrbuilt, max(acres) as acres, max(apprtot) as apprtot
              from by_id group by g)""",
        )
        + f"""select id as objectid, class, yrbuilt, acres, apprtot, units, {measures()}
        from by_shape join shapes using (g) left join id_units using (id)"""
    )


def _fairfield() -> str:
    return (
        with_tables(
            "raw as (select *, case when row_id % 10 = 0 then null else parcelid end as id from lots)",
            f"""by_shape as (select g, {firsts("id")} as id, {firsts("class")} as class,
              max({YEAR}) as yrbuilt, max(aprland + aprbldg) as apprtot
              from raw where id is not null group by g)""",
            per_id("by_shape", "id").replace("select id as id", "select id"),
        )
        + f"""select id as objectid, class, yrbuilt, apprtot, units, {measures()}
        from by_shape join shapes using (g) left join id_units using (id)"""
    )


def _plain(name: str, year: str) -> str:
    return (
        with_tables(per_id("lots", "parcelid"))
        + f"""select parcelid as objectid, class, acres, {year} as yrbuilt, aprbldg as apprtot, units,
        {measures()} from lots left join id_units on id = parcelid"""
    )


def _union() -> str:
    return (
        with_tables(
            "raw as (select *, coalesce(cast(try_cast(parcelid as bigint) as string), 'nan') as id"
            " from lots)",
            f"""by_shape as (select g, {firsts("id")} as id, {firsts("class")} as class,
              max({YEAR}) as yrbuilt, max(acres) as acres, max(aprbldg) as apprtot
              from raw group by g)""",
            "kept as (select * from by_shape where id <> 'nan')",
            per_id("kept", "id").replace("select id as id", "select id"),
        )
        + f"""select id as objectid, class, yrbuilt, acres, apprtot, units, {measures()}
        from kept join shapes using (g) left join id_units using (id)"""
    )


def _madison(land_use: str = "class") -> str:
    padded = "concat('0', lpad(cast(row_id as string), 9, '0'))"
    return (
        with_tables(
            MERGED.format(key="parcelid", source="lots", firsts=""),
            YEARS_OF_CARDS,
            f"""facts as (select {padded} as id, {land_use} as class,
              cast(floor(aprbldg) as bigint) + cast(floor(coalesce(aprland, 0)) as bigint) as apprtot,
              cast(cast(round(acres * 10000) as bigint) as string) as acres from lots)""",
            """joined as (select m.id, shape, class, acres, apprtot, yreff as yrbuilt, units
              from merged m left join facts using (id) left join texts on parcel_id = m.id
              left join merged_units using (id))""",
            """one as (select shape, class, acres, apprtot, yrbuilt, units, min(id) as id
              from joined group by all)""",
        )
        + f"""select id as objectid, class, acres, apprtot, yrbuilt, units, {measures()}
        from one join merged_measures using (id)"""
    )


def _knox() -> str:
    padded = "concat('0', lpad(cast(row_id as string), 9, '0'))"
    return (
        with_tables(
            per_id("lots", "parcelid"),
            """years as (select distinct parcel_id, yrblt from
              (select parcel_id, yrblt from fx_dwelling
               union all select parcel_id, yrblt from fx_building) q)""",
            f"""use as (select distinct {padded} as pin, class, acres from lots)""",
            """cama as (select pin, class, acres, yrblt from use left join years
              on parcel_id = pin)""",
            """joined as (select l.row_id, l.parcelid, l.g, c.class, c.acres,
              cast(c.yrblt as double) as yrbuilt, units
              from lots l join cama c on c.pin = l.parcelid
              left join id_units on id = l.parcelid where c.class is not null)""",
            """one as (select arg_min(parcelid, row_id) as id, g, class, acres, yrbuilt, units
              from joined group by g, class, acres, yrbuilt, units)""",
        )
        + f"""select id as objectid, class, acres, yrbuilt, units, {housing_type("acres")} as type,
        {feet("cx")} as x, {feet("cy")} as y from one join shapes using (g)"""
    )


def _logan() -> str:
    return (
        with_tables(
            "raw as (select *, case row_id % 10 when 0 then ' ' when 5 then null else parcelid end"
            " as id from lots)",
            per_id("raw", "id").replace("select id as id", "select id"),
            f"cards as ({ALL_CARDS})",
            "years as (select parcel_id, max(try_cast(yreff as double)) as y from cards"
            " group by parcel_id)",
        )
        + f"""select r.id as objectid, class, cast(acres as string) as acres, units, y as yrbuilt,
        {feet("cx")} as x, {feet("cy")} as y, {housing_type("acres")} as type
        from raw r left join id_units u on u.id = r.id left join years on parcel_id = r.id
        where r.id is distinct from ' '"""
    )


def _morrow() -> str:
    return (
        with_tables(
            """cards as (select parcel_id, '510' as use_code, yrblt from fx_dwelling
              union all select parcel_id, use_code, yrblt from fx_building)"""
        )
        + f"""select parcel_id as property, acres, use_code as land_use, yrblt as year_built,
        'Morrow' as county, {measures()} from cards join lots on parcelid = parcel_id
        where yrblt is not null and use_code is not null"""
    )


ORACLE: dict[str, str] = {
    "units_per_parcel": with_tables()
    + "select row_id, n as units from lots join shape_units using (g)",
    "units_mixed_shapes": with_tables(
        f"mixed as ({I.MIXED})",
        """inside as (select m.id, a.addr_id, a.lsn, sum(m.sign) as s from mixed m join fx_addr a
          on a.x >= m.xmin and a.x <= m.xmax and a.y >= m.ymin and a.y <= m.ymax group by all)""",
    )
    + "select id, count(lsn) as units from inside where s > 0 group by id",
    "address_parcel_pairs": with_tables()
    + "select row_id, addr_id, lsn from lots join hits using (g)",
    "units_across_systems": with_tables(
        """moved as (select s.g, count(a.lsn) as n from shapes s join fx_addr a
          on floor((a.x - 1800000) / 200) = floor((s.x0 - 1800000) / 200)
          and floor((a.y - 700000) / 200) = floor((s.y0 - 700000) / 200)
          and a.x + 0.123 >= s.x0 and a.y >= s.y0 and a.y <= s.y0 + s.h
          and (a.x + 0.123 - s.x0 - s.w) * s.h + s.cut * (a.y - s.y0) <= 0 group by s.g)"""
    )
    + "select row_id, n as units from lots join moved using (g)",
    "units_left_join": with_tables(per_id("lots", "parcelid"))
    + "select row_id, parcelid, units from lots left join id_units on id = parcelid",
    "jurisdiction_of_parcel": with_tables()
    + """select row_id, placecombo from lots join fx_juris
      on cx >= xmin and cx <= xmax and cy >= ymin and cy <= ymax""",
    "jurisdiction_subset": with_tables()
    + """select juris_id, placecombo, county, cast(strip as bigint) as strip from fx_juris
      where county in ('Franklin', 'Delaware', 'Licking', 'Union', 'Madison', 'Pickaway',
        'Fairfield')""",
    "dedupe_geometry": _collapsed("geometry", True),
    "dedupe_parcel_id": _collapsed("parcelid", False),
    "dedupe_id_geometry": _collapsed("parcelid, g", False),
    "distinct_but_key": with_tables(
        "one as (select min(row_id) as row_id, class, county, yrhist, g from lots"
        " group by class, county, yrhist, g)"
    )
    + f"select row_id, class, county, yrhist, {measures()} from one join shapes using (g)",
    "housing_type": with_tables()
    + f"""select row_id, {housing_type("area / 43560")} as type, round(area / 43560, 6) as acres
      from lots""",
    "single_family_units": with_tables()
    + f"""select row_id, type, case when type in ('SF-LL', 'SF-SL') then 1 else n end as units
      from (select row_id, {housing_type("area / 43560")} as type, g from lots) q
      left join shape_units using (g)""",
    "drop_non_parcels": with_tables()
    + """select row_id, concat(parcelid, '-00') as parcelid from lots
      where not regexp_matches(parcelid, '^(VNP|OUT|W|w|R|r)')""",
    "year_from_history": with_tables()
    + "select row_id, string_split(yrhist, '|')[-1] as yrbuilt from lots",
    "numeric_clean": with_tables()
    + f"""select row_id, {YEAR} as year_number, aprbldg as value_number, row_id as id_number,
      cast(try_cast(parcelid as bigint) as string) as id_text from lots""",
    "keep_null_filter": with_tables()
    + """select row_id, class, yrhist from lots
      where class is distinct from ' ' and yrhist is not null and county <> 'knox'""",
    "complete_rows": with_tables()
    + """select row_id, class, yrbuilt, aprland from lots
      where class is not null and yrbuilt is not null and aprland is not null""",
    "id_digits": """select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as digits,
      cast(regexp_extract(c_name, '[0-9]+') as bigint) as number,
      cast(c_nationkey as string) as nation,
      concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) as segment,
      concat(c_name, '/', c_nationkey) as path, c_name as base, c_mktsegment as folder,
      'zip' as ext, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as replaced,
      string_split(c_name, '#')[1] as word from customer""",
    "fallback_year": with_tables()
    + "select parcel_id, card, coalesce(yreff, yrblt) as year from fx_dwelling",
    "cama_max_year": with_tables(YEARS_OF_CARDS) + "select parcel_id, yrbuilt from numbers",
    "cama_text_max_year": with_tables(YEARS_OF_CARDS)
    + "select parcel_id, yreff as yrbuilt from texts",
    "cama_many_join": with_tables(YEARS_OF_CARDS)
    + """select min(parcelid) as parcelid, class, county, n.yrbuilt, yreff
      from lots left join numbers n on n.parcel_id = parcelid
      left join texts t on t.parcel_id = parcelid group by class, county, n.yrbuilt, yreff""",
    "cama_inner_complete": with_tables()
    + """select parcel_id, card, yrblt, yreff, class, aprland, 'Morrow' as county
      from fx_dwelling join lots on parcelid = parcel_id
      where card is not null and yrblt is not null and yreff is not null and class is not null
        and aprland is not null""",
    "cards_per_parcel": with_tables()
    + "select parcel_id, count(yrblt) as n_cards from fx_dwelling group by parcel_id",
    "parcel_area_acres": with_tables()
    + "select row_id, round(area / 43560, 6) as acres from lots",
    "centroids": with_tables()
    + f"""select row_id, {feet("cx")} as cx, {feet("cy")} as cy, true as inside, true as valid,
      x0 as xmin, y0 as ymin, x0 + w as xmax, y0 + h as ymax from lots""",
    "reproject": with_tables(CORNERS, project_ctes("corners"))
    + f"""select row_id, corner, round(lon, 9) as lon, round(lat, 9) as lat,
      {feet("x_back")} as x_back, {feet("y_back")} as y_back,
      round(x_metres, 4) as x_metres, round(y_metres, 4) as y_metres from planes""",
    "dissolve_jurisdictions": with_tables()
    + f"""select county, round(sum((xmax - xmin) * (ymax - ymin)), 2) as area,
      cast(count(distinct strip) as integer) as parts,
      {feet("avg((xmin + xmax) / 2)")} as cx, {feet("avg((ymin + ymax) / 2)")} as cy
      from fx_juris group by county""",
    # a strip of four rectangles loses its three inner edges, each of which ran twice
    "dissolve_border_area": with_tables()
    + """select county, round(sum((xmax - xmin) * (ymax - ymin)), 2) as area,
      4 * count(*) - 2 * (count(*) - count(distinct strip)) as n_edges from fx_juris
      group by county""",
    "dissolve_parcels": with_tables(
        f"""one as (select g, {firsts("parcelid")} as parcelid, {firsts("class")} as class,
          min(row_id) as row_id from lots group by g)"""
    )
    + f"""select parcelid, {firsts("class")} as class, round(sum(area), 2) as area,
      cast(count(*) as integer) as parts from one join shapes using (g) group by parcelid""",
    "dissolve_tjunctions": with_tables()
    + """select row_id, round(cast(w * h as double), 2) as area, 1 as parts from lots""",
    "dissolve_repeats": with_tables()
    + """select row_id, round(area, 2) as area, 1 as parts from lots""",
    # the second piece lies 40 x 50 ft over the lot, beside it, or 10 ft off; the third inside
    "dissolve_overlaps": with_tables()
    + """select row_id, round(cast(w * h as double) + case row_id % 3 when 0 then 1000 else 3000 end, 2) as area,
      case row_id % 3 when 2 then 2 else 1 end as parts, row_id % 3 = 0 or row_id % 5 = 0 as overlaps from lots""",
    "covered_area": with_tables()
    + """select row_id, round(cast(w * h as double) + case row_id % 3 when 0 then 1000 else 3000 end, 2) as area,
      round(cast(w * h as double) + 3000 + case row_id % 5 when 0 then 600 else 0 end, 2) as summed,
      row_id % 3 = 0 or row_id % 5 = 0 as overlaps from lots""",
    "dissolve_many_parts": with_tables(
        f"""one as (select g, {firsts("county")} as county from lots group by g),
        county_units as (select county, cast(sum(n) as bigint) as units
          from one join shape_units using (g) group by county)"""
    )
    + """select county, round(sum(area), 2) as area, cast(count(*) as integer) as parts, units
      from one join shapes using (g) left join county_units using (county)
      group by county, units""",
    "region_union": with_tables()
    + """select parcelid as objectid, class, row_id, county,
      case when county = 'fairfield' then null else acres end as acres from lots""",
    "region_table": region(
        f"""select objectid, class, yrbuilt, round(apprtot, 2) as apprtot, units, county, row_id,
        round(calcacres, 6) as calcacres, type, {feet("x")} as x, {feet("y")} as y, placecombo
        from region_rows"""
    ),
    "density": region(
        """select row_id, round(units_per_acre, 5) as units_per_acre,
        round(valperacre, 1) as valperacre from dense"""
    ),
    "units_by_county_year": region(
        """select county, yrbuilt, cast(coalesce(sum(units), 0) as bigint) as units
        from region_rows where yrbuilt >= 1965 group by county, yrbuilt"""
    ),
    "summary_from_files": region(
        """select county, yrbuilt, cast(coalesce(sum(units), 0) as bigint) as units
        from region_rows where yrbuilt >= 1965 group by county, yrbuilt"""
    ),
    "units_by_type_year": region(
        """select type, yrbuilt, cast(coalesce(sum(units), 0) as bigint) as units
        from region_rows where yrbuilt >= 1965 and type is not null group by type, yrbuilt"""
    ),
    "parcels_by_county_year_pivot": region(
        "select county, "
        + ", ".join(
            f"nullif(count(*) filter (where yrbuilt = {y}), 0) as y{y}" for y in YEARS
        )
        + " from region_rows where yrbuilt >= 2010 group by county"
    ),
    "type_map_rows": region(
        f"""select {feet("x")} as x, {feet("y")} as y, units, type from region_rows
        where yrbuilt >= 2020 and type is distinct from 'nan'"""
    ),
    "choropleth_rows": region(
        "select row_id, type, round(units_per_acre, 5) as units_per_acre from mapped"
    ),
    "choropleth_jurisdictions": region(
        """select juris_id, placecombo, county, cast(strip as bigint) as strip from fx_juris
        where county = 'Franklin' and exists (select 1 from mapped)"""
    ),
    "units_per_acre_histogram": region(
        """select bin, round(any_value(low) + bin * any_value(width), 5) as bin_start, count(*) as n
        from (select cast(least(floor((units_per_acre - low) / width), 29) as integer) as bin,
            low, width
          from mapped, (select min(units_per_acre) as low,
            (max(units_per_acre) - min(units_per_acre)) / 30 as width from mapped) r) q
        group by bin"""
    ),
    "column_profile": _profile_lineitem(),
    "column_samples": samples("lineitem", LINEITEM),
    "column_profile_documents": profile("documents", DOCUMENTS),
    "listing_links": f"""select page_id, cast(len(links) as integer) as n_links, links[-1] as last_link,
      list_filter(links, lambda l: contains(l, 'a'))[-1] as last_with_a
      from (select page_id, regexp_extract_all(html, '{LINK}', 1) as links from pages) q""",
    "page_plan": with_tables()
    + """select county, 3735 as srid, 'id,' || county as fields,
      unnest(generate_series(0, n - 1, 50)) as "offset"
      from (select county, count(*) as n from lots group by county) q""",
    "service_pages": with_tables() + "select addr_id, lsn, x, y from fx_addr",
    "esri_pages": with_tables()
    + """select 'polygon' as kind, row_id as id, round(area, 2) as area, x0 as x, y0 as y from lots
      union all select 'point', addr_id, null, x, y from fx_addr""",
    "archive_tables": with_tables()
    + """select kind, parcel_id, cast(card as string) as card, yrblt, count(*) as n
      from fx_dwelling, (values ('txt'), ('csv'), ('xml'), ('xlsx')) k(kind)
      group by kind, parcel_id, card, yrblt""",
    "archive_entries": """select * from (values ('cards.txt', 'cards.txt', 'txt'),
      ('tables/cards.csv', 'cards.csv', 'csv'), ('cards.xml', 'cards.xml', 'xml'),
      ('cards.xlsx', 'cards.xlsx', 'xlsx'))
      t(entry, name, extension) where exists (select 1 from orders)""",
    "text_tables": with_tables()
    + """select kind, parcel_id, cast(card as string) as card, yrblt, yreff, count(*) as n
      from fx_building, (values ('pipe'), ('comma'), ('xml')) k(kind)
      group by kind, parcel_id, card, yrblt, yreff""",
    "geojson_roundtrip": with_tables()
    + f"select row_id, parcelid, class, {measures()} from lots",
    "geojson_collection": with_tables()
    + f"select row_id, parcelid, class, {measures()} from lots",
    "quoted_line_breaks": """select cast(doc_id as varchar) as doc_id, lang, md5(text) as text_md5,
      cast(length(text) as integer) as n_chars
      from (select doc_id, nullif(lang, '') as lang, nullif(text, '') as text from documents) q""",
    "layer_window": with_tables()
    + f"""select row_id, class, {measures()} from lots where x0 <= {WINDOW[2]} and x0 + w >= {WINDOW[0]}
      and y0 <= {WINDOW[3]} and y0 + h >= {WINDOW[1]}""",
    "table_write_append": with_tables()
    + """select row_id, parcelid, county, cast(1 as bigint) as n from lots
      where county in ('franklin', 'union')
      union all select row_id, parcelid, 'appended', 2 from lots""",
    "county_franklin": _franklin(),
    "county_delaware": _delaware(),
    "county_fairfield": _fairfield(),
    "county_licking": _plain("licking", "yrbuilt"),
    "county_pickaway": _plain("pickaway", "string_split(yrhist, '|')[-1]"),
    "county_union": _union(),
    "county_madison": _madison(),
    "county_knox": _knox(),
    "county_logan": _logan(),
    "county_morrow": _morrow(),
    "county_madison_from_files": f"""select objectid, class, cast(apprtot as double) as apprtot,
      try_cast(acres as double) as acres, try_cast(yrbuilt as double) as yrbuilt, units, area, cx, cy
      from ({_madison("nullif(trim(class), '')")}) q""",
    "county_knox_from_files": f"select objectid, class, acres, units, type, x, y from ({_knox()}) q",
    "county_morrow_from_files": _morrow(),
    "apartment_buildings": with_tables()
    + """select distinct parcel_id as propertynumber, use_code as usecode,
      cast(unit_count as double) as unitcount from fx_building where starts_with(use_code, '40')""",
    "cards_per_property": with_tables()
    + """select parcel_id as propertynumber, count(card) as cardnumber from fx_dwelling
      group by parcel_id""",
}
