"""Line dedup by the number of distinct sites that a line is found on.

Lines of at least ``LEAST_WORDS`` words are known by a hash of the trimmed line. A
HyperLogLog sketch of the sites per line hash is built in the map tasks and merged by
the grouping, so a line that a third of all rows holds arrives as one sketch a task.
Lines whose estimate is clear of the threshold are decided by it; for those near it the
distinct sites are counted exactly. A line on ``SITES`` sites or more is boilerplate:
its first occurrence (lowest doc_id, then line) stays, so that nothing disappears from
the corpus, and all others are removed.

Only line hashes, sites and places are shuffled to find the lines; texts move once, to
meet the places that leave them.

Edge cases: a null text stays null and has no lines; a null site counts as one site of
its own; null or repeated ids are no harm, as a row is known by the hash of its id and
text: rows equal in both lose the same lines; empty lines and line order stay; an empty
table gives an empty one; other columns are kept where ``cleaned`` is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import durable

SITES = 8
LEAST_WORDS = 4
LG_K = 11

BLANKS = r"[\x20\x09-\x0D]"
WORDED = rf"(?s)^{BLANKS}*([^\x20\x09-\x0D]+{BLANKS}+){{{LEAST_WORDS - 1}}}[^\x20\x09-\x0D]"


def margin(sites: int, lg_k: int = LG_K) -> int:
    """How far from the threshold an estimate may err: three standard errors, 2 at least."""
    return max(2, int(3 * 1.04 / (2**lg_k) ** 0.5 * sites + 1))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def lines_of(documents: DataFrame) -> DataFrame:
    """doc_id, row, site, place, line hash of every line with enough words."""
    site = F.coalesce(F.col("source").cast("string"), F.lit("\x00"))
    rows = documents.select(
        F.col("doc_id"),
        row_key().alias("row"),
        site.alias("site"),
        F.posexplode(F.split("text", "\n")).alias("place", "line"),
    )
    trimmed = F.regexp_replace("line", rf"^{BLANKS}+|{BLANKS}+$", "")
    return rows.where(F.col("line").rlike(WORDED)).select(
        "doc_id", "row", "site", "place", F.xxhash64(trimmed).alias("line")
    )


def boilerplate(lines: DataFrame, sites: int = SITES, lg_k: int = LG_K) -> DataFrame:
    """line, first: the lines on ``sites`` sites or more and their first occurrence."""
    near = margin(sites, lg_k)
    spread = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"),
        F.min(F.struct("doc_id", "row", "place")).alias("first"),
    )
    spread = spread.select("line", "first", F.hll_sketch_estimate("sketch").alias("estimate"))
    spread = durable(spread.where(F.col("estimate") >= sites - near), "spread")
    unsure = F.col("estimate") <= sites + near
    exact = (
        lines.join(spread.where(unsure).select("line"), "line", "left_semi")
        .groupBy("line", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("line")
        .agg(F.count("one").alias("sites"))
        .where(F.col("sites") >= sites)
    )
    sure = spread.where(~unsure).select("line", "first")
    return sure.unionByName(spread.join(exact.select("line"), "line", "left_semi").select("line", "first"))


def cleaned(documents: DataFrame, sites: int = SITES) -> DataFrame:
    """The documents, ``text`` without the lines removed, ``n_lines`` and ``n_removed``."""
    lines = lines_of(documents)
    found = durable(boilerplate(lines, sites), "boilerplate")
    places = (
        lines.join(found, "line")
        .where(~F.struct("doc_id", "row", "place").eqNullSafe(F.col("first")))
        .groupBy("row")
        .agg(F.collect_set("place").alias("leaving"))
    )
    places = durable(places, "places")
    split = F.split("text", "\n")
    stay = F.filter(split, lambda x, i: ~F.array_contains("leaving", i))
    columns = [F.col(f"d.{c}") for c in documents.columns if c != "text"]
    joined = documents.withColumn("__row", row_key()).alias("d").join(
        # dealt out by row at every size: the places grow with the documents
        places.withColumnRenamed("row", "__row").hint("merge"), "__row", "left"
    )
    text = F.when(F.col("leaving").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    return joined.select(
        *columns,
        text.alias("text"),
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("leaving"), F.lit(0)).cast("long").alias("n_removed"),
    )


def report(documents: DataFrame, sites: int = SITES) -> DataFrame:
    out = cleaned(documents.select("doc_id", "source", "text"), sites)
    return out.select("doc_id", "n_lines", "n_removed", "text")


CTES = rf"""
numbered as (
  select doc_id, text, coalesce(cast(source as varchar), '<none>') as site,
    unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as place
  from {{documents}}),
worded as (
  select doc_id, text, site, place,
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as line
  from numbered
  where regexp_matches(line,
    '^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{{{{LEAST_WORDS - 1}}}}}[^\x20\x09-\x0D]')),
boilerplate as (
  select line, min(row(doc_id, place)) as first
  from worded group by line having count(distinct site) >= {SITES}),
leaving as (
  select doc_id, list(place) as places
  from worded join boilerplate using (line)
  where row(doc_id, place) <> first
  group by doc_id),
"""
SQL = f"""
with {CTES.format(documents="documents")}
split as (
  select doc_id, text, string_split(text, chr(10)) as lines, places
  from documents left join leaving using (doc_id))
select doc_id, coalesce(len(lines), 0) as n_lines, coalesce(len(places), 0) as n_removed,
  case when places is null then text else array_to_string(
    list_filter(lines, lambda x, i: not list_contains(places, i - 1)), chr(10)) end as text
from split
"""
