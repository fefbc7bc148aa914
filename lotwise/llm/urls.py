"""URL filter: rules by host and path, and a list of canonical URLs behind a blocked
Bloom filter.

The filter is a table of blocks of 256 bits, four words of 64. A URL's hash names its
block, and in each word of it two bits. Building is one grouping by block, whose partial
bitwise ors run before the shuffle. Probing is an equi-join by block; what passes is
possible, and only that meets the list itself in an exact join, which removes false
positives. The filter, the list and the probed pages are tables in the shared folder, so
both sides of each join are dealt out anew and adaptive execution may split hot keys or
broadcast a side that its measured size allows.

A canonical URL is the host, without a leading ``www.``, and the path without slashes at
its end; scheme, query and fragment are dropped.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits no rule
and is on no list; it is allowed. An empty list allows whatever no rule blocks. Repeated
rows are judged each on its own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import durable

BITS_PER_URL = 16
BLOCK_BITS = 256
WORDS = 4

# Fixed values of the contract: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Host labels whose pages are put on the list.
LISTED_LABELS = ("ads-track", "adult-x", "cheap-pills", "free-bets", "spam-farm")

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Null without a host."""
    whole = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))
    return F.when(host != "", whole)


def rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, where, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(start)
        name = F.when(fits, F.lit(where + start)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def listed(pages: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """Distinct canonical URLs of pages whose host has one of the labels."""
    h, p = host(F.col("url")), path(F.col("url"))
    own = F.exists(F.split(h, r"\."), lambda x: x.isin(*labels))
    return pages.where(own).select(canonical(h, p).alias("canonical")).distinct()


def block_of(canonical: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(canonical), F.lit(blocks))


def masks(canonical: Column) -> list[Column]:
    """Per word of the block, the bits that the URL sets."""
    out = []
    for j in range(WORDS):
        h = F.xxhash64(canonical, F.lit(j + 1))
        bit = [F.call_function("shiftleft", F.lit(1).cast("long"), x) for x in places(h)]
        out.append(bit[0].bitwiseOR(bit[1]))
    return out


def places(h: Column) -> list[Column]:
    return [
        h.bitwiseAND(F.lit(63)).cast("int"),
        F.shiftright(h, 6).bitwiseAND(F.lit(63)).cast("int"),
    ]


def bloom(urls: DataFrame, blocks: int) -> DataFrame:
    """block, w0 to w3: the blocks that hold any URL."""
    marked = urls.select(
        block_of(F.col("canonical"), blocks).alias("block"),
        *(m.alias(f"w{j}") for j, m in enumerate(masks(F.col("canonical")))),
    )
    return marked.groupBy("block").agg(*(F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)))


def judge(pages: DataFrame, urls: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; ``urls`` holds ``canonical``."""
    urls = durable(urls.select("canonical").where("canonical is not null").distinct(), "urls")
    blocks = max(1, -(-urls.count() * BITS_PER_URL // BLOCK_BITS))
    bits = durable(bloom(urls, blocks), "bloom")

    own = pages.select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")
    )
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    own = own.withColumn("canonical", canonical(F.col("host"), F.col("path"))).select(
        "*",
        name.alias("rule"),
        verdict.alias("says"),
        # nothing to look up where a rule has decided
        F.when(verdict.isNull(), block_of(F.col("canonical"), blocks)).alias("block"),
    )
    asked, settled = own.where("block is not null"), own.where("block is null")
    hit = None
    for j, m in enumerate(masks(F.col("canonical"))):
        held = F.col(f"w{j}").bitwiseAND(m) == m
        hit = held if hit is None else hit & held
    probed = asked.join(bits, "block", "left").select(
        "page_id", "host", "path", "rule", "canonical", F.coalesce(hit, F.lit(False)).alias("possible")
    )
    probed = durable(probed, "probed")
    columns = [F.col(c) for c in ("page_id", "host", "path", "rule")]
    exact = probed.where("possible").join(
        urls.withColumn("listed", F.lit(True)), "canonical", "left"
    )
    return (
        settled.select(*columns, F.coalesce("says", F.lit("allow")).alias("verdict"))
        .unionByName(probed.where("not possible").select(*columns, F.lit("allow").alias("verdict")))
        .unionByName(
            exact.select(
                *columns, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict")
            )
        )
    )


SQL = f"""
with own as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
ruled as (
  select *,
    case when host <> '' then
      regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') end as canonical,
    case when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/')
        then 'example.net/en/'
      when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/')
        then 'example.com/de/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
      when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/'
    end as rule
  from own),
listed as (
  select distinct canonical from ruled
  where list_has_any(string_split(host, '.'), {list(LISTED_LABELS)}))
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block'
    when rule is not null then 'allow'
    when canonical in (select canonical from listed) then 'block'
    else 'allow' end as verdict
from ruled
"""
