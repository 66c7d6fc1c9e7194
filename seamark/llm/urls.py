"""URL filter: longest-prefix host and path rules, and a list of blocked canonical URLs.

The list is first written as a blocked Bloom filter: a table of 256-bit blocks (four 64-bit words),
one bit a word for each URL, about 2.5 bytes a URL. Pages meet it by block number; only possible
hits go on with their URL to an exact hash join with the list, which removes false positives; all other
pages pass it by. A filter of up to ``FILTER_BYTES``, known from the number of its blocks, is broadcast, so that no page is
shuffled for it; a larger one, and the list, meet pages in joins for which Spark shuffles or not by measured sizes.

A null url, or one without "://", has an empty host and path, fits no rule and is allowed. Repeated
rows are judged each. Empty inputs give no rows or block nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.llm.licenses import LOWER, UPPER
from seamark.llm.storage import materialize

#: (host, start of path, verdict)
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
URLS_PER_BLOCK = 16
WORDS = 4
#: Bytes of a filter that each executor may hold, and of one of its blocks as a row: about 7 million URLs.
FILTER_BYTES, BLOCK_BYTES = 64 << 20, 16 + 16 * (WORDS + 1) + 48


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without "www." or "m.", and path without slashes at its end; null without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""), F.regexp_replace(path, "/+$", "")))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The text and verdict of the longest rule that fits, or null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text, verdict = F.when(fits, rule_host + rule_path).otherwise(text), F.when(fits, rule_verdict).otherwise(verdict)
    return text, verdict


def bit(word: int) -> Column:
    """The bit that a URL sets in a word of its block."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {6 * word}) & 63 as int))")


def bloom_blocks(listed: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of the filter of the column ``canon``, and the number of blocks."""
    number = max(1, -(-listed.count() // URLS_PER_BLOCK))
    hashed = listed.select(F.pmod(F.xxhash64("canon"), F.lit(number)).alias("block"), F.xxhash64("canon", F.lit(1)).alias("hash"))
    return hashed.groupBy("block").agg(*[F.bit_or(bit(w)).alias(f"word{w}") for w in range(WORDS)]), number


def filter_urls(pages: DataFrame, blocklist: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, possible (by the filter) and listed (by the list).

    ``blocklist`` has a column ``canon`` of canonical URLs.
    """
    listed = blocklist.select("canon").where("canon is not null").distinct()
    blocks, number = bloom_blocks(listed)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = parts.withColumn("canon", canonical(F.col("host"), F.col("path")))
    keyed = urls.withColumn("block", F.pmod(F.xxhash64(F.coalesce("canon", F.col("page_id").cast("string"))), F.lit(number)))
    blocks = F.broadcast(blocks) if number * BLOCK_BYTES <= FILTER_BYTES else blocks
    met = keyed.join(blocks, "block", "left").withColumn("hash", F.xxhash64("canon", F.lit(1)))
    all_set = F.col("canon").isNotNull()
    for w in range(WORDS):
        all_set = all_set & (F.col(f"word{w}").bitwiseAND(bit(w)) != 0)
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    told = met.select("page_id", "host", "path", text.alias("rule"), verdict.alias("ruled"), "canon", F.coalesce(all_set, F.lit(False)).alias("possible"))
    told = materialize(told, "pages")
    # only possible hits meet the list
    hits = told.where("possible").join(listed.select("canon", F.lit(True).alias("in_list")), "canon", "left")
    columns = ["page_id", "host", "path", "rule", "ruled", "possible"]
    judged = hits.select(*columns, F.coalesce("in_list", F.lit(False)).alias("listed")).union(told.where("not possible").select(*columns, F.lit(False)))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "possible", "listed")


#: Titles full of symbols; the pages that have them make up the list of the registered query.
JUNK_TITLE = r"<title>[^<]*(?:%%%|###|\*\*\*|\$\$\$)"


def junk_urls(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    return pages.where(F.rlike("html", F.lit(JUNK_TITLE))).select(canonical(host_of(url), path_of(url)).alias("canon"))


def url_sql() -> str:
    rule = """case
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/7') then 'allow example.com/en/7'
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/de/8') then 'block example.net/de/8'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/en/') then 'block com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/de/') then 'allow net/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/es/') then 'block org/es/' end"""
    return rf"""
with parts as (
  select page_id, html, translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') as host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') as path from pages),
canon as (
  select *, case when host <> '' then regexp_replace(host, '^(?:www|m)\.', '') || regexp_replace(path, '/+$', '') end as canon from parts),
listed as (select distinct canon as listed_canon from canon where regexp_matches(html, '{JUNK_TITLE}') and canon is not null),
judged as (
  select page_id, host, path, {rule} as found, substr(found, 7) as rule, substr(found, 1, 5) as ruled, listed_canon is not null as listed
  from canon left join listed on canon = listed_canon)
select page_id, host, path, rule, coalesce(ruled, case when listed then 'block' else 'allow' end) as verdict, listed from judged
"""
