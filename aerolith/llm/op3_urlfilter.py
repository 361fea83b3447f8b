"""URL filter: host and path rules, then a blocked Bloom filter over listed URLs and an exact join.

All of it is DataFrame expressions.  The filter is a table with one row for each 256-bit block
(four longs); a listed URL's 64-bit hash picks the block and eight bits in it, so a lookup is one
join on the block number and four bit operations.  URLs that the filter passes go on to an
exact join on the canonical URL, which removes false positives; all others need no join
with the list at all.

The filter is broadcast only if its size, known from the number of listed URLs, is at most
``broadcast_bytes``; otherwise the page URLs join it by block through a shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is never listed; repeated rows are judged each; an empty list blocks nothing; an empty table
gives an empty result.  If rules of equal length fit, the one with the longer host wins, then block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import table, written

#: (host, path, verdict); fixed by the contract.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Labels that mark a host as one whose URLs are listed (the block list of the query is derived from `pages`).
LISTED_LABELS = ["casino", "bets", "poker", "pills", "xxx"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BITS_PER_KEY = 12
BLOCK_BITS = 256
BROADCAST_BYTES = 32 << 20


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host without ``www.``, path without trailing slashes, query without utm_ parameters, in order; null without ``://``."""
    h = F.regexp_replace(host(url), r"^www\.", "")
    p = F.regexp_replace(path(url), r"/+$", "")
    q = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(q, "&"), lambda x: (x != "") & ~x.startswith("utm_")))
    return F.when(F.instr(url, "://") > 0, F.concat(h, p, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def fits(h: Column, p: Column, rule: tuple[str, str, str]) -> Column:
    return ((h == rule[0]) | h.endswith("." + rule[0])) & p.startswith(rule[1])


def by_rules(h: Column, p: Column, rules: list[tuple[str, str, str]], pick) -> Column:
    """``pick(rule)`` of the longest rule that fits, else null."""
    order = sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"))
    return reduce(lambda rest, r: F.when(fits(h, p, r), F.lit(pick(r))).otherwise(rest), order, F.lit(None).cast("string"))


def _bits(key: Column, lane: int) -> Column:
    """Two of the lane's 64 bits, from 12 bits of a second hash."""
    second = F.xxhash64(key, F.lit(lane))
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, at).bitwiseAND(63).cast("int"))
    return one(7).bitwiseOR(one(23))


def blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def build_filter(listed: DataFrame, n_blocks: int) -> DataFrame:
    """__block, __w0 .. __w3: the blocked Bloom filter of the column ``canon``, bits or-ed before and after the shuffle."""
    key = F.col("canon")
    return (listed.select(_block(key, n_blocks).alias("__block"), *[_bits(key, i).alias(f"__w{i}") for i in range(4)])
            .groupBy("__block").agg(*[F.bit_or(f"__w{i}").alias(f"__w{i}") for i in range(4)]))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, host, path, rule, listed, verdict of every row of ``pages`` (page_id, url); ``listed``: column url."""
    keys = listed.select(canonical(F.col("url")).alias("canon")).where("canon is not null").distinct()
    keys = written(keys, "listed-urls")
    n_blocks = blocks_for(keys.count())
    bloom = build_filter(keys, n_blocks)
    if n_blocks * BLOCK_BITS // 8 <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    url = F.col("url")
    rows = pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("__canon"))
    h, p = F.col("host"), F.col("path")
    rows = rows.withColumn("rule", by_rules(h, p, rules, lambda r: r[0] + r[1])).withColumn(
        "__by_rule", by_rules(h, p, rules, lambda r: r[2]))
    key = F.col("__canon")
    possible = reduce(lambda a, b: a & b, [F.col(f"__w{i}").bitwiseAND(_bits(key, i)) == _bits(key, i) for i in range(4)])
    # Spread rows without a URL over the blocks: they are never listed.
    block = F.coalesce(_block(key, n_blocks), F.pmod(F.xxhash64("page_id"), F.lit(n_blocks)))
    passed = rows.join(bloom, block == F.col("__block"), "left").withColumn("__possible", F.coalesce(possible, F.lit(False)))
    columns = [*rows.columns, "__possible"]
    exact = keys.select(F.col("canon").alias("__listed"))
    hits = passed.where("__possible").select(*columns).join(exact, key == F.col("__listed"), "left").withColumn("listed", F.col("__listed").isNotNull())
    judged = hits.drop("__listed").unionByName(passed.where("not __possible").select(*columns).withColumn("listed", F.lit(False)))
    verdict = F.coalesce("__by_rule", F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "url", "host", "path", "rule", "listed", verdict.alias("verdict"))


def listed_urls(pages: DataFrame, labels: list[str] = LISTED_LABELS) -> DataFrame:
    """The URLs of ``pages`` with one of ``labels`` in their host: the block list that the query derives."""
    h = host(F.col("url"))
    return pages.select("url").where(reduce(lambda a, b: a | b, [h.contains(x) for x in labels]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, listed_urls(pages)).select("page_id", "host", "path", "rule", "listed", "verdict")


def _sql_fits(r):
    return f"((host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}'))"


def _sql_case(pick):
    order = sorted(RULES, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), reverse=True)
    return "CASE " + " ".join(f"WHEN {_sql_fits(r)} THEN '{pick(r)}'" for r in order) + " END"


SQL = rf"""
WITH a AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1, 's'), '&'),
      lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q
  FROM pages),
b AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
      regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canon
  FROM a),
l AS (SELECT DISTINCT canon FROM b WHERE canon IS NOT NULL AND ({' OR '.join(f"contains(host, '{x}')" for x in LISTED_LABELS)}))
SELECT page_id, host, path, {_sql_case(lambda r: r[0] + r[1])} AS rule,
  canon IS NOT NULL AND canon IN (SELECT canon FROM l) AS listed,
  coalesce({_sql_case(lambda r: r[2])},
    CASE WHEN canon IS NOT NULL AND canon IN (SELECT canon FROM l) THEN 'block' ELSE 'allow' END) AS verdict
FROM b
"""
