"""Sharding by extendible hashing.

A document's hash is 60 bits of the MD5 of its identifier and text.  The directory is indexed by
hash-prefix bits: a bucket is a prefix; only a bucket whose documents exceed ``limit`` bytes is split
on one more bit, until every bucket fits.  So a document's shard is its shortest prefix whose bucket
fits the limit.

The directory is built top down, ``STEP`` bits at a time: bytes are pre-aggregated by prefix (a
partial aggregate, so a hot prefix costs each task one row), the totals of all shorter prefixes
come from these cells, and only the documents of cells that are still too large go on to the next bits.
The directory is a DataFrame; the driver sees one number a round.

A bucket that splitting cannot help, as all its rows have one hash (a document larger than the limit,
or repeated rows), is a chain of pages: rows are numbered within the hash, each page takes
as many as fit, one at least.  So only a single document above the limit makes a shard above it.

Defined results: a null text has 0 bytes; null identifiers hash as empty; equal rows hash alike and
are spread over pages if they exceed the limit; an empty table gives no shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import running_sum, scratch, table, written

#: Bytes of text in a shard, at most.  Small pieces, as a streaming loader fetches them.
LIMIT_BYTES = 1 << 20
HASH_BITS = 60
STEP = 12


def hash60(doc_id: Column, text: Column) -> Column:
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(h: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a 60-bit hash, as a number."""
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """depth, prefix, bytes, n, one_hash: the buckets of ``rows`` (__h, __bytes), which must be a written table."""
    found, pending, base = None, rows, 0
    while True:
        top = min(base + STEP, HASH_BITS)
        cells = pending.groupBy(prefix(F.col("__h"), F.lit(top)).alias("cell")).agg(
            F.sum("__bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("__h").alias("low"), F.max("__h").alias("high"))
        cells = written(cells, "shard-cells")
        levels = cells.select("*", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth"))
        at = F.call_function("shiftright", F.col("cell"), (F.lit(top) - F.col("depth")).cast("int"))
        totals = levels.groupBy("depth", at.alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        ends = totals.withColumn("one_hash", F.col("low") == F.col("high")).where((F.col("bytes") <= limit) | F.col("one_hash"))
        # The shortest prefix of each cell that ends there: the parent, if any, does not.
        own = ends.select("depth", "prefix").withColumnsRenamed({"depth": "__d", "prefix": "__p"})
        parent = F.call_function("shiftright", F.col("prefix"), F.lit(1))
        ends = ends.join(own, (F.col("__d") == F.col("depth") - 1) & (F.col("__p") == parent) & (F.col("depth") > base), "left_anti")
        ends = written(ends.select("depth", "prefix", "bytes", "n", "one_hash"), "shard-directory")
        found = ends if found is None else found.unionByName(ends)
        large = cells.where((F.col("bytes") > limit) & (F.col("low") != F.col("high"))).select(F.col("cell").alias("__cell"))
        if top == HASH_BITS or large.isEmpty():
            return found
        pending = pending.join(large, prefix(F.col("__h"), F.lit(top)) == F.col("__cell"), "left_semi")
        base = top


def assign(docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``docs``' identifier (``row_col``, if given, in its place), __h, __bytes, shard, depth and shard_bytes (of the bucket or
    page), one row per row."""
    rows = written(docs.select(F.col(row_col or id_col).alias("__id"), hash60(F.col(id_col), F.col(text_col)).alias("__h"),
                               F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("__bytes")), "shard-rows")
    buckets = directory(rows, limit)
    depths = [r.depth for r in buckets.select("depth").distinct().collect()]  # at most 61 numbers
    if not depths:
        empty = rows.limit(0)
        return empty.select("__id", "__h", "__bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard_bytes"))
    # A row lies in exactly one bucket: the one of its prefix at one of the depths that occur.
    keyed = rows.select("*", F.explode(F.array(*[F.struct(F.lit(d).alias("d"), prefix(F.col("__h"), F.lit(d)).alias("p")) for d in sorted(depths)])).alias("__at"))
    placed = keyed.join(buckets, (F.col("__at.d") == F.col("depth")) & (F.col("__at.p") == F.col("prefix"))).drop("__at")
    name = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    placed = placed.withColumn("shard", name)
    chained = F.col("one_hash") & (F.col("n") > 1) & (F.col("bytes") > limit)
    plain = placed.where(~chained).select("__id", "__h", "__bytes", "shard", "depth", F.col("bytes").alias("shard_bytes"))
    chain = placed.where(chained).withColumn("__one", F.lit(1).cast("long"))
    if buckets.where(chained).isEmpty():
        return plain
    chain = running_sum(chain, ["shard"], ["__bytes"], "__one", "__rank", "shard-chain")
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("__bytes", F.lit(1))))
    page = F.floor((F.col("__rank") - 1) / per).cast("long")
    here = F.least(per, F.col("n") - page * per) * F.col("__bytes")
    chain = chain.select("__id", "__h", "__bytes", F.concat("shard", F.lit("."), page).alias("shard"), "depth", here.cast("long").alias("shard_bytes"))
    return plain.unionByName(chain)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Write every row of ``docs`` into a folder shard=<prefix> under ``path``, one task a shard; return shard, n and bytes."""
    rid = "__shard_rid"
    stored = written(docs.withColumn(rid, F.monotonically_increasing_id()), "shard-docs")
    placed = assign(stored, limit, row_col=rid).select(F.col("__id").alias("__own"), "shard", F.col("__bytes").alias("__shard_row_bytes"))
    out = stored.join(placed, F.col(rid) == F.col("__own")).drop(rid, "__own")
    out.drop("__shard_row_bytes").repartition(F.col("shard")).write.partitionBy("shard").parquet(path)
    return out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("__shard_row_bytes").alias("bytes"))


def sharded(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    return assign(docs, limit).select(
        F.col("__id").alias("doc_id"), F.col("__bytes").alias("n_bytes"), "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))


def sql(docs: str = "documents", limit: int = LIMIT_BYTES) -> str:
    """DuckDB twin over the rows of ``docs`` (a table or a parenthesised query)."""
    return f"""
WITH r AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM {docs}),
c AS (SELECT h >> 30 AS p, sum(n_bytes) AS b, min(h) AS lo, max(h) AS hi FROM r GROUP BY 1),
t AS (
  SELECT d.depth, c.p >> (30 - d.depth) AS prefix, sum(b) AS bytes, min(lo) AS lo, max(hi) AS hi
  FROM c, (SELECT unnest(range(31)) AS depth) d GROUP BY ALL),
ends AS (SELECT * FROM t WHERE bytes <= {limit} OR lo = hi),
own AS (
  SELECT r.*, min(e.depth) AS depth FROM r JOIN ends e ON e.prefix = r.h >> (60 - e.depth)
  GROUP BY ALL),
own_n AS (SELECT *, count(*) OVER (PARTITION BY h) AS n, row_number() OVER (PARTITION BY h) - 1 AS rn
  FROM (SELECT r.*, o.depth FROM r JOIN (SELECT DISTINCT h, depth FROM own) o USING (h))),
paged AS (
  SELECT o.*, t.bytes, t.lo = t.hi AND o.n > 1 AND t.bytes > {limit} AS chained,
    greatest(1, {limit} // greatest(o.n_bytes, 1)) AS per,
    CASE WHEN o.depth = 0 THEN '' ELSE lpad(bin(o.h >> (60 - o.depth)), CAST(o.depth AS INTEGER), '0') END AS name
  FROM own_n o JOIN t ON t.depth = o.depth AND t.prefix = o.h >> (60 - o.depth))
SELECT doc_id, n_bytes, CASE WHEN chained THEN name || '.' || CAST(rn // per AS VARCHAR) ELSE name END AS shard,
  CAST(depth AS INTEGER) AS depth,
  CAST(CASE WHEN chained THEN least(per, n - (rn // per) * per) * n_bytes ELSE bytes END AS BIGINT) AS shard_bytes
FROM paged
"""


SQL = sql()
