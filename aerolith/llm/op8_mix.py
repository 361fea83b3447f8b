"""Mixing sources to target weights by weighted fair queueing.

Sources share a budget of words by weight, no source above ``MAX_REPEATS`` times its own size;
what a capped source cannot take is shared anew among the others.  Each source's documents
queue in shuffled order (by a hash), again and again up to ``MAX_REPEATS`` rounds; a document's
virtual finish time is the number of words its source has sent up to and with it, divided by the
source's target.  The queue of all sources is sorted by finish time across the cluster and cut where
the budget is used up.

The running sums, within a source and over the whole queue, come from range partitions: each
partition adds up its own rows, then the totals of the partitions before it.  A source with a
third of all rows is spread over many partitions.  Sharing out the targets is one small aggregate over
the table of sources a round; the driver holds one number.

Defined results: a null text has size 0; documents of size 0 are taken 0 words; null sources
are one source, the last; equal rows are separate documents (which of them comes first does not
show in the result); an empty table gives an empty result; a corpus without words has targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import WORD_RE, running_sum, table, written

#: Weights of the sources in code point order, repeating; fixed by the contract.
WEIGHTS = [5, 2, 1]
#: Share of all words that the mix takes.
SHARE = 1.0
MAX_REPEATS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights: list[int], share: float, repeats: int) -> DataFrame:
    """__source, source_size, target of each source of ``rows`` (__source, size), a written table."""
    sizes = rows.groupBy("__source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("__null", F.col("__source").isNull()).withColumn("__one", F.lit(1).cast("long"))
    numbered = running_sum(sizes, [], ["__null", "__source"], "__one", "__rank", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    sources = written(numbered.select("__source", "source_size", weight.cast("long").alias("__weight")), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level = total * share, -1.0  # the level: words for each unit of weight
    cap = F.col("source_size") * repeats
    while True:
        over = cap <= F.col("__weight") * F.lit(level)
        left, units = sources.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("__weight"))), F.lit(0))).first()
        new = (budget - left) / units if units else level
        if new <= level or not units:
            break
        level = new
    level = max(level, 0.0)
    return sources.select("__source", "source_size", F.least(cap.cast("double"), F.col("__weight") * F.lit(level)).alias("target"))


def queue_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The short rows that queue: ``keep``, __source, size and __turn (the shuffled order) of each document."""
    return docs.select(*keep, F.col("source").cast("string").alias("__source"), n_words(F.col("text")).alias("size"),
                       F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\x1f"),
                                      F.coalesce("text", F.lit("")))).alias("__turn"))


def mixed(rows: DataFrame, keep: list[str], weights: list[int] = WEIGHTS, share: float = SHARE,
          repeats: int = MAX_REPEATS) -> DataFrame:
    """``keep``, size, source_size, target and taken of each of the ``queue_rows``, which must be a written table."""
    goal = targets(rows, weights, share, repeats)
    sent = running_sum(rows, ["__source"], ["__turn"], "size", "__sent", "mix-sent")
    goal = goal.withColumnRenamed("__source", "__s")
    sent = written(sent.join(goal, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s"), "mix-queue")
    finish = lambda again: (F.col("__sent") + F.col("source_size") * again) / F.col("target")
    queue = sent.where("size > 0 and target > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__again"), "__source", "__turn", "__sent", "source_size", "target", "size")
    queue = queue.select(finish(F.col("__again")).alias("__finish"), F.col("__source").isNull().alias("__null"), "__source", "__turn", "size")
    order = ["__finish", "__null", "__source", "__turn"]
    budget = int((rows.agg(F.sum("size")).first()[0] or 0) * share)
    ahead = running_sum(queue, [], order, "size", "__ahead", "mix-order")
    last = ahead.where(F.col("__ahead") <= budget).agg(F.max(F.struct(*order))).first()[0]
    taken = F.lit(0).cast("long")
    if last is not None:
        cut = F.struct(*[F.lit(last[c]).cast(t) for c, t in zip(order, ["double", "boolean", "string", "string"], strict=True)])
        for again in range(repeats):
            own = F.struct(finish(F.lit(again)), F.col("__source").isNull(), F.col("__source"), F.col("__turn"))
            taken = taken + F.when((F.col("size") > 0) & (F.col("target") > 0) & (own <= cut), F.col("size")).otherwise(0)
    return sent.select(*keep, "size", "source_size", "target", taken.alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = written(queue_rows(docs, ["doc_id"]), "mix-rows")
    return mixed(rows, ["doc_id"])


def sql(docs: str = "documents", columns: str = "doc_id") -> str:
    """DuckDB twin: the sources' caps are reached in the order of size by weight, so the level is the first
    at which the next source stays below its cap."""
    case = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
WITH r AS (
  SELECT {columns}, CAST(source AS VARCHAR) AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')) AS turn
  FROM {docs}),
src AS (
  SELECT s, sum(size) AS source_size,
    CASE (row_number() OVER (ORDER BY s IS NULL, s) - 1) % {len(WEIGHTS)} {case} END AS w
  FROM r GROUP BY s),
lv AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * {MAX_REPEATS}) OVER before, 0))
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM src WINDOW before AS (ORDER BY source_size / CAST(w AS DOUBLE), s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT level FROM lv WHERE source_size * {MAX_REPEATS} > w * level ORDER BY source_size / CAST(w AS DOUBLE), s LIMIT 1),
goal AS (SELECT s, CAST(source_size AS BIGINT) AS source_size,
    least(CAST(source_size * {MAX_REPEATS} AS DOUBLE), w * coalesce((SELECT level FROM lev), 0)) AS target FROM src),
q AS (
  SELECT r.*, g.source_size, g.target, row_number() OVER () AS id,
    sum(size) OVER (PARTITION BY r.s ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sent
  FROM r JOIN goal g ON r.s IS NOT DISTINCT FROM g.s),
f AS (
  SELECT id, size, s, turn, CAST(sent + source_size * again AS DOUBLE) / target AS finish
  FROM q, (SELECT unnest(range({MAX_REPEATS})) AS again) WHERE size > 0 AND target > 0),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, s IS NULL, s, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ahead FROM f),
t AS (SELECT id, sum(size) AS taken FROM o WHERE ahead <= (SELECT sum(size) FROM r) * {SHARE} GROUP BY id)
SELECT {columns}, size, source_size, target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN t USING (id)
"""


SQL = sql()
