"""Exact top-k inner products by no-random-access aggregation (NRA).

Vectors are dealt into blocks; in a block, each component has a list of its vectors sorted by
value.  A query reads every list in lock step from the end that its weight favours.  After a
depth, a vector's score lies between a lower bound (components seen, the others at the least the list
can still give) and an upper bound (the others at the value last read).  A query's kth largest lower
bound is its threshold; vectors whose upper bound is below it cannot qualify, and so cannot any vector
not yet seen once the sum of the values last read is below it.  Reading goes deeper until no
outsider can qualify; the scores of those left are then resolved from what was read.

Reading is done for all queries of a block at a time: the bounds of all (query, vector) pairs are four
matrix products over component values clipped at the list positions, in exact integers: doubles where no sum can pass
2**53, else 64-bit integers (``exact``).  The best k of each (query, block) go through a window over at most k rows a block.

Queries against vectors are blocks against blocks: vectors are copied once for each block of
``QUERY_BLOCK`` queries, queries once for each block of ``VECTOR_BLOCK`` vectors, and each pair of blocks
meets in one task, so memory is bounded and nothing is broadcast.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
rows with a null vec_id; vectors only meet vectors of their own length; an empty vector scores 0; a
query's own rows (equal vec_id) are no candidates; a repeated candidate row counts as often as it
occurs; of several rows with one query's vec_id the least vector is the query; an empty table gives no rows.
Vectors whose products may pass 63 bits have no score in a long and raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.llm.common import table, written

K = 10
SCALE = 1024
QUERY_EVERY = 100
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
#: Share of each list that has been read after each step.
DEPTHS = (3 / 4, 9 / 10, 1.0)


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x) of every vector that takes part."""
    x = F.col(vector_col).cast("array<double>")
    # The infinities compare equal to themselves plus one, NaN is greater than all.
    bad = F.exists(x, lambda y: F.coalesce(F.isnan(y) | (F.abs(y) == float("inf")), F.lit(True)))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("__x"), bad.alias("__bad"))
            .where("vec_id is not null and __x is not null and not __bad")
            .select("vec_id", F.transform("__x", lambda y: F.floor(y * F.lit(float(scale))).cast("long")).alias("v")))


def nra(x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, depths=DEPTHS):
    """(query number, vector number, score) of each query's k best rows of ``x``, ties to smaller ids, not its own id."""
    n, dims = x.shape
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    never = -np.inf if x.dtype == np.float64 else np.iinfo(np.int64).min  # below any score
    order = np.sort(x, axis=0)  # the lists, by value
    low, high = order[0], order[-1]
    result = []
    active = np.arange(len(q))
    own = q_ids[:, None] == ids[None, :]
    for share in depths:
        depth = min(n, max(k + 1, int(np.ceil(share * n))))
        last = depth >= n
        down, up = order[n - depth], order[depth - 1]  # values last read from the top and the bottom of each list
        if last:
            upper = lower = q[active] @ x.T
        else:
            top, bottom = x >= down, x <= up  # seen, from either end
            upper = plus[active] @ np.where(top, x, down).T + minus[active] @ np.where(bottom, x, up).T
            lower = plus[active] @ np.where(top, x, low).T + minus[active] @ np.where(bottom, x, high).T
        lower = np.where(own[active], never, lower)
        upper = np.where(own[active], never, upper)
        kk = min(k, n)
        threshold = np.partition(lower, n - kk, axis=1)[:, n - kk]
        left = upper >= threshold[:, None]
        left &= ~own[active]
        few = left.sum(axis=1) <= 4 * k
        done = np.ones(len(active), bool) if last else few
        for a in np.flatnonzero(done):
            who = np.flatnonzero(left[a])
            score = x[who] @ q[active[a]] if not last else upper[a, who]
            best = np.lexsort((ids[who], -score))[:k]
            result.append((np.full(len(best), active[a]), who[best], score[best]))
        active = active[~done]
        if not len(active):
            break
    if not result:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*result, strict=True))


def exact(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer matrices in a type in which all bounds and scores are exact."""
    largest = lambda m: max(abs(int(m.min(initial=0))), abs(int(m.max(initial=0))))
    bound = 2 * x.shape[1] * largest(x) * largest(q)
    if bound < 1 << 53:
        return x.astype(np.float64), q.astype(np.float64)
    if bound < 1 << 63:
        return x, q
    raise OverflowError("inner products of these vectors may pass 63 bits")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vector_block: int = VECTOR_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of ``queries`` against ``vectors`` (both vec_id, v)."""
    spark = vectors.sparkSession
    vectors = written(vectors.withColumn("dims", F.size("v")), "topk-vectors")
    queries = written(queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v")), "topk-queries")
    n_v = max(1, -(-vectors.count() // vector_block))
    n_q = max(1, -(-queries.count() // query_block))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    left = vectors.select("vec_id", "v", "dims", dealt(n_v).alias("vb"), blocks(n_q).alias("qb"))
    right = queries.select("vec_id", "v", "dims", dealt(n_q).alias("qb"), blocks(n_v).alias("vb"))

    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(own) or not len(asked):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        dims = len(own["v"].iloc[0])
        as_matrix = lambda s: np.array(s.tolist(), np.int64).reshape(len(s), dims)
        ids, q_ids = own["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        if not dims:
            x, q = np.zeros((len(ids), 1), np.int64), np.zeros((len(q_ids), 1), np.int64)
        else:
            x, q = as_matrix(own["v"]), as_matrix(asked["v"])
        x, q = exact(x, q)
        at, who, score = [], [], []
        step = max(1, (1 << 23) // max(1, len(ids)))  # queries at a time: matrices of 64 MB
        for s in range(0, len(q), step):
            a, w, c = nra(x, ids, q[s: s + step], q_ids[s: s + step], k)
            at.append(a + s)
            who.append(w)
            score.append(c)
        at, who, score = (np.concatenate(z).astype(np.int64) for z in (at, who, score))
        return pd.DataFrame({"query_id": q_ids[at], "vec_id": ids[who], "score": score})

    met = left.groupBy("vb", "qb", "dims").cogroup(right.groupBy("vb", "qb", "dims")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (met.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
