"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their leading ``PREFIXES`` bytes (inflected insults share
these), hashed into 2**``HASH_BITS`` buckets; only presence counts, so a text's length does not.  The
``MAX_TERMS`` buckets that tell the classes apart best (likelihood ratio over the training texts,
counted by Spark, summed in each task before the shuffle) enter a factorization machine: a bias, a weight
for each term and a short vector for each term, whose inner products are the weights of pairs of
terms that occur together.  Spark's own learner fits it; every executor then scores whole texts.

The fit reads at most about ``MAX_TRAIN`` labelled rows, a documented bound: those whose hash of doc_id is
lowest.  Rows with crc32(doc_id as text) mod 3 = 1 are held out and never learnt from.  Scores depend on the
text alone.

Defined results: null, empty and wordless texts have no terms and get the bias alone; a null doc_id is
scored, not held out, and learnt from by none; repeated rows are scored each; of conflicting labels the
toxic one holds, null labels do not count; without training rows of both classes every score is the share of
toxic rows (0 if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import table, written
from aerolith.llm.textvec import U, Words, pieces

HASH_BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
MAX_TERMS = 4096
MIN_DOCS = 3
MAX_TRAIN = 24_000
FACTORS = 4
ITERATIONS = 60
STEP = 0.1
SEED = 7
THRESHOLD = 0.7
FIT_PARTITIONS = 6


@dataclass
class Model:
    buckets: np.ndarray  # of the terms, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # terms x FACTORS

    def scores(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Probabilities for ``n`` texts from their distinct (text, term) pairs."""
        if not len(self.buckets):
            return np.full(n, self.bias)
        linear = np.bincount(doc, self.weights[term], n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            pairs += np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def term_pairs(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (text, bucket) pairs of the texts' terms, each once, in order, a piece of the texts at a time."""
    for start, end in pieces(texts):
        words = Words(texts[start:end])
        doc, hashes = [words.doc], [words.hash]
        for size in PREFIXES:
            h, at = words.prefixes(size)
            doc.append(words.doc[at])
            hashes.append(h)
        bucket = np.concatenate(hashes) >> U(64 - HASH_BITS)
        pair = np.unique((np.concatenate(doc).astype(np.uint64) << U(HASH_BITS)) | bucket)
        yield (pair >> U(HASH_BITS)).astype(np.int64) + start, (pair & U((1 << HASH_BITS) - 1)).astype(np.int64)


def term_numbers(buckets: np.ndarray) -> np.ndarray:
    """The number of each bucket's term, -1 for buckets that are no term."""
    number = np.full(1 << HASH_BITS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))
    return number


def known_pairs(texts, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (text, term number) pairs of the terms that have a number."""
    docs, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for doc, bucket in term_pairs(texts):
        term = number[bucket]
        docs.append(doc[term >= 0])
        terms.append(term[term >= 0])
    return np.concatenate(docs), np.concatenate(terms)


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """toxic, text of at most about ``max_train`` labelled rows that are not held out, as a written table."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = known.count()
    if n > max_train:  # the lowest hashes: an even sample that is the same in every run
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(max_train / n * (1 << 30))))
    known = known.select(F.col("doc_id").alias("__id"), "toxic")  # two numbers for each of about max_train rows
    rows = docs.select(F.col("doc_id").alias("__d"), F.col("text").alias("text")).join(
        F.broadcast(known), F.col("__d") == F.col("__id"))
    return written(rows.select("toxic", "text"), "toxicity-train")


def telling_terms(train: DataFrame, max_terms: int = MAX_TERMS) -> np.ndarray:
    """The buckets with the largest likelihood ratio between the classes, ascending."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
            for doc, bucket in term_pairs(batch.column("text")):
                for k in (0, 1):
                    seen[k] += np.bincount(bucket[toxic[doc] == bool(k)], minlength=1 << HASH_BITS)
        at = np.flatnonzero(seen.any(axis=0))
        for part in np.array_split(at, max(1, len(at) // 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[0, part]), pa.array(seen[1, part])], ["bucket", "clean", "toxic"])

    n_toxic, n = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < n_toxic < n:
        return np.zeros(0, np.int64)
    counts = train.mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    seen, share = F.col("clean") + F.col("toxic"), n_toxic / n
    part = lambda got, of, all_: F.when(got > 0, got * F.log(got * all_ / of)).otherwise(0.0)
    total = F.lit(float(n))
    ratio = (part(F.col("toxic"), seen * n_toxic, total) + part(F.col("clean"), seen * (n - n_toxic), total)
             + part(n_toxic - F.col("toxic"), (n - seen) * n_toxic, total)
             + part((n - n_toxic) - F.col("clean"), (n - seen) * (n - n_toxic), total))
    best = (counts.where((seen >= MIN_DOCS) & (seen < n)).select("bucket", ratio.alias("ratio"))
            .orderBy(F.col("ratio").desc(), "bucket").limit(max_terms))
    return np.sort(np.array([r.bucket for r in best.collect()], np.int64))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    train = training_rows(docs, labels, max_train)
    buckets = telling_terms(train)
    if not len(buckets):
        share = train.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
        return Model(buckets, float(share), np.zeros(0), np.zeros((0, FACTORS)))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = term_numbers(buckets)
        for batch in batches:
            doc, term = known_pairs(batch.column("text"), number)
            own = np.split(term.astype(str), np.searchsorted(doc, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("toxic")).cast(pa.float64()), pa.array([x.tolist() for x in own], pa.list_(pa.string()))],
                ["label", "terms"])

    rows = train.mapInArrow(terms, "label double, terms array<string>").repartition(FIT_PARTITIONS)
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(buckets))], inputCol="terms", outputCol="features")
    learner = FMClassifier(factorSize=FACTORS, maxIter=ITERATIONS, stepSize=STEP, regParam=0.0, initStd=0.01,
                           miniBatchFraction=1.0, solver="adamW", seed=SEED)
    fitted = learner.fit(vectors.setBinary(True).transform(rows).select("label", "features"))
    return Model(buckets, float(fitted.intercept), fitted.linear.toArray(), fitted.factors.toArray())


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability ``out`` of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # MAX_TERMS x (FACTORS + 2) numbers
    names = [c for c in docs.columns if c != out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != out), f"`{out}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        number = term_numbers(m.buckets)
        for batch in batches:
            doc, term = known_pairs(batch.column(text_col), number)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(m.scores(doc, term, batch.num_rows))], [*names, out])

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
