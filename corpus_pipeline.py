"""Corpus pipeline: from raw documents to byte-limited shards of a clean, mixed training set.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and returns a DataFrame; its result is written as
Parquet in the shared folder and read again as the next stage's ``docs``.  All but the last return the
columns of ``docs``.  Extra columns go along, whatever their names.

1. toxicity          rows that the factorization machine rejects go (score of 0.7 or more)
2. near_dedup        one row of each class of near-duplicates stays
3. decontamination   rows into which a benchmark item leaks go
4. mixing            each row comes as often as the mix takes it (not at all, or up to three times)
5. sharding          doc_id, n_bytes, shard, depth, shard_bytes of every row

Nulls, empty and repeated rows and empty tables are defined by the operators' docstrings.  ORACLE_SQL is None:
SQL expresses neither the learnt classifier nor the sketches; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import op1_toxicity, op6_shard, op7_decontaminate, op8_mix, op9_orderminhash
from aerolith.llm.common import small, table, written

ORACLE_SQL = None


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or one like it that ``columns`` does not have."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op1_toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    score = fresh("__score", docs.columns)
    return op1_toxicity.score(docs, model, out=score).where(F.col(score) < op1_toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_orderminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rid, own = fresh("__rid", docs.columns), fresh("__own_rid", docs.columns)
    stored = written(docs.withColumn(rid, F.monotonically_increasing_id()), "mix-docs")
    rows = written(op8_mix.queue_rows(stored, [rid]), "mix-rows")
    again = fresh("__copies", docs.columns)
    copies = op8_mix.mixed(rows, [rid]).where("taken > 0").select(F.col(rid).alias(own), (F.col("taken") / F.col("size")).cast("int").alias(again))
    taken = stored.join(small(written(copies, "mix-copies")), F.col(rid) == F.col(own))
    return taken.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(again)))).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_shard.sharded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the table documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
