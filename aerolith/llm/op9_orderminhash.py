"""Near-duplicate detection by Order MinHash.

A text's five-word shingles are labelled with how often they occurred before, so they are distinct.  Under
each of SKETCHES hash functions the MINIMA least ones are kept in the order of the text; their hash
is one entry of the sketch.  Texts that share an entry meet in its bucket: entries agree for
texts that share both the shingles and their order, which follows edit similarity.  Candidates are verified by
banded alignment of the shingles without labels (a longest common subsequence, so texts may repeat
themselves): matched shingles in order, m, of texts with a and b shingles give m / (a + b - m), and 0.8 or more is a link.  At that similarity an entry agrees with a chance of about a half, so 24 entries
miss a pair once in 10**7, and somewhat more often if texts repeat themselves, as an edit of one occurrence changes the labels of later ones.

* Texts of equal words are one node from the start (a partial and a final aggregate).
* Buckets with the same members (one group of copies shares many entries) are looked at once.
* A large bucket is cut into blocks of bounded size and each pair of blocks is a task of its own, so all its
  pairs are examined, in bounded memory, and none is emitted: a block pair returns a spanning forest of its links.
* Classes are connected components of the links.

Sketches and alignment see 16 bits of each word's hash, to keep the shuffles small: two different words count as equal
once in 65,536, so a pair with d replaced words comes out too similar with a chance of about d in 65,536.

Words are lower-cased runs of ASCII letters, digits, underscores and characters that are not ASCII.  Defined results:
a null text is a class of its own; texts without words are copies only if they are equal; texts of one to
four words are one shingle; repeated rows are copies; a class is shown by its least doc_id (null if it has none)
and keeps one row, that of the least doc_id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import op9_kernels as kernels
from aerolith.llm.common import discard, small, table, width, written
from aerolith.llm.components import components
from aerolith.llm.textvec import U, hashed, pieces

BLOCK_TEXTS = 512
BLOCK_TOKENS = 1 << 20
PIECE_BYTES = 1 << 20


def text_keys(texts: list, h: np.ndarray, first: np.ndarray) -> list:
    """Equal for texts of equal words, or for equal texts without words; None for null."""
    return [None if t is None else hashlib.md5(h[x:y].tobytes() if y > x else b"text:" + t.encode("utf-8", "surrogatepass")).digest()
            for t, x, y in zip(texts, first[:-1], first[1:], strict=True)]


def featurized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, __id, key (of the text's words), has_text, n_tokens, sketch, tokens of every row, as a written table."""
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("__text"), PIECE_BYTES):
                texts = batch.column("__text").slice(a, b - a).to_pylist()
                h, first = hashed(texts)
                tokens = (h >> U(48)).astype(np.uint16)
                keys, begin = kernels.shingles(tokens, first)
                sketch = kernels.sketches(kernels.labelled(keys, begin), begin).astype(np.int64)
                n = np.diff(first)
                key = text_keys(texts, h, first)
                yield pa.RecordBatch.from_arrays([
                    batch.column("__id").slice(a, b - a), pa.array(key, pa.binary()), pa.array(n),
                    pa.array([s if m else None for s, m in zip(sketch, n, strict=True)], pa.list_(pa.int64())),
                    pa.array([tokens[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    ["__id", "key", "n_tokens", "sketch", "tokens"])

    made = rows.mapInArrow(run, "__id long, key binary, n_tokens long, sketch array<long>, tokens binary")
    made = made.withColumn("rid", F.monotonically_increasing_id())
    made = made.withColumn("has_text", F.col("key").isNotNull())
    return written(made.withColumn("key", F.coalesce("key", F.col("rid").cast("string").cast("binary"))), "near-features")


def buckets(nodes: DataFrame) -> DataFrame:
    """bucket, uid, n_blocks: the members of the buckets of two texts or more, one bucket for each set of members."""
    entries = nodes.where("sketch is not null").select("uid", F.explode("sketch").alias("bucket"))
    shared = entries.groupBy(F.col("bucket").alias("__shared")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(entries.join(shared, F.col("bucket") == F.col("__shared")).select("bucket", "uid", "n"), "near-shared")
    sizes = nodes.select(F.col("uid").alias("__uid"), "n_tokens")
    sets = (members.join(sizes, F.col("uid") == F.col("__uid")).groupBy("bucket").agg(
        F.first("n").alias("n"), F.sum("n_tokens").alias("tokens"), F.bit_xor(F.xxhash64("uid")).alias("x"),
        F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y"))
        .groupBy("n", "tokens", "x", "y").agg(F.min("bucket").alias("__bucket")))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    kept = sets.select("__bucket", blocks.alias("n_blocks"))
    out = written(members.join(kept, F.col("bucket") == F.col("__bucket")).select("bucket", "uid", "n_blocks"), "near-buckets")
    discard(members)
    return out


def verified(members: DataFrame, features: DataFrame) -> DataFrame:
    """u, v: links inside the buckets, by pairs of blocks."""
    own = F.pmod(F.xxhash64("uid"), F.col("n_blocks")).cast("int")
    dealt = members.select("bucket", "uid", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
    dealt = dealt.select("bucket", "uid", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    needed = written(members.select(F.col("uid").alias("__u")).distinct(), "near-needed")
    tokens = features.select("rid", "tokens").join(small(needed), F.col("rid") == F.col("__u"), "left_semi")
    task = ["bucket", "low", "high"]
    rows = dealt.join(tokens, F.col("uid") == F.col("rid")).select(*task, "uid", "tokens")
    n = width(features.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, uids, tokens = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if len(uids) > 1:
                pairs = kernels.links(tokens)
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uids[i] for i, _ in pairs], pa.int64()), pa.array([uids[j] for _, j in pairs], pa.int64())], ["u", "v"])

        for batch in batches:
            tasks = zip(*(batch.column(c).to_pylist() for c in task), strict=True)
            for key, uid, packed in zip(tasks, batch.column("uid").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if key != held:
                    yield from flush()
                    held, uids, tokens = key, [], []
                uids.append(uid)
                tokens.append(np.frombuffer(packed, np.uint16))
        yield from flush()

    return rows.repartition(n, *task).sortWithinPartitions(*task).mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __key, has_text, class_id, kept, n_same of every row of ``docs``: kept is true for one row of each class,
    and n_same is how many rows have that row's identifier and key."""
    features = featurized(docs, id_col, text_col)
    nodes = written(features.groupBy("key").agg(
        F.min("rid").alias("uid"), F.first("sketch").alias("sketch"), F.first("n_tokens").alias("n_tokens")), "near-nodes")
    members = buckets(nodes)
    found = components(verified(members, features))
    named = nodes.select(F.col("key").alias("__key"), "uid").join(found, F.col("uid") == F.col("u"), "left").select(
        "__key", F.coalesce("root", "uid").alias("root"))
    rows = written(features.select("rid", "__id", "key", "has_text").join(named, F.col("key") == F.col("__key")).select(
        "rid", "__id", "__key", "has_text", "root"), "near-rows")
    discard(features, nodes, members, found)
    order = F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__key").alias("key"), F.col("rid").alias("rid"))
    # one row for each identifier and key of a class first, so that the count of a row's equals comes along
    best = (rows.groupBy("root", "__id", "__key").agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n"))
            .groupBy(F.col("root").alias("__root")).agg(F.min(F.struct("__first", "__n")).alias("__best"), F.sum("__n").alias("__rows")))
    # Only classes of two rows or more are joined; a large one does not land in one task: broadcast, or a join that Spark may split.
    best = small(written(best.where("__rows > 1").drop("__rows"), "near-best"))
    alone = F.col("__root").isNull()
    return rows.join(best, F.col("root") == F.col("__root"), "left").select(
        "__id", "__key", "has_text", F.when(alone, F.col("__id")).otherwise(F.col("__best.__first.id")).alias("class_id"),
        (alone | (F.col("rid") == F.col("__best.__first.rid"))).alias("kept"), F.when(alone, F.lit(1).cast("long")).otherwise(F.col("__best.__n")).alias("n_same"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``docs``, with all columns.

    Rows that go are found again by identifier and key; of rows that repeat those of a row that stays, one stays.
    """
    found = classes(docs, id_col, text_col).where("has_text")
    pair = [F.col("__id").alias("__gone_id"), F.col("__key").alias("__gone_key")]
    stay = found.where("kept").select(*pair, "n_same")
    gone = written(found.groupBy("__id", "__key").agg(F.max("kept").alias("stays")).where("not stays").select(*pair), "near-gone")
    again = written(stay.where("n_same > 1"), "near-again")
    rows = keyed(docs, text_col)
    same = lambda t: rows["__row_key"].eqNullSafe(t["__gone_key"]) & rows[id_col].cast("long").eqNullSafe(t["__gone_id"])
    gone = small(gone)
    kept = rows.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    marked = kept.join(again, same(again), "left")
    one = marked.where("__gone_key is not null").dropDuplicates(["__gone_id", "__gone_key"])
    return marked.where("__gone_key is null").select(*docs.columns).unionByName(one.select(*docs.columns))


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with __row_key: the key of each row's text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for a, b in pieces(batch.column(text_col), PIECE_BYTES):
                texts = batch.column(text_col).slice(a, b - a).to_pylist()
                h, first = hashed(texts)
                keys += text_keys(texts, h, first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*names, "__row_key"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "__row_key binary"])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("__id").alias("doc_id"), "class_id", "kept")
