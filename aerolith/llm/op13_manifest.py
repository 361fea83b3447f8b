"""Merkle manifest of a data set by slot pivot: leaf, subroot, root and proof of every row, and a check of each proof.

A row's leaf is H of its fields (H: lower-case hex SHA-256 of the inputs laid end to end, digests as hex text).  Within a
group the leaves ascend by identifier; while more than one node remains, every ``FANOUT`` consecutive ones become the H of
their digests.  The last one is the group's subroot; the subroots, in the order of the groups, give the root likewise.

A level is one aggregate: nodes are grouped by parent number, and a conditional aggregate for each slot spread the children
into ``FANOUT`` columns (c0, c1, c2).  Laying the columns end to end and hashing gives the parent; a child that leaves out its
own slot's column has its siblings, those to the left and those to the right.  So a proof is an array of (left, right), one
for each level, put together from the root downwards: each level joins its nodes with their parents' rows.
Folding starts from a leaf and hashes left + digest + right, level by level; the last digest must be the root.

Texts are read once, for the leaves; everything after works on digests.  Leaf numbers come from range-partitioned running
sums and parents are dealt by (group, parent number), so a group with a third of all rows is spread over all tasks.  Levels
shrink by the fanout and are written tables; the driver holds the number of levels and the root.

Defined results: a null field hashes as ``-``; null groups are one group, the first; rows without an identifier come first in
their group; rows with one identifier are ordered by leaf, and equal rows are separate leaves (which of two equal rows gets which
proof is not defined; their proofs are valid both).  A single leaf is its own subroot, a single subroot the root, and a proof
without siblings is the H of nothing.  An empty table has no root and gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import discard, running_sum, small, table, written

FANOUT = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_STEP = "struct<left:string,right:string>"


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def group_key(c: Column) -> Column:
    """A key that is never null and sorts as the group does, null first."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
           text_col: str = "text") -> DataFrame:
    """id, k (the group's key), leaf and, where tampering changes the row, the tampered leaf; one row per row."""
    parts = [field(F.col(c)) for c in fields]
    torn = [field(F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text_col else F.col(c)) for c in fields]
    hit = (F.crc32(F.col(id_col).cast("string")) % 2 == 0) & F.contains(F.col(text_col), F.lit("\n"))
    return docs.select(F.col(id_col).alias("id"), group_key(F.col(group_col)).alias("k"), h(*parts).alias("leaf"),
                       F.when(hit, h(*torn)).alias("torn"))


def slot(fanout: int) -> Column:
    return F.col("idx") % fanout


def parent(fanout: int) -> Column:
    return F.floor(F.col("idx") / fanout).cast("long")


def tree(nodes: DataFrame, most: int, name: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` (k, idx from 0, n nodes of that k, digest; at most ``most`` of a k) and the k's last nodes (k, digest).

    A level holds k, idx, n, the slot columns c0.. and their digest; a k with one node has no further level.
    """
    levels, tops = [], None
    while True:
        top = nodes.where("n = 1").select("k", "digest", F.lit(len(levels)).alias("level"))
        tops = top if tops is None else tops.unionByName(top)
        if most <= 1:
            return levels, tops
        slots = [F.max(F.when(slot(fanout) == j, F.col("digest"))).alias(f"c{j}") for j in range(fanout)]
        runs = nodes.where("n > 1").groupBy("k", "n", parent(fanout).alias("idx")).agg(*slots)
        every = [F.coalesce(f"c{j}", F.lit("")) for j in range(fanout)]
        n = F.ceil(F.col("n") / fanout).cast("long")
        nodes = written(runs.select("k", "idx", n.alias("n"), *[f"c{j}" for j in range(fanout)], h(*every).alias("digest")), name)
        levels.append(nodes)
        most = -(-most // fanout)


def with_siblings(children: DataFrame, parents: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``children`` (k, idx, ...) with ``path``: the siblings of each (its parent's columns but for its own slot), then its parent's path."""
    cols = [F.coalesce(f"__c{j}", F.lit("")) for j in range(fanout)]
    side = lambda own: F.struct(F.concat(F.lit(""), *cols[:own]).alias("left"), F.concat(F.lit(""), *cols[own + 1 :]).alias("right"))
    step = side(fanout - 1)
    for own in range(fanout - 1):
        step = F.when(slot(fanout) == own, side(own)).otherwise(step)
    up = parents.select(F.col("k").alias("__k"), F.col("idx").alias("__idx"), F.col("path").alias("__path"),
                        *[F.col(f"c{j}").alias(f"__c{j}") for j in range(fanout)])
    joined = children.join(up, (F.col("k") == F.col("__k")) & (parent(fanout) == F.col("__idx")))
    return joined.select(*children.columns, F.concat(F.array(step), "__path").alias("path"))


def descend(levels: list[DataFrame], nodes: DataFrame, above: DataFrame, name: str, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (k, idx, n, ...) with ``path``, through ``levels`` to each k's last node, whose path is that of ``above`` (k, path)."""
    start = above.select(F.col("k").alias("__k"), F.col("path").alias("path"))
    known = None  # the level above, with paths
    for level in [*reversed(levels), nodes]:
        tops = level.where("n = 1").join(start, F.col("k") == F.col("__k")).drop("__k")
        placed = tops if known is None else with_siblings(level, known, fanout).unionByName(tops)
        if level is nodes:
            return placed
        last, known = known, written(placed, name)
        if last is not None:
            discard(last)
    return known


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
             text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """id, leaf, torn (the tampered leaf, else null), subroot, root and path of every row of ``docs``."""
    spark = docs.sparkSession
    rows = written(leaves(docs, fields, id_col, group_col, text_col).withColumn("one", F.lit(1).cast("long")), "manifest-leaves")
    numbered = running_sum(rows, ["k"], ["id", "leaf"], "one", "rank", "manifest-rank")
    sizes = written(rows.groupBy("k").agg(F.sum("one").alias("n")), "manifest-sizes")
    groups, most = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    n_of = small(sizes.select(F.col("k").alias("__k"), "n"), groups)
    nodes = written(numbered.join(n_of, F.col("k") == F.col("__k")).select(
        "k", (F.col("rank") - 1).alias("idx"), "n", "id", F.col("leaf").alias("digest"), "torn"), "manifest-nodes")
    levels, subroots = tree(nodes.select("k", "idx", "n", "digest"), most, "manifest-level", fanout)
    subroots = written(subroots.select("k", "digest"), "manifest-subroots")

    # The tree over the subroots, with one key for all of them.
    order = running_sum(subroots.withColumn("one", F.lit(1).cast("long")), [], ["k"], "one", "rank", "manifest-order")
    tops = order.select(F.lit("").alias("k"), (F.col("rank") - 1).alias("idx"), F.lit(groups).cast("long").alias("n"), "digest", F.col("k").alias("own"))
    upper, root = tree(tops.drop("own"), groups, "manifest-top", fanout)
    found = root.first()
    root_digest = found["digest"] if found else None
    nothing = spark.range(1).select(F.lit("").alias("k"), F.array().cast(f"array<{_STEP}>").alias("path"))
    paths = descend(upper, tops, nothing, "manifest-top-paths", fanout)
    above = written(paths.select(F.col("own").alias("k"), "path", F.col("digest").alias("subroot")), "manifest-groups")

    placed = descend(levels, nodes, small(above, groups), "manifest-paths", fanout)
    discard(rows, subroots, *levels[1:], *upper)
    own = small(above.select(F.col("k").alias("__g"), "subroot"), groups)
    return placed.join(own, F.col("k") == F.col("__g")).select(
        F.col("id"), F.col("digest").alias("leaf"), "torn", "subroot", F.lit(root_digest).cast("string").alias("root"), "path")


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, p: h(p["left"], digest, p["right"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = manifest(table(spark, sf_dir, "documents").select(*FIELDS))
    folded = fold(F.coalesce("torn", "leaf"), F.col("path"))
    out = m.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(docs: str = "documents", depth: int = 12, fanout: int = FANOUT) -> str:
    """DuckDB twin, its levels written out: ``depth`` of them, enough for fanout**depth rows of a source and as many sources.

    A level keeps each run's digests as a list; siblings are slices of it.  CRC-32 is computed bit by bit.
    """
    fields = lambda text: "concat(" + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', {c}) END"
        for c in [text if f == "text" else f for f in FIELDS]) + ")"
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"  # the polynomial of CRC-32
    byte = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: CAST(ord(z) AS BIGINT))"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(c >> 8, crc_of[xor(c & 255, b) + 1])))"
    table_sql = f"""crc_table AS MATERIALIZED (
  SELECT list(list_reduce([CAST(v AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {step}) ORDER BY v) AS crc_of FROM (SELECT unnest(range(256)) AS v))"""
    ctes = [table_sql, f"""raw AS MATERIALIZED (
  SELECT doc_id, source, sha256({fields('text')}) AS leaf, {crc} % 2 = 0 AS hit,
    sha256({fields("replace(text, chr(10), '')")}) AS torn FROM {docs}, crc_table)""",
            """l0 AS MATERIALIZED (
  SELECT coalesce('=' || source, '') AS k, doc_id, leaf AS d, CASE WHEN hit THEN torn ELSE leaf END AS start,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM raw)"""]

    def levels(name: str) -> None:
        for t in range(1, depth + 1):
            ctes.append(f"""{name}{t} AS MATERIALIZED (
  SELECT k, idx // {fanout} AS idx, any_value((n + {fanout - 1}) // {fanout}) AS n, list(d ORDER BY idx) AS run, sha256(string_agg(d, '' ORDER BY idx)) AS d
  FROM {name}{t - 1} WHERE n > 1 GROUP BY k, idx // {fanout})""")

    def ends(name: str) -> str:
        return " UNION ALL ".join(f"SELECT k, d FROM {name}{t} WHERE n = 1" for t in range(depth + 1))

    def climb(name: str, start: str) -> str:
        """``start`` (k, idx, cur, proof, ...) folded through the levels."""
        for t in range(1, depth + 1):
            out = f"{start.partition('_')[0]}_{t}"
            ctes.append(f"""{out} AS MATERIALIZED (
  SELECT s.* REPLACE (CASE WHEN r.k IS NULL THEN s.idx ELSE r.idx END AS idx,
    CASE WHEN r.k IS NULL THEN s.cur ELSE sha256(concat(array_to_string(r.run[1:s.idx % {fanout}], ''), s.cur, array_to_string(r.run[s.idx % {fanout} + 2:], ''))) END AS cur,
    CASE WHEN r.k IS NULL THEN s.proof ELSE concat(s.proof, array_to_string(r.run[1:s.idx % {fanout}], ''), array_to_string(r.run[s.idx % {fanout} + 2:], '')) END AS proof)
  FROM {start} s LEFT JOIN {name}{t} r ON r.k = s.k AND r.idx = s.idx // {fanout})""")
            start = out
        return start

    levels("l")
    ctes.append(f"sub AS MATERIALIZED ({ends('l')})")
    ctes.append("t0 AS MATERIALIZED (SELECT '' AS k, k AS own, d, row_number() OVER (ORDER BY k) - 1 AS idx, count(*) OVER () AS n FROM sub)")
    levels("t")
    ctes.append(f"root AS MATERIALIZED ({ends('t')})")
    ctes.append("inner0 AS (SELECT k, doc_id, d AS leaf, idx, start AS cur, '' AS proof FROM l0)")
    last = climb("l", "inner0")
    ctes.append(f"outer0 AS (SELECT '' AS k, i.doc_id, i.leaf, t0.d AS subroot, t0.idx, i.cur, i.proof FROM {last} i JOIN t0 ON t0.own = i.k)")
    last = climb("t", "outer0")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root.d AS verified FROM {last}, root"""


SQL = sql()
