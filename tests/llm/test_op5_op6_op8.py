"""Top-k, sharding and mixing against brute force, with ties, nulls, repeats and hot keys."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from aerolith.llm import op5_topk, op6_shard, op8_mix
from aerolith.llm.common import running_sum, written


def best(rows, k):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 1024), (16, 3)])
def test_topk(spark, blocks):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.2, 0.9]) for _ in range(6)]) for i in range(0, 420, 2)]
    rows += [(100, [9.0] * 6), (7, None), (9, [1.0, None] * 3), (11, [float("nan")] * 6), (13, [float("inf")] * 6), (None, [1.0] * 6),
             (15, [0.5] * 3), (300, [0.5] * 3), (17, []), (500, []), (600, [0.25, 0.5]), (4, rows[2][1]), (4, rows[2][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, score int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    v = op5_topk.integer_vectors(df)
    got = op5_topk.top_k(v, v.where("vec_id % 100 = 0"), 10, *blocks)
    assert sorted(map(tuple, got.collect())) == best(rows, 10)
    assert op5_topk.top_k(v.where("false"), v.where("false")).count() == 0


def test_nra_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    x = np.floor(1024 * rng.standard_exponential((3000, 3)))
    ids = rng.permutation(3000)
    q, qi = x[:40], ids[:40]
    at, who, score = op5_topk.nra(x, ids, q, qi, 5)
    for i in range(40):
        s = x @ q[i]
        want = [j for j in np.lexsort((ids, -s)) if ids[j] != qi[i]][:5]
        mine = at == i
        assert who[mine].tolist() == want and score[mine].tolist() == s[want].tolist()


@pytest.mark.parametrize("size", [3e3, 3e5, 8e5])
def test_scores_beyond_doubles(spark, size):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-size, size) for _ in range(6)]) for i in range(0, 300, 3)]
    v = op5_topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = op5_topk.top_k(v, v.where("vec_id % 100 = 0"), 10, 16, 3)
    assert sorted(map(tuple, got.collect())) == best(rows, 10)


def test_scores_beyond_longs():
    x = np.full((2, 3), 1 << 31, np.int64)
    with pytest.raises(OverflowError):
        op5_topk.exact(x, x)


def test_shards(spark):
    rng = random.Random(1)
    docs = [(i, "w" * rng.randint(0, 300)) for i in range(400)] + [(None, "same text")] * 300 + [(5000, "big" * 1000), (None, None), (5001, "")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, shard string, depth int")
    limit = 1000
    rows = op6_shard.sharded(df, limit).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in rows) == Counter((i, len(t or "")) for i, t in docs)
    total, n = Counter(), Counter()
    for r in rows:
        total[r.shard] += r.n_bytes
        n[r.shard] += 1
    assert all(b <= limit or n[s] == 1 for s, b in total.items())
    assert all(total[r.shard] == r.shard_bytes for r in rows)
    # only oversized buckets split: a shard's parent would not fit; every document's hash starts with its shard's name
    from pyspark.sql import functions as F

    h = {(r.doc_id, r.text): f"{r.h:060b}" for r in df.select("doc_id", "text", op6_shard.hash60(F.col("doc_id"), F.col("text")).alias("h")).collect()}
    every = [(h[d], len(d[1] or "")) for d in docs]
    names = {s.partition(".")[0] for s in total}
    for s in names:
        assert not any(o != s and s.startswith(o) for o in names)
        if s:
            assert sum(b for x, b in every if x.startswith(s[:-1])) > limit
    assert op6_shard.sharded(df, 10**9).select("shard").distinct().collect()[0].shard == ""
    assert op6_shard.sharded(df.where("false"), limit).count() == 0


def test_shards_beyond_one_step(spark, monkeypatch):
    monkeypatch.setattr(op6_shard, "STEP", 2)
    df = spark.range(500).selectExpr("id as doc_id", "repeat('y', 50) as text")
    rows = op6_shard.sharded(df, 400).collect()
    assert len(rows) == 500 and max(r.shard_bytes for r in rows) <= 400 and max(r.depth for r in rows) > 4


def test_written_shards(spark, tmp_dir):
    df = spark.createDataFrame([(i, "z" * 40, "de") for i in range(60)] + [(1, "z" * 40, "fr")] * 40, "doc_id long, text string, lang string")
    got = op6_shard.write_shards(df, f"{tmp_dir}/out", 600).collect()
    assert sum(r.n for r in got) == 100 and max(r.bytes for r in got) <= 600
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 100


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def goals(docs):
    size = Counter()
    for _, s, t in docs:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    capped: set = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        units = sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3 * size[s] if s in capped else weight[s] * left / units for s in order}
        more = {s for s in order if target[s] > 3 * size[s]}
        if not more:
            return size, target
        capped |= more


def test_mix(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a"] * 6 + ["b", "ä", "Z", None]), "  w\t" * rng.randint(0, 30)) for i in range(600)]
    docs += [(1000 + i, "tiny", "one two") for i in range(3)] + [(None, "a", None), (7, "b", "x y"), (7, "b", "x y")]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, source string, text string, target int")
    rows = written(op8_mix.queue_rows(df, ["doc_id"]), "t")
    got = op8_mix.mixed(rows, ["doc_id"]).collect()
    again = op8_mix.mixed(rows, ["doc_id"]).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    size, target = goals(docs)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, words(t)) for i, _, t in docs)
    biggest = max(r["size"] for r in got)
    for s in size:
        mine = [r for r in got if r.source_size == size[s] and abs(r.target - target[s]) < 1e-6]
        assert mine and abs(sum(r.taken for r in mine) - target[s]) <= 2 * biggest
    assert all(r.taken % max(r["size"], 1) == 0 and 0 <= r.taken <= 3 * r["size"] for r in got)
    total = sum(size.values())
    assert total - biggest < sum(r.taken for r in got) <= total
    for bad in (df.where("false"), df.where("text is null")):
        assert all(r.taken == 0 and r.target == 0 for r in op8_mix.mixed(written(op8_mix.queue_rows(bad, ["doc_id"]), "t"), ["doc_id"]).collect())


def test_running_sum_spreads_a_hot_key(spark):
    df = spark.range(2000).selectExpr("if(id < 1900, null, 'b') as k", "id as o", "id % 7 as v")
    got = running_sum(df, ["k"], ["o"], "v", "s", "t").orderBy("o").collect()
    run = Counter()
    for r in got:
        run[r.k] += r.v
        assert r.s == run[r.k]


def test_running_sum_spreads_a_row_that_repeats(spark):
    df = spark.range(4000).selectExpr("'k' as k", "if(id < 3600, 5, id) as o", "1L as v")
    got = running_sum(df, ["k"], ["o"], "v", "s", "t")
    assert sorted(r.s for r in got.collect()) == list(range(1, 4001))
    from aerolith.llm import common

    seen = []
    keep = common.written
    try:
        common.written = lambda d, name: seen.append(keep(d, name)) or seen[-1]
        running_sum(df, ["k"], ["o"], "v", "s", "t")
    finally:
        common.written = keep
    sizes = [r["count"] for r in seen[0].groupBy("__pid").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2500
