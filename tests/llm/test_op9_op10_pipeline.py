"""Near-duplicates, repeated passages and the pipeline against brute force."""

import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolith.llm import components, op9_kernels, op9_orderminhash, op10_repeats
from aerolith.llm.textvec import U, Words, hashed, sliding, windows


def word(rng, n=4):
    return "".join(rng.choice("abcdefghij") for _ in range(n))


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = word(rng)
    return out


def labelled(text):
    w = re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", (text or "").lower())
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    seen, out = Counter(), []
    for g in grams:
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def similarity(a, b):
    """By the textbook table of longest common subsequences over labelled shingles."""
    if not a or not b:
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1] / (len(a) + len(b) - row[-1])


def groups(docs):
    """The class of each row: rows of equal words, or of similar ones, directly or through others."""
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    grams = [labelled(t) for _, t in docs]
    for i in range(len(docs)):
        for j in range(i):
            a, b = grams[i], grams[j]
            same = docs[i][1] is not None and docs[i][1] == docs[j][1] if not a or not b else a == b or (
                len(set(a) & set(b)) >= 0.8 * (len(a) + len(b)) / 1.8 - 1 and similarity(a, b) >= 0.8)
            if same:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(docs))]


@pytest.fixture(scope="module")
def near():
    rng = random.Random(11)
    docs = []
    for _ in range(40):
        base = [word(rng) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            docs.append(" ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 4]))))
    hot = [word(rng) for _ in range(100)]  # a large group of near copies, some of them too far from all others
    docs += [" ".join(edited(rng, hot, rng.choice([1, 1, 2, 3]))) for _ in range(80)]
    swapped = [word(rng) for _ in range(80)]
    docs += [" ".join(swapped), " ".join(swapped[40:] + swapped[:40])]  # the same shingles in another order
    docs += ["a b", "A  b!", "x", "", "", " ", "...", None, None, "one one one one one one one one", "one one one one one one one one one"]
    rng.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)] + [(3, docs[3]), (None, docs[4]), (None, "no other text is like this one")]


@pytest.mark.parametrize("block", [512, 16])
def test_classes(spark, near, block, monkeypatch):
    monkeypatch.setattr(op9_orderminhash, "BLOCK_TEXTS", block)
    df = spark.createDataFrame([(*r, "c", 1) for r in near], "doc_id long, text string, root string, class_id int")
    got = op9_orderminhash.classes(df).collect()
    want = groups(near)
    members: dict = {}
    for (i, _), g in zip(near, want, strict=True):
        members.setdefault(g, []).append(i)
    least = {g: min((i for i in m if i is not None), default=None) for g, m in members.items()}
    assert Counter((r["__id"], r.class_id) for r in got) == Counter((i, least[g]) for (i, _), g in zip(near, want, strict=True))
    assert sum(r.kept for r in got) == len(members)
    kept = op9_orderminhash.deduplicated(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert op9_orderminhash.deduplicated(df.where("false")).count() == 0


def test_alignment_matches_the_table():
    rng = random.Random(2)
    for _ in range(60):
        base = [word(rng, 2) for _ in range(rng.randint(1, 60))]
        other = edited(rng, base, rng.randint(0, 3))
        if rng.random() < 0.5:
            del other[rng.randrange(len(other))]
        texts = [" ".join(base), " ".join(other)]
        h, first = hashed(texts)
        s, begin = op9_kernels.shingles((h >> U(48)).astype(np.uint16), first)
        keys = op9_kernels.labelled(s, begin)
        got = op9_kernels.alignment_similarity(keys[begin[0]:begin[1]], keys[begin[1]:begin[2]])
        want = similarity(*map(labelled, texts))
        assert got == pytest.approx(want) if want >= 0.8 else got <= want + 1e-9


def plain(text):
    return [g for g, _ in labelled(text)]


def kernel_shingles(texts):
    h, first = hashed(texts)
    tokens = (h >> U(48)).astype(np.uint16)
    s, begin = op9_kernels.shingles(tokens, first)
    return [tokens[first[k]:first[k + 1]] for k in range(len(texts))], s, begin


@pytest.mark.parametrize("pairs", [4, 0])  # 0: by bit operations
def test_alignment_of_texts_that_repeat_themselves(pairs, monkeypatch):
    monkeypatch.setattr(op9_kernels, "PAIRS_PER_SHINGLE", pairs)
    rng = random.Random(12)
    for _ in range(60):
        base = [word(rng, rng.choice([1, 4])) for _ in range(rng.randint(1, 30))] * rng.randint(1, 5)
        other = edited(rng, base, rng.randint(0, 4))
        if rng.random() < 0.5:
            del other[rng.randrange(len(other))]
        if rng.random() < 0.3:
            base, other = base[:6] * 12, other[:6] * 12
        texts = [" ".join(base), " ".join(other)]
        _, s, begin = kernel_shingles(texts)
        got = op9_kernels.alignment_similarity(s[begin[0]:begin[1]], s[begin[1]:begin[2]])
        want = similarity(*map(plain, texts))
        assert got == pytest.approx(want) if want >= 0.8 else got <= want + 1e-9


def test_copies_of_a_text_that_repeats_itself_are_linked():
    rng = random.Random(13)
    passage = [word(rng) for _ in range(104)]
    texts = [passage * 2, passage * 2]
    for at in (20, 50, 80):  # edits in the first half give the second half's shingles lower labels
        texts[1] = [*texts[1][:at], f"edit{at}", *texts[1][at + 1:]]
    texts = [" ".join(t) for t in texts]
    assert similarity(*map(labelled, texts)) < 0.8 < similarity(*map(plain, texts))
    tokens, s, begin = kernel_shingles(texts)
    assert op9_kernels.links(tokens) == [(0, 1)]
    sketch = op9_kernels.sketches(op9_kernels.labelled(s, begin), begin)
    assert (sketch[0] == sketch[1]).any()  # so the two texts meet in a bucket


def test_sketches_follow_order():
    """Equal sets of shingles in another order agree in few entries; edited texts in many."""
    keys = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    change = keys.copy()
    change[100:105] += U(1)
    mixed = np.concatenate([keys, change, keys[::-1]])
    s = op9_kernels.sketches(mixed, np.array([0, 200, 400, 600]))
    assert (s[0] == s[1]).sum() >= 15 and (s[0] == s[2]).sum() <= 12
    assert len(np.unique(s[0])) == op9_kernels.SKETCHES


def test_components(spark):
    rng = random.Random(0)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 2000 + i) for i in range(50)] + [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(90)]
    got = {r.u: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x1f .x_9", max_size=30)), max_size=6))
def test_words(texts):
    for kind, lower, split in (("space", False, lambda t: (t or "").encode().split()),
                               ("alnum", True, lambda t: re.findall(rb"[0-9A-Za-z_\x80-\xff]+", (t or "").lower().encode()))):
        w = Words(texts, kind, lower)
        want = [x for t in texts for x in split(t)]
        assert [bytes(w.data[a:b]) for a, b in zip(w.start, w.end, strict=True)] == want
        assert len(set(w.hash.tolist())) == len(set(want))
        assert np.diff(w.first).tolist() == [len(split(t)) for t in texts]
        assert hashed(texts, kind, lower)[0].tolist() == w.hash.tolist()


def test_window_hashes():
    h = np.random.default_rng(0).integers(0, 4, 500).astype(np.uint64)
    for n in (1, 5, 12, 35):
        runs = [tuple(h[i:i + n]) for i in range(500 - n + 1)]
        got = windows(h, n)
        assert len(got) == len(runs) and len(set(got.tolist())) == len(set(runs))
        assert sliding(h, n).tolist() == [min(r) for r in runs]


def brute_repeats(docs, n=35):
    texts = [(t or "").encode().split() for _, t in docs]
    seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(docs, texts, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k:k + n])] > 1:
                gone[k:k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"GROUP_SUFFIXES": 40, "HOME_BYTES": 4000, "PART_KEYS": 50}])
def test_repeats(spark, limits, monkeypatch):
    for k, v in limits.items():
        monkeypatch.setattr(op10_repeats, k, v)
    rng = random.Random(8)
    passage = [word(rng) for _ in range(90)]
    docs = []
    for i in range(250):
        text = [word(rng) for _ in range(rng.randint(0, 120))]
        a = rng.randrange(60)
        at = rng.randint(0, len(text))
        if i % 3 == 0:
            text[at:at] = passage[a:a + rng.choice([20, 34, 35, 36, 60])]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    docs += [(300, "same " * 50), (301, "a b " * 40), (302, docs[1][1]), (1, docs[1][1]), (1, docs[1][1]), (None, docs[3][1]), (303, None), (304, ""),
             (305, " ".join(passage[:34])), (306, " ".join(passage)), (307, " ".join(passage).upper())]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, home int").repartition(3)
    got = op10_repeats.remove_repeats(df, with_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(docs)
    for r in got:
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and all(s.end - s.start >= 35 for s in r.spans)
    assert op10_repeats.remove_repeats(df.where("false")).count() == 0


def test_repeats_of_a_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = op10_repeats.query(spark, "/root/testdata/sf0.001").collect()
    assert Counter(map(tuple, got)) == brute_repeats(docs)


def test_pipeline(spark):
    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline as pipeline

    from aerolith.llm import op1_toxicity, op6_shard, op7_decontaminate

    sf = "/root/testdata/sf0.001"
    docs = pipeline.table(spark, sf, "documents").withColumn("taken", pipeline.F.lit("x")).withColumn("__rid", pipeline.F.lit(1))
    columns = docs.columns
    model = op1_toxicity.fit(docs, pipeline.table(spark, sf, "labels"))
    steps = {}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = pipeline.written(stage(spark, docs, sf), "test-stage")
        steps[name] = (before, docs.collect())
        assert name == "sharding" or docs.columns == columns
        assert stage(spark, docs.where("false") if name != "sharding" else pipeline.table(spark, sf, "documents").where("false"), sf).count() == 0
    before, after = steps["toxicity"]
    scores = op1_toxicity.score(spark.createDataFrame(before, ", ".join(f"{c} string" if c in ("text", "lang", "source", "taken") else f"{c} long" for c in columns)), model)
    assert {r.doc_id for r in after} == {r.doc_id for r in scores.collect() if r.score < 0.7}
    before, after = steps["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before]
    least: dict = {}
    for (i, _), g in zip(rows, groups(rows), strict=True):
        least[g] = min(i, least.get(g, i))
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    before, after = steps["decontamination"]
    items = op7_decontaminate.index_items([(r.item_id, r.text) for r in pipeline.table(spark, sf, "benchmark").collect()])
    hit = {before[h[0]].doc_id for h in op7_decontaminate.leaks([r.text for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - hit
    before, after = steps["mixing"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before}
    assert set(Counter(r.doc_id for r in after).values()) <= {1, 2, 3}
    assert sum(size.values()) - max(size.values()) <= sum(size[r.doc_id] for r in after) <= sum(size.values())
    before, after = steps["sharding"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    total = Counter()
    for r in after:
        total[r.shard] += r.n_bytes
    assert max(total.values()) <= op6_shard.LIMIT_BYTES


def test_pipeline_stages_with_odd_rows(spark, tmp_dir):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing names through every stage; what each stage keeps is told apart by text."""
    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline as pipeline

    rng = random.Random(21)
    words = [f"w{i}" for i in range(4000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = say(40)
    plain = [say(60) for _ in range(60)]
    long = " ".join([plain[5]] * 1000)
    near = plain[0].split()
    near[30] = "changed"
    rows = [(i, t, "en", "a" if i % 3 else None, len(t)) for i, t in enumerate(plain)]
    rows += [(100, " ".join(near), "en", "a", 1), (101, plain[1], None, "b", None), (1, plain[1], "en", "a", len(plain[1]))]  # near, exact, a repeated row
    rows += [(102, None, None, None, None), (102, None, None, None, None), (None, None, "en", "a", 0), (103, "", "en", "b", 0), (104, "  \n", "en", "b", 3)]
    rows += [(None, say(50), "en", None, 5), (105, long, "en", "b", len(long)), (106, f"{say(30)} {item} {say(30)}", "en", "a", 9), (None, f"{item}", None, None, None)]
    insults = ["rotten scum " + say(25).replace("w", "insult") for _ in range(30)]
    rows += [(200 + i, t, "en", "a", 1) for i, t in enumerate(insults)]
    extra = [(*r, k, "x") for k, r in enumerate(rows)]
    docs = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars int, score int, shard string").repartition(5)
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(200 + i, 1, 1) for i in range(30)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(7, item), (None, None), (8, "")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, tmp_dir), "odd-stage")
        kept[name] = docs.collect()
        assert name == "sharding" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "shard"]
    texts = lambda name: Counter(r.text for r in kept[name])
    clean = Counter(r[1] for r in rows if r[1] not in insults)
    gone = Counter(r[1] for r in rows) - texts("toxicity")
    assert set(gone) <= set(insults) and len(gone) >= 20 and texts("toxicity") - clean == Counter(set(insults) - set(gone))  # rows without a text stay, too
    clean = texts("toxicity")
    copies = {" ".join(near): plain[0]}
    after = texts("near_dedup")
    assert {copies.get(t, t) for t in after} == {copies.get(t, t) for t in clean}
    assert all(n == 1 for t, n in after.items() if t and t.strip()) and after[None] == 3 and sum(after[t] for t in copies | {plain[0]: 1}) == 1
    without = texts("decontamination")
    assert set(after) - set(without) == {t for t in after if t and item in t} and all(without[t] == after[t] for t in without)
    mixed = texts("mixing")
    assert set(mixed) <= set(without) and max(mixed.values()) <= 3 and not any(t is None or not t.strip() for t in mixed)
    assert len(kept["sharding"]) == len(kept["mixing"]) and all(r.n_bytes <= r.shard_bytes for r in kept["sharding"])
