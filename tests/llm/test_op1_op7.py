"""Toxicity on held-out rows and clean rows; leaks against a brute-force comparison."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import op1_toxicity, op7_decontaminate
from aerolith.llm.common import table


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"  # some 2,600 rows to learn from
    got = op1_toxicity.query(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    out = [r for r in got if r.held_out]
    caught = [r.predicted for r in out if r.toxic]
    assert sum(caught) >= 0.8 * len(caught)
    assert sum(r.predicted for r in out if not r.toxic) <= 0.01 * len(out)


def test_pairs_of_terms_are_learnt(spark):
    """Toxic only if an insult meets a group: the linear weights alone cannot tell, the factors can."""
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = " ".join(rng.sample([f"w{k}" for k in range(50)], 6) + ["nitwit"] * insult + ["martians"] * group)
        rows.append((i, text, int(insult and group)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = op1_toxicity.fit(df, df)
    got = op1_toxicity.score(df, model).where(op1_toxicity.held_out(F.col("doc_id"))).collect()
    assert sum((r.score >= 0.5) != bool(r.toxic) for r in got) <= 0.02 * len(got)
    number = op1_toxicity.term_numbers(model.buckets)
    insult, group = (op1_toxicity.known_pairs([w], number)[1] for w in ("nitwit", "martians"))
    assert (model.factors[insult] @ model.factors[group].T).sum() > 0


def test_toxicity_of_odd_rows(spark):
    docs = [(i, "you idiot" if i % 2 else "kind words") for i in range(60)] + [(None, "you idiot"), (100, None), (101, ""), (102, "...")]
    docs += [(1, "you idiot"), (103, "idiot " * 200_000)]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    got = op1_toxicity.score(df, op1_toxicity.fit(df, labels)).collect()
    assert len(got) == len(docs)
    assert all((r.score >= 0.7) == ("idiot" in (r.text or "")) for r in got)
    odd = {r.score for r in got if r.doc_id in (100, 101, 102)}
    assert len(odd) == 1
    assert {r.score for r in op1_toxicity.score(df, op1_toxicity.fit(df, labels.where("toxic = 1"))).collect()} == {1.0}
    assert {r.score for r in op1_toxicity.score(df, op1_toxicity.fit(df.where("false"), labels)).collect()} == {0.0}
    assert op1_toxicity.score(df.where("false"), op1_toxicity.fit(df, labels)).count() == 0


def test_sample_is_bounded(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'t' as text", "cast(id % 2 as int) as toxic")
    n = op1_toxicity.training_rows(df, df, max_train=500).count()
    assert 400 < n < 600


@pytest.fixture(scope="module")
def contaminated(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [[word() for _ in range(rng.randint(15, 60))] for _ in range(30)]
    docs, leaks = [], set()
    for i in range(300):
        text = [word() for _ in range(rng.randint(0, 300))]
        if i % 3 == 0:
            k = rng.randrange(30)
            own = list(items[k])
            for p in range(rng.randrange(7), len(own), 8):  # every eighth word is another one
                own[p] = word()
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in own]
            leaks.add((i, k))
        elif i % 3 == 1:  # less than a leak
            k = rng.randrange(30)
            text += items[k][:6]
        docs.append((i, "  ".join(text)))
    bench = [(k, " ".join(x)) for k, x in enumerate(items)]
    return docs, bench, leaks


def test_leaks_with_substitutions(spark, contaminated):
    docs, bench, leaks = contaminated
    d = spark.createDataFrame([(*x, 3) for x in docs], "doc_id long, text string, item_id int").repartition(4)
    b = spark.createDataFrame([(*x, 3) for x in bench], "item_id long, text string, doc_id int")
    got = op7_decontaminate.find_leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    assert all(r.n_matching >= 0.8 * r.n_words for r in got)
    small = op7_decontaminate.find_leaks(d, b, chunk_words=200).collect()  # many passes, the same result
    assert sorted(map(tuple, small)) == sorted(map(tuple, got))
    kept = op7_decontaminate.without_leaks(d, b, chunk_words=200)
    assert sorted(map(str, kept.collect())) == sorted(map(str, op7_decontaminate.without_leaks(d, b).collect()))
    kept = op7_decontaminate.without_leaks(d, b)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in leaks}


def test_odd_leaks(spark):
    item = " ".join(f"item{k}" for k in range(20))
    b = spark.createDataFrame([(5, item), (3, item.upper()), (None, item), (6, None), (7, ""), (8, "one two"), (9, "p q r s t u")],
                              "item_id long, text string")
    d = spark.createDataFrame([(1, item), (1, item), (None, f"x {item} y {item}"), (2, None), (3, ""), (4, "one two"), (5, "a p q r s t u b"),
                               (6, "p q r s t v"), (7, "z " * 300_000 + item)], "doc_id long, text string")
    got = op7_decontaminate.find_leaks(d, b).collect()
    key = lambda r: str((r.doc_id, r.item_id, r.n_copies))
    assert sorted(map(key, got)) == sorted(map(str, [(1, 3, 3), (1, 3, 3), (None, 3, 3), (5, 9, 1), (7, 3, 3)]))
    assert next(r.start_word for r in got if r.doc_id == 7) == 300_000
    assert op7_decontaminate.without_leaks(d, b).count() == 4
    assert op7_decontaminate.find_leaks(d.where("false"), b).count() == 0
    assert op7_decontaminate.find_leaks(d, b.where("false")).count() == 0


def brute_overlap(text, item, shift):
    """The most matching words of the best stretches around the diagonal's matching words, or of all of it for 0.8 of the item."""
    match = [0 <= j + shift < len(text) and text[j + shift] == w for j, w in enumerate(item)]
    if sum(match) >= 0.8 * len(item):
        return sum(match)
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    total = {low: 0}
    for j in range(low, high):
        total[j + 1] = total[j] + (1 if match[j] else -3)
    best = 0
    for j in (j for j in range(low, high) if match[j]):
        start = min(range(low, j + 1), key=lambda x: (total[x], x))
        end = max(range(j + 1, high + 1), key=lambda x: (total[x], -x))
        best = max(best, sum(match[start:end]))
    return best


def test_second_stretch_of_a_diagonal():
    item = [f"w{k}" for k in range(60)]
    text = [w if k < 12 or 30 <= k < 50 else f"x{k}" for k, w in enumerate(item)]  # 12 words are too few, the 20 later ones a leak
    got = op7_decontaminate.leaks([" ".join(["y", *text])], op7_decontaminate.index_items([(1, " ".join(item))]))
    assert got == [(0, 0, 31, 20, 20)]


def test_overlap_of_a_whole_diagonal():
    rng = random.Random(6)
    for _ in range(300):
        item = np.arange(rng.randint(10, 70), dtype=np.uint64)
        share = rng.choice([0.5, 0.7, 0.85])
        text = np.array([w if rng.random() < share else 999 for w in item[rng.randrange(5): len(item) - rng.randrange(5)]], np.uint64)
        shift = rng.randint(-5, 2)
        text = np.roll(text, rng.choice([0, shift]))
        first, n, matching = op7_decontaminate.overlap(text, item, shift)
        assert matching == brute_overlap(text.tolist(), item.tolist(), shift)
        assert (item[first: first + n] == text[first + shift: first + n + shift]).sum() == matching


def most_without_hit(n):
    """For 0 to n words: the most that can match with no mask fully matched anywhere (all patterns, by the last words seen)."""
    span = max(map(len, op7_decontaminate.MASKS))
    best, out = {"": 0}, [0]
    for _ in range(n):
        longer: dict = {}
        for seen, count in best.items():
            for c in "01":
                last = (seen + c)[-span:]
                hit = any(len(m) <= len(last) and all(x <= y for x, y in zip(m, last[-len(m):], strict=True)) for m in op7_decontaminate.MASKS)
                if not hit:
                    longer[last] = max(longer.get(last, 0), count + int(c))
        best = longer
        out.append(max(best.values()))
    return out


def test_masks_hit_all_that_the_rule_allows():
    most = most_without_hit(60)
    for n in range(10, 61):
        assert most[n] < -(-4 * n // 5)  # the share of a whole item
        assert n < 13 or most[n] < max(13, (3 * n + 4) // 4)  # a stretch that gains more than it costs
    assert most[30] <= 22  # so longer patterns, cut into pieces of 30, stay below both, too


def test_random_substitutions_against_brute_force():
    rng = random.Random(8)
    items, texts, want = [], [], set()
    for i in range(1500):
        n = rng.choice([*range(5, 26), 40])
        items.append([f"i{i}w{k}" for k in range(n)])
        changed = set(rng.sample(range(n), rng.randint(0, -(-n // 3))))
        copy = [f"t{i}x{k}" if k in changed else w for k, w in enumerate(items[-1])]
        copy = copy[rng.choice([0, 0, 0, 2]):]
        before = [f"t{i}b{k}" for k in range(rng.randrange(4))]
        texts.append([*before, *copy, "end"])
        matching = max(brute_overlap(texts[-1], items[-1], s) for s in range(-3, 5))
        if matching >= (n if n < 10 else min(13, -(-4 * n // 5))):
            want.add((i, i, matching))
    got = op7_decontaminate.leaks([" ".join(t) for t in texts], op7_decontaminate.index_items([(i, " ".join(x)) for i, x in enumerate(items)]))
    assert {(d, i, m) for d, i, _, _, m in got} == want and len(want) > 500


def test_a_template_that_many_items_share_costs_no_loop():
    import time

    rng = random.Random(12)
    template = "answer the following question about the text below"
    own = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(30)) for _ in range(3000)]
    items = op7_decontaminate.index_items([(i, f"{template} {w}") for i, w in enumerate(own)])
    text = " ".join(f"{template} z{i} z{i + 1}" for i in range(60)) + " " + own[77]
    start = time.time()
    got = op7_decontaminate.leaks([text], items)
    assert [(d, i, m) for d, i, _, _, m in got] == [(0, 77, 30)] and time.time() - start < 5


def test_each_diagonal_once():
    rng = np.random.default_rng(3)
    for top in (5, 1 << 40):
        rows = np.stack([rng.integers(0, 4, 500), rng.integers(0, 4, 500), rng.integers(-3, 3, 500) * (top // 5)])
        assert (op7_decontaminate.each_once(rows) == np.unique(rows, axis=1)).all()
