"""Packing, collocations and the Merkle manifest against brute force, with nulls, ties, repeats, long texts and hot keys."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from aerolith.llm import op11_packing, op12_collocations, op13_manifest

# ---------------------------------------------------------------- 11


def histogram(rng, limit):
    return {w: rng.randint(1, rng.choice([2, 5, 50])) for w in rng.sample(range(1, limit + 1), rng.randint(1, limit))}


def least_sequences(items, limit):
    """The fewest sequences, by trying all (small instances)."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, limit - items[i]])

    go(0, [])
    return best[0]


def test_plan_packs_every_piece_between_the_bound_and_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        limit = rng.choice([10, 20, 50, 100])
        counts = histogram(rng, limit)
        plan = op11_packing.plan(dict(counts), limit)
        used = Counter()
        for lengths, k in plan:
            assert sum(lengths) <= limit and k > 0
            for w in lengths:
                used[w] += k
        assert used == Counter(counts)
        n = sum(k for _, k in plan)
        assert op11_packing.lower_bound(counts, limit) <= n <= sum(k for _, k in op11_packing.best_fit(counts, limit)) + 1


def test_best_fit_equals_the_piece_by_piece_rule():
    rng = random.Random(2)
    for _ in range(100):
        limit = rng.choice([10, 30, 64])
        counts = histogram(rng, limit)
        rooms = []
        for w in sorted((w for w, n in counts.items() for _ in range(n)), reverse=True):
            fits = [r for r in rooms if r >= w]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else limit) - w)
        grouped = [limit - sum(lengths) for lengths, k in op11_packing.best_fit(counts, limit) for _ in range(k)]
        assert sorted(grouped) == sorted(rooms)


def test_fixed_sets_keep_the_optimum():
    """Whatever the reduction fixes, the rest can still be packed into the fewest sequences of the whole."""
    rng = random.Random(3)
    fixed_any = 0
    for _ in range(150):
        limit = rng.choice([10, 17, 24])
        items = [rng.randint(1, limit) for _ in range(rng.randint(1, 9))]
        fixed, rest = op11_packing.reduce_(dict(Counter(items)), limit)
        fixed_any += bool(fixed)
        left = [w for w, n in rest.items() for _ in range(n)]
        assert sum(k for _, k in fixed) + least_sequences(left, limit) == least_sequences(items, limit)
    assert fixed_any > 100


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(4)
    encoder = op11_packing.WordEncoder(op11_packing.tokenizer_path())
    plain = [*"abs'S.,-<|>!0179 \n\t", "'ll", "'re", "''", "é", "\u0338", "ß", "漢"]
    letters = [*"ab'sS .,\n\t é́ΣςİI ß1٣漢字\U0001f600\x1c\x85 　", "<|endoftext|>", "<|startoftext|>", "'ll", "'re", "<|"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [None, "", "word " * 30000]
    ids, ends = encoder(texts)
    assert not encoder.at  # special tokens: whole texts
    texts2 = ["".join(rng.choice(plain) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [None, "", "Don't " * 30000, "<|EndOfText|> x"]
    ids2, ends2 = encoder(texts2)
    assert encoder.at
    ids, ends, texts = np.concatenate([ids, ids2]), np.concatenate([ends, ends[-1] + ends2]), texts + texts2
    begin = 0
    for text, end in zip(texts, ends.tolist(), strict=True):
        assert ids[begin:end].tolist() == encoder.whole([text or ""])[0].tolist() + [0], text
        begin = end


def packed_rows(spark, texts, limit, **how):
    rows = [(i, t, "x", 1) for i, t in texts]
    return op11_packing.pack(spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, offset int").repartition(5), limit, **how)


def test_packed_documents(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["the", "cat", "sat", "quuxly", "a1"]) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    texts += [(900, None), (901, ""), (902, "the " * 200), (902, "the " * 200), (None, "cat")] + [(i, "the cat") for i in range(1000, 1300)]
    limit = 64
    packed = packed_rows(spark, texts, limit, with_ids=True).cache()
    rows = packed.collect()
    encoder = op11_packing.WordEncoder(op11_packing.tokenizer_path())
    want = Counter()
    for i, t in texts:
        ids = encoder.whole([t or ""])[0].tolist() + [0]
        for p in range(0, len(ids), limit):
            cut = ids[p : p + limit]
            want[i, p // limit, p, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut)), tuple(cut)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for of in places.values():
        end = 0
        for offset, length in sorted(of):
            assert offset == end
            end += length
        assert end <= limit
    bound = op11_packing.lower_bound(Counter(r.length for r in rows), limit)
    assert bound <= len(places) <= bound + 1
    built = {r.sequence_id: r.ids for r in op11_packing.sequences(packed).collect()}
    by_place = {(r.sequence_id, r.offset): r.ids for r in rows}
    assert all(ids == [x for offset, _ in sorted(places[s]) for x in by_place[s, offset]] for s, ids in built.items())
    assert len(built) == len(places)
    assert packed_rows(spark, texts[:1], limit).where("false").count() == 0
    assert op11_packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- 12


def mined(docs, threshold, share, top):
    f, n = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = []
        for p, a in count.items():
            if len(p) < 2 or a < threshold:
                continue
            if len(p) == 2 and any(len(q) == 3 and b >= threshold and p in (q[:2], q[1:]) and 100 * b >= share * a for q, b in count.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def phrase_docs():
    rng = random.Random(6)
    vocabulary = ["The", "new", "YORK", "city", "of", "the", "été", "ÉTÉ", "x-1", "漢字", " ", "a b"]
    docs = []
    for _ in range(150):
        words = rng.choices(vocabulary, weights=[30, 5, 5, 4, 8, 20, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 25))
        docs.append((rng.choice(["en", "fr", None, "und"]), "".join(w + rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "\x0b", " "]) for w in words)))
    docs += [("en", None), (None, ""), ("en", " .,. "), ("de", "new york city"), ("fr", "the new york city of " * 2000)] + [("en", "copy of a copy of it")] * 40
    return docs


@pytest.mark.parametrize(("shards", "slots", "threshold"), [(1, 1 << 12, 3), (2, 16, 2), (3, 8, 10), (4, 1 << 12, 5)])
def test_collocations(spark, monkeypatch, shards, slots, threshold):
    """Few slots mean that many phrases are counted too early or too long."""
    docs = phrase_docs()
    monkeypatch.setattr(op12_collocations, "PIECE_BYTES", 300)
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "lang string, text string, n int, word string").repartition(3)
    words, pairs, triples = op12_collocations.mine(df, threshold, shards, slots)
    counts = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (2, 3):
                counts.update((lang or "und", k, *w[i : i + k]) for i in range(len(w) - k + 1))
    name = {r.code: (r.lang, r.word) for r in words.collect()}
    got = {(name[r.c1][0], 2, name[r.c1][1], name[r.c2][1]): r.n for r in pairs.collect()}
    got |= {(name[r.c1][0], 3, *(name[c][1] for c in (r.c1, r.c2, r.c3))): r.n for r in triples.collect()}
    assert got == {p: n for p, n in counts.items() if n >= threshold}


def test_collocation_report(spark):
    docs = phrase_docs()
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "lang string, text string, rank int, phrase string")
    got = op12_collocations.collocations(df, threshold=4, share=50, top=12)
    assert sorted(map(tuple, got.collect())) == mined(docs, 4, 50, 12)
    assert op12_collocations.collocations(df.where("false")).count() == 0
    assert op12_collocations.collocations(df.where("lang = 'de'")).count() == 0


def test_equal_codes_start_anew(spark, monkeypatch):
    honest = op12_collocations.codes_of
    monkeypatch.setattr(op12_collocations, "codes_of", lambda words, lang, seed: honest(words, lang, seed) if seed else honest(words, lang, seed) * 0 + 1)
    docs = [("en", "big cat sat")] * 12
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(map(tuple, op12_collocations.collocations(df).collect())) == mined(docs, 10, 50, 2000)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3 * 10**12 + 1, 4 * 10**12 + 7, 5 * 10**12 + 3
    row = spark.range(1).select(op12_collocations.score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row.s == 10**6 * a * a // (left * right)


# ---------------------------------------------------------------- 13


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, strip=False):
    text = row[4].replace("\n", "") if strip and row[4] is not None else row[4]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in [*row[:4], text]))


def proofs(nodes, fanout):
    """The root, and for each node its siblings by level as (left, right)."""
    at, path = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // fanout * fanout : a // fanout * fanout + fanout]
            path[i].append(("".join(run[: a % fanout]), "".join(run[a % fanout + 1 :])))
        nodes = [sha(*nodes[j : j + fanout]) for j in range(0, len(nodes), fanout)]
        at = [a // fanout for a in at]
    return nodes[0], path


def manifested(rows, fanout=3):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner[g] = proofs([leaf(r) for r in groups[g]], fanout)
    root, outer = proofs([inner[g][0] for g in order], fanout)
    out = []
    for g, top in zip(order, outer, strict=True):
        for r, path in zip(groups[g], inner[g][1], strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            digest = leaf(r, strip=hit)
            for left, right in path + top:
                digest = sha(left, digest, right)
            out.append((r[0], leaf(r), inner[g][0], root, sha(*(x for p in path + top for x in p)), digest, digest == root))
    return sorted(out, key=str)


def manifest_rows(spark, rows, fanout=3):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, source string, lang string, n_chars int, text string, k string, idx int").repartition(4)
    m = op13_manifest.manifest(df, fanout=fanout)
    folded = op13_manifest.fold(F.coalesce("torn", "leaf"), F.col("path"))
    out = m.select("id", "leaf", "subroot", "root", op13_manifest.proof_digest(F.col("path")), folded, folded == F.col("root"))
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(spark, fanout):
    rng = random.Random(7)
    sources = ["hot"] * 10 + ["", "é", "z", None, "a", "=", "hot2"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "one\ntwo", "plain é漢", "\n\n"])) for i in range(140)]
    rows += [(None, "hot", None, None, None), (None, "hot", "en", 1, "a\nb"), (5000, "lone", "en", 3, "x\ny"), (-7, "a", "en", 3, "long\n" * 50000)]
    got = manifest_rows(spark, rows, fanout)
    assert got == manifested(rows, fanout)
    assert {r[-1] for r in got} == {True, False}


def test_small_manifests(spark):
    for rows in ([(1, "a", None, None, "x")], [(2, None, "en", 1, "x\ny")], [(i, str(i), "en", 1, "t") for i in range(5)], [(i, "a", "en", 1, "t") for i in range(9)]):
        assert manifest_rows(spark, rows) == manifested(rows)
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string")
    assert op13_manifest.manifest(df).count() == 0


def test_repeated_rows_have_valid_proofs(spark):
    rows = [(3, "a", "en", 4, "same")] * 20 + [(4, "a", "en", 4, "same")] * 7
    got = manifest_rows(spark, rows)
    assert len(got) == 27 and all(r[-1] for r in got)
    assert Counter(r[4] for r in got) == Counter(r[4] for r in manifested(rows))
