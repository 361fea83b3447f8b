"""Phrase collocation mining by dynamic itemset counting.

The texts are dealt into ``SHARDS`` shards, which are scanned in a cycle.  One scan of a shard counts phrases of all lengths at once: words from
the first scan on, a longer phrase from the scan on after both of its subphrases (all but the last word, all but the first)
reached the threshold, and each until it has seen every shard once.  So frequent phrases of three words are being counted while
rarer words still are, and a phrase that cannot reach the threshold is never counted.  Scans go on until no phrase is open:
at most ``SHARDS`` times the largest length.

Counts are kept for each shard of a phrase apart, and a shard's count is the same in each scan of it.  That makes
the activation safe: tasks read it from a table of ``SLOTS`` bytes (the scan before which the latest phrase of a slot was
activated), so that they may count some phrases too early or too long, never too late.  A phrase counted twice in a
shard has one count of it, and a phrase counted too early has a subphrase below the threshold, so its own
counts cannot reach it.  The table has a fixed size, whatever the corpus; larger vocabularies only make it less strict.

Tasks find words by vector operations over an Arrow batch and give each word a 64-bit code (of language and word); a phrase is its
words' codes.  That no two words share a code is checked on the table of all words; if two did, the job starts anew with other
codes, so the counts are exact.  Tasks count before they write, then Spark adds up by phrase: a very common word is one row for each batch.
A phrase that is complete and below the threshold leaves the open table at once; the driver holds the slot table and numbers.

Defined results: a null or empty text has no words; a null language is ``und`` (and one of that name is the same); a language without
candidates gives no rows; repeated rows count each; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import discard, running_sum, scratch, table, written
from aerolith.llm.textvec import U, mix
from aerolith.llm.textvec import pieces as text_pieces

THRESHOLD = 10
LONGEST = 3
TOP = 2000
#: Shards of a cycle.  More of them activate phrases earlier, fewer add up less often.
SHARDS = 2
#: Bytes of the activation table.
SLOTS = 1 << 23
#: Bytes of text that are counted together (one text at least).
PIECE_BYTES = 1 << 24
#: A longer phrase with at least this share (in hundredths) of a candidate's occurrences takes its place.
SHARE = 50
NO_LANG = "und"
_BLANK, _BREAK = 1, 2


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """What each byte is (fixed by the contract), and its lower case."""
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kind[[0x20, 0x09]] = _BLANK
    kind[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
    lower[65:91] += 32
    return kind, lower


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.LargeStringArray, np.ndarray]:
    """The number of each word among the distinct ones, these, and whether each word follows the one before it in one piece."""
    kind, lower = _classes()
    data = lower[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    what = kind[data]
    inside = what == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.cumsum(what == _BREAK, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    follows = np.zeros(len(start), bool)
    follows[1:] = breaks[1:] == breaks[:-1]
    return coded.indices.to_numpy(), coded.dictionary, follows


def codes_of(words: pa.LargeStringArray, lang: str, seed: int) -> np.ndarray:
    """64-bit codes of words in a language."""
    import xxhash

    own = xxhash.xxh64_intdigest(lang.encode(), seed)
    return np.fromiter((xxhash.xxh64_intdigest(w, own) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words)).view(np.int64)


def slot_of(codes: list[np.ndarray], slots: int) -> np.ndarray:
    """The slots of phrases, given by a column of codes for each place."""
    x = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        x = mix(x ^ c.view(np.uint64), 3)
    return (x % U(slots)).astype(np.int64)


_KEYS = ["c1", "c2", "c3", "word"]
_SCHEMA = "c1 long, c2 long, c3 long, word string, n long, ready int"
#: Between language and word in the column ``word``: no language has it, no word of a text could be taken for one.
_SEP = "\t"
#: Rows that a task hands over at a time.
HAND_OVER = 1 << 16


def counter(scan: int, seed: int, known, shards: int, slots: int):
    """A function for ``mapInArrow`` over (lang, text): the phrases of each batch that scan number ``scan`` counts.

    ``known``: a broadcast of the activation tables of words and of pairs (0: not active).  ``ready`` is the scan after which
    a phrase has surely seen each shard.
    """

    def count(batches):
        of_words, of_pairs = known.value
        for batch in batches:
            for a, b in text_pieces(batch.column(1), PIECE_BYTES):
                langs = batch.column(0).slice(a, b - a).dictionary_encode()
                which = langs.indices.to_numpy()
                texts = batch.column(1).slice(a, b - a)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    own = texts.filter(pa.array(which == i)).cast(pa.large_binary()).to_pylist()
                    yield from phrases(own, lang, of_words, of_pairs)

    def phrases(texts, lang, of_words, of_pairs):
        at, words, follows = words_of(texts)
        if not len(at):
            return
        code = codes_of(words, lang, seed)
        if scan < shards:  # each word sees each shard once
            yield from rows([code], np.bincount(at, minlength=len(words)), shards - 1, lang, words)
        if not scan:
            return
        # Pairs of active words follow each other in ``place``; each different one has a number.
        width = len(words)
        since = of_words[slot_of([code], slots)].astype(np.int32)
        place = np.flatnonzero(follows[1:] & (since[at[:-1]] > 0) & (since[at[1:]] > 0))
        keys, which = np.unique(at[place].astype(np.int64) * width + at[place + 1], return_inverse=True)
        one, two = keys // width, keys % width
        latest = np.maximum(since[one], since[two])
        now = latest > scan - shards
        if now.any():
            yield from rows([code[one[now]], code[two[now]]], np.bincount(which, minlength=len(keys))[now], latest[now] + shards - 1)
        # Triples of active pairs, by the number of the first pair and the last word.
        since = of_pairs[slot_of([code[one], code[two]], slots)].astype(np.int32)
        number = np.full(len(at), -1, np.int32)
        number[place] = which
        first = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
        left, right = since[number[first]], since[number[first + 1]]
        first = first[(left > 0) & (right > 0) & (np.maximum(left, right) > scan - shards)]
        triples, example, n = np.unique(number[first].astype(np.int64) * width + at[first + 2], return_index=True, return_counts=True)
        if len(triples):
            first = first[example]
            latest = np.maximum(since[number[first]], since[number[first + 1]])
            yield from rows([code[at[first + i]] for i in range(3)], n, latest + shards - 1)

    def rows(codes, n, ready, lang=None, words=None):
        for i in range(0, len(n), HAND_OVER):
            part = slice(i, i + HAND_OVER)
            size = len(n[part])
            cols = [pa.array(codes[k][part]) if k < len(codes) else pa.nulls(size, pa.int64()) for k in range(LONGEST)]
            cols += [pa.nulls(size, pa.string()) if words is None else pc.binary_join_element_wise(lang, words.slice(i, HAND_OVER).cast(pa.string()), _SEP)]
            cols += [pa.array(n[part], pa.int64()), pa.array(ready[part] if isinstance(ready, np.ndarray) else np.full(size, ready), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[*_KEYS, "n", "ready"])

    return count


class SameCode(Exception):
    """Two words have one code."""


def slot_table(phrases: DataFrame, codes: list[str], slots: int) -> np.ndarray:
    """The activation table of ``phrases`` (codes, since): the latest scan of each slot.  At most ``slots`` / 8 rows reach the driver."""

    def to_slots(batches):
        for batch in batches:
            at = slot_of([batch.column(i).to_numpy() for i in range(len(codes))], slots)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(len(codes))], names=["slot", "since"])

    slot = phrases.select(*codes, F.col("since").cast("int")).mapInArrow(to_slots, "slot long, since int")
    each = slot.groupBy("slot").agg(F.max("since").alias("since"))
    byte = F.call_function("shiftleft", F.col("since").cast("long"), (F.col("slot") % 8 * 8).cast("int"))
    packed = each.groupBy(F.floor(F.col("slot") / 8).cast("long").alias("at")).agg(F.sum(byte).alias("bytes")).toArrow()
    out = np.zeros(slots // 8, np.int64)
    out[packed["at"].to_numpy()] = packed["bytes"].to_numpy()
    return out.view(np.uint8)


def mine(docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words of ``docs`` (lang, text): code, lang, word, n; and the phrases of two and of three words that occur ``threshold`` times or more: c1, c2, n and c1, c2, c3, n."""
    spark = docs.sparkSession
    dealt = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"))
    path = scratch(spark, "phrase-shards")
    dealt.write.partitionBy("shard").parquet(path)
    texts = spark.read.schema("lang string, text string, shard int").parquet(path)
    seed = 0
    while True:
        try:
            out = scans(texts, threshold, shards, slots, seed)
            break
        except SameCode:
            seed += 1
    discard(texts)
    return out


#: No scan has this number.
_NEVER = 255


def mark(ready: Column, since: Column) -> Column:
    """Both in one number, so that the least one has the first ``ready`` and its ``since``."""
    return ready.cast("long") * (_NEVER + 1) + since


def scans(texts: DataFrame, threshold: int, shards: int, slots: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cycle.  A state table holds the phrases of all lengths: their codes, language and word (of words), n0, n1, ... (counts by shard),
    ready, and since, the scan from which they count as reaching the threshold, which lets longer phrases be counted.  Phrases whose
    ``ready`` scan is over are put aside; the open ones go on to the next state."""
    spark = texts.sparkSession
    counts = [f"n{i}" for i in range(shards)]
    none = F.lit(None).cast("long")
    total = sum((F.coalesce(c, F.lit(0)) for c in counts), F.lit(0).cast("long"))
    a_word, a_pair, a_triple = F.col("c2").isNull(), F.col("c2").isNotNull() & F.col("c3").isNull(), F.col("c3").isNotNull()
    state = open_ = done = None
    tables = [np.zeros(slots, np.uint8)] * 2
    for scan in range(LONGEST * shards):
        known = spark.sparkContext.broadcast(tables)
        here = texts.where(F.col("shard") == scan % shards).select("lang", "text").mapInArrow(counter(scan, seed, known, shards, slots), _SCHEMA)
        rows = here.select(*_KEYS, *[none.alias(c) for c in counts], mark(F.col("ready"), F.lit(_NEVER)).alias("mark"), F.col("n").alias("now"))
        if open_ is not None:
            rows = rows.unionByName(open_.select(*_KEYS, *counts, mark(F.col("ready"), F.coalesce("since", F.lit(_NEVER))).alias("mark"), none.alias("now")))
        # Tasks have counted their rows, so these are dealt by phrase before they are added up.
        # A shard that was scanned before has the same count as then: the larger one holds.
        now = counts[scan % shards]
        merged = rows.repartition("c1", "c2", "c3").groupBy(*_KEYS).agg(
            *[(F.greatest(F.max(c), F.sum("now")) if c == now else F.max(c)).alias(c) for c in counts], F.min("mark").alias("mark"))
        frequent = total >= threshold
        since = F.col("mark") % (_NEVER + 1)
        merged = merged.select(*_KEYS, *counts, F.floor(F.col("mark") / (_NEVER + 1)).cast("int").alias("ready"),
                               F.when(since < _NEVER, since.cast("int")).when(frequent, F.lit(scan + 1)).alias("since"))
        last, state = state, written(merged.where(frequent | (F.col("ready") > scan) | a_word), "phrase-state")  # complete phrases below the threshold go
        open_ = state.where(F.col("ready") > scan)
        closed = written(state.where(F.col("ready") <= scan), "phrase-closed")
        if last is not None:
            discard(last)
        done = closed if done is None else done.unionByName(closed)
        every = done.unionByName(open_)
        known.unpersist()
        if scan == shards - 1:
            n, different = every.where(a_word).agg(F.count(F.lit(1)), F.count_distinct("c1")).first()
            if n != different:
                raise SameCode
        of_words, of_pairs = tables
        if scan < shards:
            of_words = slot_table(every.where(a_word & F.col("since").isNotNull()).select("c1", "since"), ["c1"], slots)
        if 0 < scan < 2 * shards:
            of_pairs = slot_table(every.where(a_pair & F.col("since").isNotNull()).select("c1", "c2", "since"), ["c1", "c2"], slots)
        tables = [of_words, of_pairs]

    def found(which: Column, codes: list[str]) -> DataFrame:
        """Codes and n; a phrase that was opened again by another's slot is in two tables, with counts of the same shards."""
        once = every.where(which & F.col("since").isNotNull()).groupBy(*codes).agg(*[F.max(c).alias(c) for c in counts])
        return once.select(*codes, total.alias("n")).where(F.col("n") >= threshold)

    parts = F.split("word", _SEP, 2)
    words = every.where(a_word).select(F.col("c1").alias("code"), parts[0].alias("lang"), parts[1].alias("word"), total.alias("n"))
    return words, found(a_pair, ["c1", "c2"]), found(a_triple, ["c1", "c2", "c3"])


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: at most 1000000, as no part occurs less often than the whole."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (F.lit(1000000).cast("decimal(7,0)") * wide(a)).cast("decimal(38,0)") * wide(a)
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)")).cast("long")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, share: int = SHARE, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best candidates of each language of ``docs`` (lang, text)."""
    words, pairs, triples = mine(docs, threshold, shards)
    pairs, triples = written(pairs, "phrase-frequent"), written(triples, "phrase-frequent")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = words.where(F.col("n") >= threshold)
    word = lambda i: known.select(F.col("code").alias(f"c{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"f{i}"))

    # A pair that a triple holds goes if the triple is frequent enough; each pair is held to its most frequent triple.
    holds = triples.select(F.explode(F.array(F.struct("c1", "c2"), F.struct(F.col("c2").alias("c1"), F.col("c3").alias("c2")))).alias("p"), "n")
    holds = holds.groupBy(F.col("p.c1").alias("c1"), F.col("p.c2").alias("c2")).agg(F.max("n").alias("longer"))
    two = pairs.join(holds, ["c1", "c2"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("n") * share, F.lit(True)))
    two = two.join(known.select(F.col("code").alias("c1"), "lang", F.col("word").alias("w1"), F.col("n").alias("f1")), "c1").join(word(2), "c2")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"),
                     score(F.col("n"), F.col("f1"), F.col("f2")).alias("score"))

    three = triples.join(pairs.select("c1", "c2", F.col("n").alias("f12")), ["c1", "c2"])
    three = three.join(pairs.select(F.col("c1").alias("c2"), F.col("c2").alias("c3"), F.col("n").alias("f23")), ["c2", "c3"])
    three = three.join(known.select(F.col("code").alias("c1"), "lang", F.col("word").alias("w1"), F.col("n").alias("f1")), "c1")
    three = three.join(word(2).drop("f2"), "c2").join(word(3), "c3")
    cut = lambda k, left, right: F.struct(score(F.col("n"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    three = three.withColumn("cut", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")

    # Ranks from range-partitioned counts: the candidates of a large language are not sorted in one task.
    every = two.unionByName(three).withColumns({"down": -F.col("score"), "less": -F.col("a"), "one": F.lit(1).cast("long")})
    ranked = running_sum(written(every, "phrase-candidates"), ["lang"], ["down", "less", "phrase"], "one", "rank", "phrase-rank").where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '{NO_LANG}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT id, lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
lists AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, CAST(len(w) AS BIGINT) - k + 2)]) AS phrase
  FROM lists, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
cuts AS (
  SELECT f.lang, f.k, f.phrase, f.a, c.c, string_split(f.phrase, ' ') AS w FROM f, (SELECT unnest([1, 2]) AS c) c WHERE c.c < f.k),
parts AS (
  SELECT c.*, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.c], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1:], ' ')),
worst AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (
  SELECT lang, p AS phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS p
    FROM f WHERE k = 3) GROUP BY ALL),
kept AS (SELECT w.* FROM worst w LEFT JOIN held h ON w.k = 2 AND h.lang = w.lang AND h.phrase = w.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < {SHARE} * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
