"""Benchmark decontamination by spaced-seed hashing.

A mask fixes which of the words in a window count; a window's seed is the hash of these words alone, so
substitutions at the other places do not matter.  Seeds of every window of every training
text meet the seeds of the benchmark items (for each of ``MASKS``).  A hit opens its diagonal: text and
item are compared word by word along all of it.  Matches gain 1, substitutions cost ``PENALTY``; around each matching word lies
a best stretch, and the one with the most matching words is the diagonal's overlap, whichever hit led there.  It is a leak if
LEAK_WORDS words match in it, or LEAST_SHARE of the item.

Recall is whole for words replaced one for one: wherever the substitutions lie, a diagonal that is a leak by this rule has a
hit.  Such a stretch of n words has more than 3/4 n matches; without a hit, n words have at most 22 matches
for n = 30, and fewer than the rule asks for at each shorter length (tests/llm counts them), so by adding up pieces
at no length.  Insertions and deletions move the rest of a copy to another diagonal, and each diagonal is judged alone.

Words are lower-cased runs of ASCII letters, digits, underscores and characters that are not ASCII.  Items
go out to the tasks in chunks of at most ``CHUNK_WORDS`` words, counted beforehand; each chunk is one pass over
the texts.  The driver and the tasks hold one chunk at a time: the hits of a chunk are written before the next one is read.
Nothing of the training texts is shuffled.

Defined results: null, empty and wordless texts and items hit nothing; items with equal words are one item, shown by
the smallest item_id and the number of its copies; items under ``WHOLE_UNDER`` words must occur as a
whole, and items under ``MIN_WORDS`` words never count as leaks; each repeated text row has rows of its
own; a null doc_id stays null; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import running_sum, small, table, written
from aerolith.llm.textvec import U, Words, mix, pieces

#: Fixed masks: 1 counts, 0 is ignored.  Found by a greedy search for a set that every leak hits, of the largest weight
#: that a few masks allow: five words count, so common word pairs alone never hit.
MASKS = ("111011", "110100011", "11111")
PENALTY = 3
#: Matching words in one stretch that make a leak, whatever the item's length; else this share of the item's words.
LEAK_WORDS = 13
LEAST_SHARE = 0.8
MIN_WORDS = 5
#: Items of fewer words must occur as a whole.
WHOLE_UNDER = 10
CHUNK_WORDS = 1 << 18
FILTER_BITS = 22
#: Word pairs that are compared, or hits that are listed, at a time.
PAIRS = 1 << 20


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The seed of each window of ``h`` under ``mask``."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out = out * U(0xD6E8FEB86659FD93) + h[i: i + n]
    return mix(out, len(mask))


def masks_for(n: int) -> list[str]:
    """The masks for an item of ``n`` words: the fixed ones, or one window over all of a short item."""
    return list(MASKS) if n >= WHOLE_UNDER else ["1" * n]


@dataclass
class Items:
    """A chunk of benchmark items: their words one after another, and for each mask the seeds with their places."""

    ids: list
    copies: list
    words: np.ndarray
    first: np.ndarray  # of each item, and the end
    places: dict  # mask: (sorted seeds, item, position, filter)


def index_items(rows: list[tuple]) -> Items:
    """From (item_id, text): items of equal words become one."""
    words = Words([t for _, t in rows])
    same: dict[bytes, list] = {}
    for i, (item_id, _) in enumerate(rows):
        own = words.hash[words.first[i]: words.first[i + 1]]
        if len(own) >= MIN_WORDS:
            same.setdefault(own.tobytes(), []).append(item_id)
    parts = [np.frombuffer(k, np.uint64) for k in same]
    ids = [min((x for x in v if x is not None), default=None) for v in same.values()]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    found: dict[str, list] = {}
    for i, p in enumerate(parts):
        for m in masks_for(len(p)):
            s = seeds(p, m)
            found.setdefault(m, []).append((s, np.full(len(s), i), np.arange(len(s))))
    places = {}
    for m, v in found.items():
        s, item, at = (np.concatenate(x) for x in zip(*v, strict=True))
        order = np.argsort(s, kind="stable")
        passes = np.zeros(1 << FILTER_BITS, bool)
        passes[s >> U(64 - FILTER_BITS)] = True
        places[m] = (s[order], item[order], at[order], passes)
    return Items(ids, [len(v) for v in same.values()], np.concatenate([*parts, np.zeros(0, np.uint64)]), first, places)


def overlap(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(first word in the item, words, matching words) of the stretch with the most matching words when item word j lies
    on text word j + shift, of the best stretches around each matching word; if LEAST_SHARE of the whole
    item matches there, all of it that matches."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    match = item[low:high] == text[low + shift: high + shift]
    if match.sum() >= LEAST_SHARE * len(item):
        at = np.flatnonzero(match)
        return low + int(at[0]), int(at[-1] - at[0]) + 1, len(at)
    n = len(match)
    total = np.concatenate([[0], np.cumsum(np.where(match, 1, -PENALTY))])
    # of each word: the first place of the least total up to it, and of the largest total after it
    before, after = total[:-1], total[:0:-1]
    lower = np.concatenate([[True], before[1:] < np.minimum.accumulate(before)[:-1]])
    higher = np.concatenate([[True], after[1:] >= np.maximum.accumulate(after)[:-1]])
    start = np.maximum.accumulate(np.where(lower, np.arange(n), 0))
    end = (n - np.maximum.accumulate(np.where(higher, np.arange(n), 0)))[::-1]
    counted = np.concatenate([[0], np.cumsum(match)])
    matching = np.where(match, counted[end] - counted[start], 0)
    k = int(np.argmax(matching))
    return low + int(start[k]), int(end[k] - start[k]), int(matching[k])


def enough(matching: int, n_item: int) -> bool:
    if n_item < WHOLE_UNDER:
        return matching == n_item
    return matching >= min(LEAK_WORDS, int(np.ceil(LEAST_SHARE * n_item)))


def diagonals(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, shift) of every diagonal with a seed hit, each once, as columns."""
    found = [np.zeros((3, 0), np.int64)]
    for mask, (keys, item_of, place_of, passes) in items.places.items():
        s = seeds(words.hash, mask)
        at = np.flatnonzero(passes[s >> U(64 - FILTER_BITS)])
        at = at[words.doc[at] == words.doc[at + len(mask) - 1]]
        left, right = np.searchsorted(keys, s[at], "left"), np.searchsorted(keys, s[at], "right")
        for some in np.array_split(np.flatnonzero(right > left), max(1, int((right - left).sum()) // PAIRS)):
            n = right[some] - left[some]
            hit = np.repeat(left[some] - np.cumsum(n) + n, n) + np.arange(n.sum())  # the places of all equal seeds
            p = np.repeat(at[some], n)
            doc = words.doc[p]
            found.append(each_once(np.stack([doc, item_of[hit], p - words.first[doc] - place_of[hit]])))
    return tuple(each_once(np.concatenate(found, axis=1)))


def each_once(rows: np.ndarray) -> np.ndarray:
    """The different columns of ``rows`` (three numbers each), in order: as one number each where that fits."""
    if not rows.shape[1]:
        return rows
    low = rows.min(axis=1)
    span = [int(x) for x in rows.max(axis=1) - low + 1]
    if span[0] * span[1] * span[2] >= 1 << 62:
        return np.unique(rows, axis=1)
    r = rows - low[:, None]
    one = np.unique((r[0] * span[1] + r[1]) * span[2] + r[2])
    return np.stack([one // (span[1] * span[2]), one // span[2] % span[1], one % span[2]]) + low[:, None]


def may_leak(words: Words, items: Items, doc: np.ndarray, item: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Which diagonals have as many matching words in all as a leak needs; an overlap is never more."""
    size = np.diff(items.first)[item]
    low = np.maximum(0, -shift)
    n = np.minimum(size, words.first[doc + 1] - words.first[doc] - shift) - low
    total = np.zeros(len(doc), np.int64)
    for some in np.array_split(np.arange(len(doc)), max(1, int(n.sum()) // PAIRS)):
        if len(some):
            within = np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            own = np.repeat(items.first[item[some]] + low[some], n[some]) + within
            there = np.repeat(words.first[doc[some]] + low[some] + shift[some], n[some]) + within
            same = np.concatenate([[0], np.cumsum(items.words[own] == words.hash[there])])
            ends = np.cumsum(n[some])
            total[some] = same[ends] - same[ends - n[some]]
    needed = np.minimum(LEAK_WORDS, np.ceil(LEAST_SHARE * size))
    return total >= np.where(size < WHOLE_UNDER, size, needed)


def leaks(texts, items: Items) -> list[tuple]:
    """(text number, item number, first word in the text, words, matching words): the best leak of each pair.

    All diagonals of a piece of the texts are found and counted by vector operations, so a passage that many items share costs
    no loop; only those that can be leaks are looked at one by one.
    """
    out = []
    for start, end in pieces(texts):
        words = Words(texts[start:end])
        best: dict[tuple, tuple] = {}
        doc, item, shift = diagonals(words, items)
        able = may_leak(words, items, doc, item, shift)
        for d, i, s in zip(doc[able].tolist(), item[able].tolist(), shift[able].tolist(), strict=True):
            own = items.words[items.first[i]: items.first[i + 1]]
            first, n, matching = overlap(words.hash[words.first[d]: words.first[d + 1]], own, s)
            if enough(matching, len(own)) and matching > best.get((d, i), (0, 0, 0))[2]:
                best[d, i] = (first + s, n, matching)
        out += [(start + d, i, *v) for (d, i), v in sorted(best.items())]
    return out


def chunks(items: DataFrame, limit: int = CHUNK_WORDS) -> Iterator[Items]:
    """The benchmark (item_id, text) in chunks of at most ``limit`` words, or one longer item."""
    rows = items.where("text is not null").select("item_id", "text", F.size(F.split("text", r"\s+")).cast("long").alias("n"))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total <= limit:
        parts = [rows]
    else:
        dealt = running_sum(rows, [], ["item_id", "text"], "n", "sent", "benchmark-words")
        dealt = dealt.withColumn("part", F.floor((F.col("sent") - 1) / limit))
        parts = [dealt.where(F.col("part") == i) for i in range(-(-total // limit))]
    for part in parts:
        yield index_items([(r.item_id, r.text) for r in part.select("item_id", "text").collect()])


HITS = "item_id long, n_copies int, start_word long, n_words int, n_matching int"


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, item_id, n_copies, start_word, n_words, n_matching: one row for each text row and item that leaks into it.

    With more than one chunk the hits of each are written before the next one is read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    found = None
    for chunk, last in with_last(chunks(benchmark, chunk_words)):
        held = spark.sparkContext.broadcast(chunk)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = held.value
            for batch in batches:
                hits = leaks(batch.column("text"), items)
                ids = batch.column("doc_id")
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([h[0] for h in hits], pa.int64())),
                    pa.array([items.ids[h[1]] for h in hits], pa.int64()),
                    pa.array([items.copies[h[1]] for h in hits], pa.int32()),
                    *(pa.array([h[k] for h in hits], t) for k, t in ((2, pa.int64()), (3, pa.int32()), (4, pa.int32())))],
                    ["doc_id", "item_id", "n_copies", "start_word", "n_words", "n_matching"])

        part = rows.mapInArrow(run, f"doc_id long, {HITS}")
        if not last or found is not None:
            part = written(part, "leaks")
            held.unpersist()
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all their columns.

    One chunk is one pass.  With more of them the rows are numbered and written, each chunk's leaking rows are written, and these go in the end.
    """
    spark = docs.sparkSession
    rid = "__leak_rid"
    while rid in docs.columns:
        rid += "_"
    stored = gone = None
    for chunk, last in with_last(chunks(benchmark, chunk_words)):
        held = spark.sparkContext.broadcast(chunk)

        def hit(batch: pa.RecordBatch, held=held) -> np.ndarray:
            leaking = np.zeros(batch.num_rows, bool)
            leaking[[h[0] for h in leaks(batch.column(text_col), held.value)]] = True
            return leaking

        if last and stored is None:
            def keep(batches: Iterator[pa.RecordBatch], hit=hit) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield batch.filter(pa.array(~hit(batch)))

            return docs.mapInArrow(keep, docs.schema)

        def drop(batches: Iterator[pa.RecordBatch], hit=hit) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(rid).filter(pa.array(hit(batch)))], ["__gone"])

        if stored is None:
            stored = written(docs.withColumn(rid, F.monotonically_increasing_id()), "leak-docs")
        part = written(stored.select(rid, text_col).mapInArrow(drop, "__gone long"), "leaking")
        held.unpersist()
        gone = part if gone is None else gone.unionByName(part)
    gone = written(gone.distinct(), "leaking-rows")
    return stored.join(small(gone), F.col(rid) == F.col("__gone"), "left_anti").select(*docs.columns)


def with_last(parts: Iterator) -> Iterator[tuple]:
    """Each part, and whether it is the last."""
    parts = iter(parts)
    here = next(parts)
    for after in parts:
        yield here, False
        here = after
    yield here, True


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                      table(spark, sf_dir, "benchmark").select("item_id", "text"))
