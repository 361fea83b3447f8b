"""Best-fit packing of tokenized documents into sequences, after Martello and Toth's dominance reduction.

A document is its token ids and one end id; only a document above ``LIMIT`` tokens is cut, into pieces of ``LIMIT``.  What packing
needs to know of the pieces is how many there are of each length: a histogram of at most ``LIMIT`` numbers, whatever the
size of the corpus.  It is counted by Spark and planned by ``plan``:

1. Reduction.  For a piece of length j, a set of pieces that fits with it dominates all others if any set that fits with j can be
   exchanged for it without need of another sequence.  Such sets of at most three pieces are fixed for good, as often as
   the counts allow (every rule stays valid while its lengths last, so copies are fixed at once), and the histogram shrinks.
2. Best fit of the rest, longest first, on groups of equally filled sequences: pieces of one length go to the fullest
   sequences that take them.

The plan is a list of runs: the pieces of one length with numbers from lo on go into consecutive sequences, ``per`` into each, at an
offset.  Spark numbers the pieces of each length (a task numbers its own; the counts of the tasks before it are
added) and looks each number up in the plan, which is broadcast: at most a few runs for each length.  No piece is shuffled by
its length, so a length that a third of all pieces share does not land in one task.

Texts are tokenized a few megabytes at a time: words are encoded once for a worker and put together
again by vector operations.  Words end at ASCII white space and where ASCII letters, digits and punctuation meet (but for apostrophes), in lower case.
That gives the ids of the whole text, since this tokenizer's pre-tokenizer drops white space and cuts there, and no token or normalization
reaches across (``tests/llm`` compares both); texts of a tokenizer with other rules are encoded whole.

Defined results: a null or empty text is the end id alone; equal rows are separate documents; a text that names a special token gets its
id, as the library does by default; an empty table gives no rows.  Other columns are not read.  Numbers depend on how the rows
are dealt to tasks, so reruns may swap pieces of equal length; counts of sequences do not change.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.llm.common import small, table, written
from aerolith.llm.textvec import pieces as text_pieces

LIMIT = 2048
END_ID = 0
#: Words kept encoded in a worker; beyond it they are forgotten and encoded again.
CACHE_WORDS = 1 << 19
#: Bytes of text that are tokenized together (one text at least).
PIECE_BYTES = 1 << 22
#: New words that are encoded as one text.
TOGETHER = 200


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- tokens


#: The pre-tokenizer whose words can be encoded apart: contractions, runs of letters, single digits, runs of anything else; no white space.
_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(1)
def _ascii() -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte (letter, digit, punctuation; 0: others and the apostrophe, of which contractions are made) and its lower case."""
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[48:58] = 2
    kind[[c for c in range(33, 127) if not kind[c] and c != 39]] = 3
    lower[65:91] += 32
    return kind, lower


class WordEncoder:
    """Token ids of whole texts from the ids of their words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        split = ((rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = (split.get("pattern") == {"Regex": _APART} and split.get("invert") is True and split.get("behavior") == "Removed"
                      and {"type": "Lowercase"} in rules["normalizer"]["normalizers"] and bool(self.special))
        if self.apart:
            self.mark, self.mark_id = self.special[0], self.tokenizer.token_to_id(self.special[0])
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.ids, self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Encode new words, many as one text with a special token between them (none of them holds one)."""
        found, counts = [], []
        mark = f" {self.mark} ".encode()
        for ids in self.whole([mark.join(words[i : i + TOGETHER]).decode("utf-8") for i in range(0, len(words), TOGETHER)]):
            edges = np.concatenate([[-1], np.flatnonzero(ids == self.mark_id), [len(ids)]])
            found.append(ids[ids != self.mark_id])
            counts.append(np.diff(edges) - 1)
        counts = np.concatenate(counts).astype(np.int64)
        base = len(self.at)
        self.at.update(zip(words, range(base, base + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.ids = np.concatenate([self.ids, *found])

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with END_ID behind it, and where each text's ids end."""
        texts = [t or "" for t in texts]
        if not self.apart or any(x in t for t in texts if "<|" in t for x in self.special):
            found = [np.append(ids, np.uint32(END_ID)) for ids in self.whole(texts)]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.cumsum([len(f) for f in found], dtype=np.int64)
        raw = [t.encode("utf-8") for t in texts]
        kind, lower = _ascii()
        data = lower[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
        what = kind[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | ((what[1:] != what[:-1]) & (what[1:] > 0) & (what[:-1] > 0))
        start = np.flatnonzero(begins)
        letters = data[inside]
        offsets = np.append((np.cumsum(inside) - 1)[start], len(letters)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        unique = coded.dictionary.to_pylist()
        if len(self.at) + len(unique) > CACHE_WORDS:
            self.forget()
        new = [w for w in unique if w not in self.at]
        if new:
            self.learn(new)
        at = np.array([self.at[w] for w in unique], np.int64)[coded.indices.to_numpy()] if unique else np.zeros(0, np.int64)
        # One slot for each word, and one for each text's end id after its words.
        doc = np.searchsorted(ends, start, "right")
        slot = np.arange(len(start)) + doc
        last = np.searchsorted(doc, np.arange(len(raw)), "right") + np.arange(len(raw))
        count, where = np.ones(len(start) + len(raw), np.int64), np.zeros(len(start) + len(raw), np.int64)
        count[slot], where[slot] = self.count[at], self.start[at]
        where[last] = len(self.ids)
        bank = np.append(self.ids, np.uint32(END_ID))
        stop = np.cumsum(count)
        ids = bank[np.repeat(where - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, stop[last]


@lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    """One for a worker, so that its tasks share the words."""
    return WordEncoder(path)


def tokenized(docs: DataFrame, limit: int = LIMIT, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part and own (the piece's number among those of its length in its task), one row per piece."""
    path = path or tokenizer_path()
    id_type = docs.schema[id_col].dataType.simpleString()
    numbers = ["piece", "start", "length", "ids_crc32", "part", "own"]

    def encode(batches):
        encoder = _encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            for a, b in text_pieces(batch.column(1), PIECE_BYTES):
                ids, ends = encoder(batch.column(1).slice(a, b - a).to_pylist())
                begins = np.concatenate([[0], ends[:-1]])
                n = -(-(ends - begins) // limit)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * limit
                low = begins[doc] + start
                high = np.minimum(low + limit, ends[doc])
                length = high - low
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = np.array([crc32(raw[4 * x : 4 * y]) for x, y in zip(low.tolist(), high.tolist(), strict=True)], np.int64)
                order = np.argsort(length, kind="stable")  # number the pieces of each length
                ranked = length[order]
                first = np.searchsorted(ranked, ranked)
                own = np.empty(len(order), np.int64)
                own[order] = np.arange(len(order)) - first + seen[ranked]
                seen += np.bincount(length, minlength=limit + 1)
                cols = [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc)),
                        pa.array(np.full(len(doc), part, np.int64)), pa.array(own)]
                names = [id_col, *numbers]
                if with_ids:
                    flat = pa.array(ids.astype(np.int32))
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(low, len(ids)).astype(np.int32)), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long, part long, own long" + (", ids array<int>" if with_ids else "")
    return docs.select(id_col, text_col).mapInArrow(encode, schema)


# ---------------------------------------------------------------- the plan


class Run(NamedTuple):
    """Pieces of ``length`` numbered lo, lo + 1, ...: ``per`` to a sequence, from sequence ``base`` on, the first of a sequence at ``offset``."""

    length: int
    lo: int
    base: int
    per: int
    offset: int


class Bag:
    """A multiset of lengths."""

    def __init__(self, counts: dict[int, int]):
        self.n = {w: c for w, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, w: int, k: int = 1) -> None:
        self.n[w] -= k
        if self.n[w] == 0:
            del self.n[w]
            self.order.remove(w)

    def give(self, w: int, k: int = 1) -> None:
        if w not in self.n:
            insort(self.order, w)
        self.n[w] = self.n.get(w, 0) + k

    def smallest(self, k: int, above: int = 0) -> list[int]:
        """The ``k`` smallest lengths beyond ``above``, with repeats; fewer if there are not so many."""
        out: list[int] = []
        for i in range(bisect_right(self.order, above), len(self.order)):
            out += [self.order[i]] * min(self.n[self.order[i]], k - len(out))
            if len(out) == k:
                break
        return out

    def largest_within(self, room: int) -> int:
        i = bisect_right(self.order, room)
        return self.order[i - 1] if i else 0

    def best_pair(self, room: int) -> tuple[int, int]:
        """Two lengths with the largest sum up to ``room``, of the pairs with one sum that with the largest first; (0, 0) if none fits."""
        best, i, j = (0, 0), 0, len(self.order) - 1
        while i <= j:
            a, b = self.order[j], self.order[i]
            if a + b > room or (i == j and self.n[a] < 2):
                j -= 1
                continue
            best = max(best, (a, b), key=lambda p: (p[0] + p[1], p[0]))
            i += 1
        return best


def dominating(bag: Bag, j: int, limit: int) -> tuple[int, ...] | None:
    """The lengths that go with a piece of length ``j`` (already out of the bag) in a set that dominates all others; None if none is known."""
    room = limit - j
    least = bag.smallest(3)
    if not least or least[0] > room:
        return ()
    one = bag.largest_within(room)
    if one == room or len(least) < 2 or sum(least[:2]) > room:
        return (one,)
    if len(least) > 2 and sum(least) <= room:
        return None  # sets of four pieces are possible
    a, b = bag.best_pair(room)
    if one >= a + b:
        return (one,)
    if one == a:
        bag.take(a)
        two = bag.smallest(2, above=b)
        bag.give(a)
        if len(two) < 2 or sum(two) > room:  # in any other pair the shorter piece is no longer than b
            return (a, b)
    return None


def reduce_(counts: dict[int, int], limit: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """The sets fixed by dominance (lengths of a sequence, how many such sequences) and the counts that are left."""
    bag, fixed = Bag(counts), []
    changed = True
    while changed:
        changed = False
        for j in sorted(bag.n, reverse=True):
            while j in bag.n:
                bag.take(j)
                mates = dominating(bag, j, limit)
                bag.give(j)
                if mates is None:
                    break
                each: dict[int, int] = defaultdict(int)
                for w in (j, *mates):
                    each[w] += 1
                times = min(bag.n[w] // k for w, k in each.items())
                for w, k in each.items():
                    bag.take(w, k * times)
                fixed.append(((j, *mates), times))
                changed = True
    return fixed, dict(bag.n)


def best_fit(counts: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: a piece goes to the fullest sequence with room for it.  Equally filled sequences are one group."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # room -> (lengths, sequences)
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], k: int) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((lengths, k))

    for w in sorted(counts, reverse=True):
        left = counts[w]
        while left:
            i = bisect_left(rooms, w)
            if i == len(rooms):
                room, lengths, k = limit, (), -(-left // (limit // w))
            else:
                room = rooms[i]
                lengths, k = groups[room].pop()
                if not groups[room]:
                    rooms.pop(i)
            # A sequence that took a piece is the fullest one with room for the next, so it is filled up first.
            per = room // w
            full = min(k, left // per)
            if full:
                put(room - per * w, lengths + (w,) * per, full)
            left -= full * per
            k -= full
            if k and left:
                put(room - left * w, lengths + (w,) * left, 1)
                left, k = 0, k - 1
            if k and room < limit:
                put(room, lengths, k)
    return [g for room in rooms for g in groups[room]]


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for all pieces of the histogram."""
    fixed, rest = reduce_(counts, limit)
    return fixed + best_fit(rest, limit)


def runs(sequences: list[tuple[tuple[int, ...], int]]) -> list[Run]:
    """The plan by length: which numbers of a length go to which sequences."""
    out, used, base = [], defaultdict(int), 0
    for lengths, k in sequences:
        offset, i = 0, 0
        while i < len(lengths):
            w, per = lengths[i], 1
            while i + per < len(lengths) and lengths[i + per] == w:
                per += 1
            out.append(Run(w, used[w], base, per, offset))
            used[w] += per * k
            offset += per * w
            i += per
        base += k
    return out


def lower_bound(counts: dict[int, int], limit: int = LIMIT) -> int:
    """Martello and Toth's bound L2 on the number of sequences: no packing needs fewer."""
    w = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(x)] for x in w], np.int64)
    best = 0
    for k in [0, *w[w <= limit // 2].tolist()]:
        big, mid, low = w > limit - k, (w <= limit - k) & (w > limit / 2), (w <= limit / 2) & (w >= k)
        room = int((n[mid] * (limit - w[mid])).sum())
        best = max(best, int(n[big].sum() + n[mid].sum()) + max(0, -(-(int((n[low] * w[low]).sum()) - room) // limit)))
    return best


# ---------------------------------------------------------------- the job


def placed(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` (a written table with length, part and own) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``limit`` rows
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select(F.col("part").alias("__part"), F.col("length").alias("__length"), F.coalesce(before, F.lit(0)).alias("__before")), "packing-starts")
    numbered = pieces.join(small(starts), (F.col("part") == F.col("__part")) & (F.col("length") == F.col("__length")))
    numbered = numbered.withColumn("number", F.col("own") + F.col("__before")).drop("part", "own", "__part", "__length", "__before")

    table_ = sorted(runs(plan(histogram, limit)))
    big = 1 << 46
    keys = np.array([r.length * big + r.lo for r in table_], np.int64)
    known = spark.sparkContext.broadcast((keys, *[np.array([r[i] for r in table_], np.int64) for i in (1, 2, 3, 4)]))
    kept = [c for c in numbered.columns if c != "number"]

    def look_up(batches):
        keys, lo, base, per, offset = known.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(keys, length * big + number, "right") - 1
            inside = number - lo[at]
            sequence, place = base[at] + inside // per[at], offset[at] + inside % per[at] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(place)], names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields if f.name in kept)
    return numbered.mapInArrow(look_up, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, limit: int = LIMIT, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, [ids,] sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    return placed(written(tokenized(docs, limit, path, with_ids=with_ids), "packing-pieces"), limit)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every packed sequence (``packed`` with its ids): at most ``limit`` numbers in a group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
