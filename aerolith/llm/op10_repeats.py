"""Substring deduplication by window fingerprints in prefix groups, in place of prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of one document.  Every word covered by a window whose words
also start anywhere else goes.  The suffixes that can lie below a deep internal node are found first,
then they are split by variable-length prefixes into groups that fit a task, and each group's
suffixes are compared to a depth of ``WINDOW`` words; those with an equal one are the repeats, and the stretches
that their windows cover are the maximal repeats.

1. Homes.  Documents go to homes of at most ``HOME_BYTES`` of text, a bucketed table in the shared folder, so that
   no later step shuffles a text again.
2. Sampled suffixes.  Of any 24 consecutive 12-word prefixes the one with the least hash is an anchor; both places
   of a repeated window choose the same one.  Homes send their anchors' prefixes (each once, and whether it
   has two places there); prefixes with two places in all go back to the homes that sent them.  Only windows
   with such an anchor can repeat, and nothing that repeats is lost.
3. Groups.  Each home lists its remaining suffixes (each once).  They are grouped by the hash of their first 4
   words; groups above ``GROUP_SUFFIXES`` are split by their first 12 words, those still above it by all words.
4. Subtrees.  No tree is built: a group sorts its suffixes by their 35-word fingerprint; equal neighbours are what would be
   leaves of one internal node at that depth, which is all that the result needs.  A suffix that a third of all documents share is one entry for each home, not one for each document.
   The repeated fingerprints go back to their homes, which remove the words.

Fingerprints have 64 bits and are compared inside a prefix group only.  Defined results: null, empty and wordless texts
have no words and the digest of an empty text; documents under 35 words lose nothing; repeated rows are elsewhere
for each other, so all their windows go; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import scratch, table, width, written
from aerolith.llm.textvec import U, hashed, member, sliding, windows

WINDOW = 35
ANCHOR = 12  # words in a sampled suffix's prefix
PREFIXES = (4, 12)  # words that group the suffixes
HOME_BYTES = 8 << 20
GROUP_SUFFIXES = 1 << 21
PART_KEYS = 1 << 21

SENT = "part long, home long, keys binary, many binary"


def to_homes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, __text, home of every row as a table bucketed by home; a home is a run of rows of one scan partition."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    total = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    size = max(1 << 18, min(HOME_BYTES, total // (2 * width(spark))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            lengths = pa.compute.binary_length(batch.column("__text")).fill_null(0).to_numpy(zero_copy_only=False)
            homes = np.empty(len(lengths), np.int64)
            for i, n in enumerate(lengths):
                if held and held + n > size:
                    home, held = home + 1, 0
                held += int(n) + 8
                homes[i] = home
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes)], ["__id", "__text", "home"])

    id_type = rows.schema["__id"].dataType.simpleString()
    name = f"repeat_homes_{uuid.uuid4().hex[:12]}"
    buckets = min(50_000, max(1, total // size + 1))
    (rows.mapInArrow(deal, f"__id {id_type}, __text string, home long").write.format("parquet").option("compression", "zstd")
     .option("path", scratch(spark, "repeat-homes")).bucketBy(int(buckets), "home").saveAsTable(name))
    return spark.table(name)


def prepared(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, where each text begins, and the starts of all windows that lie in one text."""
    h, first = hashed(texts, "space", lower=False)
    ok = np.zeros(max(0, len(h) - WINDOW + 1), bool)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WINDOW:
            ok[a: b - WINDOW + 1] = True
    return h, first, ok


def anchors(h: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix hash at each place, and the least prefix hash in each window (0 for windows across texts)."""
    prefix = windows(h, ANCHOR)
    if not len(ok):
        return prefix[:0], np.zeros(0, np.uint64)
    reach = WINDOW - ANCHOR + 1
    least = np.where(ok, sliding(prefix, reach), U(0))
    pad = np.zeros(reach - 1, np.uint64)
    chosen = prefix == sliding(np.concatenate([pad, least, pad]), reach, np.maximum)
    return prefix[chosen], least


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where each occurs first, and whether it occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    return ordered[at], order[at], np.diff(np.append(at, len(keys))) > 1


def packed(part: np.ndarray, home: int, keys: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    """A row of SENT for each part, with the keys that go there."""
    order = np.argsort(part, kind="stable")
    part, keys, many = part[order], keys[order], many[order]
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(edges[1:], len(part))
    return pa.RecordBatch.from_arrays([
        pa.array(part[edges].astype(np.int64)), pa.array(np.full(len(edges), home, np.int64)),
        pa.array([keys[a:b].tobytes() for a, b in zip(edges, ends, strict=False)], pa.binary()),
        pa.array([many[a:b].tobytes() for a, b in zip(edges, ends, strict=False)], pa.binary())], ["part", "home", "keys", "many"])


def repeated(sent: DataFrame) -> DataFrame:
    """home, keys: of the keys that each home sent, those with two places in all.  A group is one part's keys."""

    def nodes(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        keys = np.concatenate(sets)
        many = np.frombuffer(b"".join(group.column("many").to_pylist()), bool)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        twice = np.empty(len(keys), bool)
        twice[order] = same[1:] | same[:-1]  # a leaf beside another one of its node
        twice |= many
        first = np.cumsum([0, *map(len, sets)])
        back = [s[twice[a: a + len(s)]].tobytes() for s, a in zip(sets, first[:-1], strict=True)]
        homes = group.column("home").to_pylist()
        kept = [i for i, b in enumerate(back) if b]
        return pa.table({"home": pa.array([homes[i] for i in kept], pa.int64()), "keys": pa.array([back[i] for i in kept], pa.binary())})

    return sent.groupBy("part").applyInArrow(nodes, "home long, keys binary")


def _keys(answer: pa.Table) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(answer.column("keys").to_pylist()), np.uint64))


def repeated_anchors(homes: DataFrame) -> DataFrame:
    n_words = homes.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    parts = max(width(homes.sparkSession), n_words // 60 // PART_KEYS + 1)  # about one anchor in 60 bytes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush(home: int) -> pa.RecordBatch:
            # a home may come in several batches: windows lie in one text, so anchors add up
            keys, _, many = counted(np.concatenate(held.pop(home)))
            return packed((keys % U(parts)).astype(np.int64), home, keys, many)

        for batch in batches:
            texts = batch.column("__text")
            home_of = batch.column("home").to_numpy()
            edges = np.flatnonzero(np.append(True, home_of[1:] != home_of[:-1])) if len(home_of) else []
            for a, b in zip(edges, np.append(edges[1:], len(home_of)), strict=False):
                home = int(home_of[a])
                for other in [x for x in held if x != home]:
                    yield flush(other)
                h, _, ok = prepared(texts.slice(a, b - a))
                held.setdefault(home, []).append(anchors(h, ok)[0])
        for home in list(held):
            yield flush(home)

    return repeated(homes.mapInArrow(send, SENT))


def suffixes(homes: DataFrame, known: DataFrame) -> DataFrame:
    """home, n, keys, many, g0, g1: each home's windows that can repeat, once each, with their prefixes' 16-bit hashes."""

    def own(texts: pa.Table, answer: pa.Table) -> pa.Table:
        schema = ["home", "n", "keys", "many", *(f"g{i}" for i in range(len(PREFIXES)))]
        types = [pa.int64(), pa.int64(), *[pa.binary()] * (2 + len(PREFIXES))]
        if not len(texts) or not len(answer):
            return pa.table({c: pa.array([], t) for c, t in zip(schema, types, strict=True)})
        h, _, ok = prepared(texts.column("__text"))
        _, least = anchors(h, ok)
        at = np.flatnonzero(ok)
        at = at[member(least[at], _keys(answer))]
        keys, place, many = counted(windows(h, WINDOW)[at])
        groups = [(windows(h, p)[at[place]] >> U(48)).astype(np.uint16).tobytes() for p in PREFIXES]
        row = [texts.column("home")[0].as_py(), len(keys), keys.tobytes(), many.tobytes(), *groups]
        return pa.table({c: pa.array([v], t) for c, v, t in zip(schema, row, types, strict=True)})

    columns = ", ".join(["home long, n long, keys binary, many binary", *(f"g{i} binary" for i in range(len(PREFIXES)))])
    return written(homes.groupBy("home").cogroup(known.groupBy("home")).applyInArrow(own, columns), "repeat-suffixes")


class Groups:
    """Numbers the group of each suffix: by its first prefix, or by longer ones where that group is too large."""

    def __init__(self, n: int):
        self.n = n  # groups at the first level, and parts of each group that is split
        self.split: list[np.ndarray] = []  # by level: the groups that are split, ascending

    def number(self, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group of each suffix, and whether it is a group of the last level so far."""
        group, last, base = levels[0].astype(np.int64) % self.n, np.ones(len(levels[0]), bool), self.n
        for split, deeper in zip(self.split, levels[1:], strict=False):
            at = np.minimum(np.searchsorted(split, group), len(split) - 1)
            last = last & (split[at] == group)
            group = np.where(last, base + at * self.n + deeper.astype(np.int64) % self.n, group)
            base += self.n * len(split)
        return group, last


def _levels(batch: pa.RecordBatch, row: int) -> list[np.ndarray]:
    short = [np.frombuffer(batch.column(f"g{i}")[row].as_py(), np.uint16) for i in range(len(PREFIXES))]
    return [*short, (np.frombuffer(batch.column("keys")[row].as_py(), np.uint64) >> U(24)) & U(0xFFFF)]


def grouping(listed: DataFrame) -> Groups:
    """Split groups until each is below GROUP_SUFFIXES or at the last level; a count over all suffixes for each level."""
    total = listed.agg(F.sum("n")).first()[0] or 0
    n = 1 << max(4, min(16, int(4 * total // GROUP_SUFFIXES).bit_length()))
    groups = Groups(max(n, 1 << (width(listed.sparkSession) - 1).bit_length()))
    for _ in range(len(PREFIXES)):

        def count(batches: Iterator[pa.RecordBatch], groups=groups) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    group, last = groups.number(_levels(batch, row))
                    g, c = np.unique(group[last], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], ["g", "c"])

        large = (listed.mapInArrow(count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
                 .where(F.col("c") > GROUP_SUFFIXES).select("g").collect())  # at most total / GROUP_SUFFIXES
        if not large:
            break
        groups.split.append(np.array(sorted(r.g for r in large), np.int64))
    return groups


def repeated_windows(listed: DataFrame) -> DataFrame:
    groups = grouping(listed)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[row].as_py(), np.uint64)
                many = np.frombuffer(batch.column("many")[row].as_py(), bool)
                yield packed(groups.number(_levels(batch, row))[0], batch.column("home")[row].as_py(), keys, many)

    return repeated(listed.mapInArrow(send, SENT))


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words a window that begins at one of ``starts`` covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (removed stretches as [first word, end)) and, if wanted, the text kept."""
    homes = to_homes(docs, id_col, text_col)
    listed = suffixes(homes, repeated_anchors(homes))
    twice = repeated_windows(listed)
    id_type = homes.schema["__id"].dataType.simpleString()

    def cut(texts: pa.Table, answer: pa.Table) -> pa.Table:
        raw = texts.column("__text").to_pylist()
        h, first, ok = prepared(raw)
        at = np.flatnonzero(ok)
        if len(answer) and len(at):
            at = at[member(windows(h, WINDOW)[at], _keys(answer))]
        else:
            at = at[:0]
        gone = covered(at, len(h))
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "spans": [], "text": []}
        for text, a, b in zip(raw, first[:-1], first[1:], strict=True):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
            kept = b" ".join(words if not len(edge) else [words[i] for i in np.flatnonzero(~own)])
            out["n_words"].append(len(words))
            out["n_removed"].append(int(own.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
            if with_text:
                out["text"].append(kept.decode("utf-8", "surrogatepass"))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = {"doc_id": texts.column("__id"), "n_words": pa.array(out["n_words"], pa.int64()),
                   "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                   "spans": pa.array(out["spans"], span)}
        return pa.table(columns | ({"text": pa.array(out["text"], pa.string())} if with_text else {}))

    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return homes.groupBy("home").cogroup(twice.groupBy("home")).applyInArrow(cut, schema + ", text string" * with_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")
