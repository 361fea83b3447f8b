"""Words of many texts as NumPy arrays of 64-bit hashes, without a Python object for each word.

The texts of an Arrow batch are laid end to end as UTF-8 bytes; word starts, ends and a
polynomial hash of every word come from a handful of vector operations.  All arithmetic is
modulo 2**64.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 2**64)
U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(1)
def _bytes_table() -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64), 7)


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1); n is rounded up by the caller, to one size for all pieces but those of one longer text."""
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        step = out[: min(k, n - k)] * U(pow(base, k, 2**64))
        out[k : k + len(step)] = step
        k += len(step)
    return out


@lru_cache(2)
def _is_word(kind: str) -> np.ndarray:
    b = np.zeros(256, bool)
    if kind == "space":  # anything but ASCII white space
        b[:] = True
        b[[0x20, *range(0x09, 0x0E)]] = False
    else:  # ASCII letters, digits, underscore and all that is not ASCII
        b[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
    return b


class Words:
    """hash: of each word; start, end: its bytes; doc: the number of its text; first: where each text's words begin."""

    def __init__(self, texts, kind: str = "alnum", lower: bool = True):
        """``texts``: a list or an Arrow array of strings."""
        texts = texts if isinstance(texts, list) else texts.to_pylist()
        raw = [b"" if t is None else (t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
        inside = _is_word(kind)[data].view(np.int8)
        edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        n = 1 << max(20, int(len(data)).bit_length())
        self._prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_bytes_table()[data] * _powers(_INV, n)[: len(data)], out=self._prefix[1:])
        self._scale = _powers(_BASE, n)
        self.data = data
        self.hash = self._between(self.start, self.end)
        self.doc = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(raw) + 1))

    def _between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._prefix[end] - self._prefix[start]) * self._scale[start])

    def prefixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the first ``length`` bytes of each word longer than that, and the words' numbers."""
        at = np.flatnonzero(self.end - self.start > length)
        return self._between(self.start[at], self.start[at] + length), at


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` hashes, by doubling; len(h) - size + 1 of them (none if negative)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, out, done, level, span = 0xD6E8FEB86659FD93, np.zeros(n, np.uint64), 0, h, 1
    while True:
        if size & span:
            out = out * U(pow(base, span, 2**64)) + level[done : done + n]
            done += span
        if span * 2 > size:
            break
        level = level[: len(level) - span] * U(pow(base, span, 2**64)) + level[span:]
        span *= 2
    return mix(out)


def sliding(h: np.ndarray, size: int, op=np.minimum) -> np.ndarray:
    """The least (or, with np.maximum, largest) of each run of ``size`` values."""
    span, level = 1, h
    while span * 2 <= size:
        level = op(level[: len(level) - span], level[span:])
        span *= 2
    n = len(h) - size + 1
    return op(level[:n], level[size - span : size - span + n])


#: Bytes of text whose words are hashed at a time.
PIECE_BYTES = 1 << 19


def pieces(texts, limit: int = PIECE_BYTES):
    """(start, end) of runs of texts (a list or an Arrow array of strings) with at most about ``limit`` bytes together,
    one text at least, so that the arrays of ``Words`` stay small whatever the batch holds."""
    if isinstance(texts, list):
        sizes = [len(t) if t else 0 for t in texts]
    else:
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if size + n > limit and i > start:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def hashed(texts, kind: str = "alnum", lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts, and where each text's words begin (and the last one's end)."""
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for start, end in pieces(texts):
        words = Words(texts[start:end], kind, lower)
        parts.append(words.hash)
        counts.append(np.diff(words.first))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def member(values: np.ndarray, keys: np.ndarray, bits: int = 20) -> np.ndarray:
    """Which of ``values`` are in the sorted ``keys``: a bit table first, then a search for those that pass."""
    out = np.zeros(len(values), bool)
    if len(keys) and len(values):
        passes = np.zeros(1 << bits, bool)
        passes[keys >> U(64 - bits)] = True
        at = np.flatnonzero(passes[values >> U(64 - bits)])
        found = np.searchsorted(keys, values[at])
        out[at] = keys[np.minimum(found, len(keys) - 1)] == values[at]
    return out
