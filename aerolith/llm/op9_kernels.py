"""NumPy kernels of the near-duplicate operator: occurrence-labelled shingles, ordered minima, banded alignment."""

from __future__ import annotations

import numpy as np

from aerolith.llm.textvec import U, mix

WORDS_IN_SHINGLE = 5
SKETCHES = 24
MINIMA = 3
SIMILARITY = 0.8
#: Up to so many pairs of equal shingles for each shingle of two texts, an alignment goes through the pairs one by one.
PAIRS_PER_SHINGLE = 4


def shingles(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of five tokens (uint16) in each text, and where each text's begin; a text of one to
    four words is one shingle."""
    t = tokens.astype(np.uint64)
    counts = np.diff(first)
    n = np.where(counts >= WORDS_IN_SHINGLE, counts - WORDS_IN_SHINGLE + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(n)])
    t = np.concatenate([t, np.zeros(WORDS_IN_SHINGLE, np.uint64)])
    m = len(tokens)
    whole = mix(t[:m] | t[1: m + 1] << U(16) | t[2: m + 2] << U(32) | t[3: m + 3] << U(48)) + t[4: m + 4] * U(0x9E3779B97F4A7C55)
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], n) + np.repeat(first[:-1], n)
    out = whole[at]
    for i in np.flatnonzero((counts > 0) & (counts < WORDS_IN_SHINGLE)):
        short = t[first[i]: first[i + 1]]
        out[begin[i]] = mix(np.array([sum(int(x) << 16 * k for k, x in enumerate(short)) % 2**64], np.uint64), len(short))[0]
    return out, begin


def labelled(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each shingle's hash joined with the number of times it occurred before in its text."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((keys, text)) if len(begin) > 2 else np.argsort(keys, kind="stable")
    k, d = keys[order], text[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    if new.all():
        return mix(keys)
    start = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    before = np.empty(len(k), np.uint64)
    before[order] = (np.arange(len(k)) - start).astype(np.uint64)
    return mix(keys + before * U(0xBF58476D1CE4E5B9))


def sketches(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """texts x SKETCHES: under each hash function the MINIMA least labelled shingles, in text order, as one hash.

    Texts without shingles get zeros."""
    n = np.diff(begin)
    out = np.zeros((len(n), SKETCHES), np.uint64)
    has = np.flatnonzero(n > 0)
    if not len(has):
        return out
    starts, sizes = begin[has], n[has]
    for i in range(SKETCHES):
        x = mix(keys, i + 1)
        chosen = np.full((len(has), MINIMA), len(keys), np.int64)  # places; beyond the last: none left
        for j in range(MINIMA):
            least = np.minimum.reduceat(x, starts)
            hit = np.flatnonzero(x == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hit, "right") - 1
            real = least[owner] != U(2**64 - 1)
            hit, owner = hit[real], owner[real]
            chosen[owner[::-1], j] = hit[::-1]  # the first one, should two be equal
            x[chosen[chosen[:, j] < len(keys), j]] = U(2**64 - 1)
        chosen.sort(axis=1)
        entry = np.full(len(has), i + 1, np.uint64)
        padded = np.concatenate([keys, np.zeros(1, np.uint64)])
        for j in range(MINIMA):
            entry = mix(entry * U(0xD6E8FEB86659FD93) + padded[chosen[:, j]])
        out[has, i] = entry
    return out


def increasing(values: np.ndarray) -> int:
    """Length of the longest increasing run of picks from ``values`` (patience sorting)."""
    if np.all(values[1:] > values[:-1]):
        return len(values)
    import bisect

    tails: list[int] = []
    for v in values.tolist():
        at = bisect.bisect_left(tails, v)
        tails[at: at + 1] = [v]
    return len(tails)


def in_order(a: np.ndarray, b: np.ndarray, ahead: int, behind: int) -> int:
    """Length of the longest common subsequence of two lists, either of which may repeat itself, by the pairs i, j with
    j - i <= ahead and i - j <= behind; where equal pairs are many, of all pairs, by bit operations on whole rows."""
    _, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a):]
    n_codes = int(code.max()) + 1
    in_a, in_b = np.bincount(x, minlength=n_codes), np.bincount(y, minlength=n_codes)
    order = np.argsort(y, kind="stable")
    start = np.cumsum(in_b) - in_b
    if int((in_a * in_b).sum()) <= PAIRS_PER_SHINGLE * (len(a) + len(b)):
        n = in_b[x]
        i = np.repeat(np.arange(len(a)), n)
        nth = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        j = order[np.repeat(start[x] + n - 1, n) - nth]  # for each i from the last to the first, so that one is picked at most
        return increasing(j[(j - i <= ahead) & (i - j <= behind)])
    often = max(64, len(b) // 1024)
    full = row = (1 << len(b)) - 1  # zeros: where the length grows by one along b
    held: dict[int, int] = {}
    for c in x[in_b[x] > 0].tolist():
        places = held.get(c)
        if places is None:
            if in_b[c] > often:
                places = held[c] = int.from_bytes(np.packbits(y == c, bitorder="little").tobytes(), "little")
            else:
                places = 0
                for p in order[start[c]: start[c] + in_b[c]].tolist():
                    places |= 1 << p
        met = row & places
        row = ((row + met) | (row - met)) & full
    return len(b) - row.bit_count()


def alignment_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """matches / (len a + len b - matches) of the best alignment of two lists of shingles, not labelled.

    Only pairs inside the band count: with a similarity of ``least`` or more, at most the shingles that may go
    unmatched on either side can shift a pair off the diagonal.  Below ``least`` the value is a lower bound.
    """
    if not len(a) or not len(b):
        return 0.0
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    if need > min(len(a), len(b)):
        return 0.0
    matches = in_order(a, b, len(b) - need, len(a) - need)
    return matches / (len(a) + len(b) - matches)


def links(tokens: list[np.ndarray], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of texts that are similar, as a spanning forest of the similarity graph of the texts given.

    The number of shingles that two texts share, repeated ones as often as both have them, bounds their similarity; it is counted for a text against all
    others by bit operations, and only pairs that it allows and that are not connected yet are aligned.
    """
    first = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    plain, begin = shingles(np.concatenate(tokens), first)
    keys = labelled(plain, begin)
    sizes, n = np.diff(begin), len(tokens)
    _, column, count = np.unique(keys, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1  # columns of shingles that two texts have
    width = int((int((count > 1).sum()) + 63) // 64)
    bits = np.zeros((n, width), np.uint64)
    at = np.flatnonzero(count[column] > 1)
    text = np.searchsorted(begin, at, "right") - 1
    place = shared[column[at]]
    np.bitwise_or.at(bits.reshape(-1), text * width + place // 64, U(1) << (place % 64).astype(np.uint64))
    root = np.arange(n)
    need = lambda i, j: np.ceil(least * (sizes[i] + sizes[j]) / (1 + least) - 1e-9)
    found = []
    for i in range(n - 1):
        other = i + 1 + np.flatnonzero(root[i + 1:] != root[i])
        other = other[need(i, other) <= np.minimum(sizes[i], sizes[other])]
        for part in np.array_split(other, max(1, len(other) * width // (1 << 22))):
            common = np.bitwise_count(bits[part] & bits[i]).sum(axis=1)
            for j in part[common >= need(i, part)]:
                if root[j] != root[i] and alignment_similarity(plain[begin[i]: begin[i + 1]], plain[begin[j]: begin[j + 1]], least) >= least:
                    found.append((i, int(j)))
                    root[root == root[j]] = root[i]
    return found
