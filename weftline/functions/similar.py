"""LCS ratios and Jaro-Winkler similarities of many pairs of strings at once: bits of a machine word
stand for the places of a string, and each step works on all pairs. The results are those of
``text.ratio`` and ``text.jaro_winkler_of``, which do the pairs with strings of more places."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Places of a string in a word, one bit left for the carry.
PLACES = 63
#: Entries of the tables of places, at most (8 bytes each), and pairs that go through them together.
MOST_ENTRIES, MOST_PAIRS = 1 << 21, 1 << 14
ONE = np.uint64(1)


class Strings:
    """Distinct strings as columns of letter numbers; ``letters`` beyond a string's end."""

    def __init__(self, words: list[str], alphabet: np.ndarray):
        self.lengths = np.array([len(w) for w in words], np.int64)
        codes = np.full((len(words), max(1, self.lengths.max(initial=0))), len(alphabet), np.int64)
        codes[np.arange(codes.shape[1]) < self.lengths[:, None]] = np.searchsorted(alphabet, points(words))
        self.codes = np.ascontiguousarray(codes.T)
        self.letters = len(alphabet)

    def places(self) -> np.ndarray:
        """For each string and letter the bits of its places; no bits for what lies beyond ends."""
        out = np.zeros((len(self.lengths), self.letters + 1), np.uint64)
        rows = np.arange(len(self.lengths))
        for i, column in enumerate(self.codes):
            out[rows, column] |= ONE << np.uint64(i)
        out[:, self.letters] = 0
        return out


def points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)


def below(n: np.ndarray) -> np.ndarray:
    """The lowest n bits."""
    return (ONE << n.astype(np.uint64)) - ONE


def lcs_lengths(a: Strings, b: Strings, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of longest common subsequences of a[i] and b[j], as ``text.lcs_length``."""
    place, width = a.places().ravel(), a.letters + 1
    full = below(a.lengths[i])
    state, row = full.copy(), i * width
    for at in range(int(b.lengths[j].max(initial=0))):
        hit = state & place.take(row + b.codes[at].take(j))
        state = (state + hit) | (state - hit)
    return np.bitwise_count(~state & full).astype(np.int64)


def ratios(a: Strings, b: Strings, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    total = a.lengths[i] + b.lengths[j]
    return np.where(total > 0, np.rint(200 * lcs_lengths(a, b, i, j) / np.maximum(total, 1)), 100).astype(np.int32)


def jaro_winklers(a: Strings, b: Strings, i: np.ndarray, j: np.ndarray, weight: float = 0.1) -> np.ndarray:
    la, lb = a.lengths[i], b.lengths[j]
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    place, width = b.places().ravel(), b.letters + 1
    used, matched, row = np.zeros(len(i), np.uint64), np.zeros(len(i), np.uint64), j * width
    for at in range(int(la.max(initial=0))):
        near = below(np.minimum(lb, at + window + 1)) & ~below(np.minimum(np.maximum(at - window, 0), PLACES))
        free = place.take(row + a.codes[at].take(i)) & near & ~used
        hit = free & (~free + ONE)
        used |= hit
        matched |= (hit != 0).astype(np.uint64) << np.uint64(at)
    m = np.bitwise_count(used).astype(np.int64)
    moved, x, y = np.zeros(len(i), np.int64), matched.copy(), used.copy()
    for at in range(int(m.max(initial=0))):
        low_x, low_y = x & (~x + ONE), y & (~y + ONE)
        on = at < m
        at_x, at_y = np.bitwise_count(low_x - ONE) * on, np.bitwise_count(low_y - ONE) * on
        moved += on & (a.codes[at_x, i] != b.codes[at_y, j])
        x, y = x ^ low_x, y ^ low_y
    some = np.maximum(m, 1)
    jaro = (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - moved // 2) / some) / 3
    prefix, alike = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for at in range(min(4, len(a.codes), len(b.codes))):
        alike &= (at < la) & (at < lb) & (a.codes[at].take(i) == b.codes[at].take(j))
        prefix += alike
    return np.where(m == 0, ((la == 0) & (lb == 0)).astype(float), np.where(jaro <= 0.7, jaro, jaro + prefix * weight * (1 - jaro)))


def by_pairs(many: Callable, one: Callable[[str, str], float], kind: str) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """A function of two arrays of strings: each distinct pair of a batch is done once, those of
    strings of up to PLACES together by ``many``, others by ``one``; null if either side is."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        known = left.is_valid().to_numpy(zero_copy_only=False) & right.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(known), kind)
        if known.any():
            some = pa.array(known)
            x, y = left.filter(some).dictionary_encode(), right.filter(some).dictionary_encode()
            a, b = x.dictionary.to_pylist(), y.dictionary.to_pylist()
            key = x.indices.to_numpy().astype(np.int64) * len(b) + y.indices.to_numpy()
            distinct, back = np.unique(key, return_inverse=True)
            out[known] = _of_distinct(many, one, kind, a, b, distinct // len(b), distinct % len(b))[back]
        return pa.array(out, mask=~known)

    return run


def _of_distinct(many: Callable, one: Callable, kind: str, a: list[str], b: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), kind)
    long_a, long_b = np.array([len(w) > PLACES for w in a]), np.array([len(w) > PLACES for w in b])
    single = long_a[i] | long_b[j]
    for n in np.flatnonzero(single):
        out[n] = one(a[i[n]], b[j[n]])
    rest = np.flatnonzero(~single)
    for start in range(0, len(rest), MOST_PAIRS):
        _together(many, a, b, i, j, rest[start : start + MOST_PAIRS], out)
    return out


def _together(many: Callable, a: list[str], b: list[str], i: np.ndarray, j: np.ndarray, part: np.ndarray, out: np.ndarray) -> None:
    rows_a, at_a = np.unique(i[part], return_inverse=True)
    rows_b, at_b = np.unique(j[part], return_inverse=True)
    words_a, words_b = [a[n] for n in rows_a], [b[n] for n in rows_b]
    alphabet = np.unique(np.concatenate([points(words_a), points(words_b)]))
    if len(part) > 1 and (len(alphabet) + 1) * max(len(words_a), len(words_b)) > MOST_ENTRIES:
        half = len(part) // 2
        _together(many, a, b, i, j, part[:half], out)
        _together(many, a, b, i, j, part[half:], out)
        return
    out[part] = many(Strings(words_a, alphabet), Strings(words_b, alphabet), at_a, at_b)
