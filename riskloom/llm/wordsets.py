"""Word shingles as sorted 64-bit hashes, their MinHash signatures, and exact
similarities within a block of sets (numpy helpers that run inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5   # words
HASHES = 64   # MinHash functions
_rng = np.random.default_rng(20240229)
_ODD = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash a word; words are set apart by ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One hash for each run of ``size`` (64 at most) words; fewer words are one run."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i:len(words) - size + 1 + i] * _PLACE[i]
    return mix(total + np.uint64(size))


_BASES = [int(x) for x in _rng.integers(1, 2**62, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def rolling(words: np.ndarray, size: int, base: int = 0) -> np.ndarray:
    """One hash for each run of exactly ``size`` words, whatever the size, from
    prefix sums (arithmetic modulo 2**64, the base has an inverse)."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _powers.get(base, (np.empty(0, np.uint64),) * 2)
    if len(up) < n + 1:
        many = max(4096, 2 * n)
        step = [np.full(many, b % 2**64, np.uint64) for b in (_BASES[base], pow(_BASES[base], -1, 2**64))]
        for x in step:
            x[0] = 1
        up, down = _powers[base] = tuple(np.multiply.accumulate(x) for x in step)
    total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(words * down[:n])])
    return mix((total[size:] - total[:-size]) * up[:n - size + 1])


def window_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive numbers."""
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (size - width)], x[size - width:]) if size > width else x


def shingles(text: str | None) -> np.ndarray:
    """The set of word shingles, sorted."""
    return np.unique(window_hashes(word_hashes(text)))


def signature(items: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """32-bit MinHash signature of a non-empty set."""
    least = np.full(hashes, np.uint64(2**64 - 1))
    for at in range(0, len(items), 4096):
        part = items[at:at + 4096, None] * _ODD[None, :hashes]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def signatures(items: np.ndarray, starts: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values of consecutive sets that begin at ``starts``, one row a set."""
    out = np.full((len(starts), hashes), np.uint64(2**64 - 1))
    for k in range(hashes):
        out[:, k] = np.minimum.reduceat(items * _ODD[k], starts)
    return out >> np.uint64(32)


def similar_pairs(sets: list[np.ndarray], threshold: float, split: int | None = None) -> np.ndarray:
    """Boolean matrix: which sets have an exact Jaccard similarity of ``threshold``
    or more. With ``split``, only pairs of one of the first ``split`` sets and one of
    the others. Empty sets are similar to each other alone."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    owner = np.repeat(np.arange(n), sizes.astype(int))
    values, token = np.unique(np.concatenate(sets) if n else np.empty(0, np.uint64), return_inverse=True)
    often = np.bincount(token, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    keep = often[token]
    owner, token = owner[keep], column[token[keep]]
    shared = np.zeros((n, n), np.float64)
    width = 4096
    if len(token):
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        for low in range(0, int(token[-1]) + 1, width):
            a, b = np.searchsorted(token, [low, low + width])
            present = np.zeros((n, width), np.float32)
            present[owner[a:b], token[a:b] - low] = 1.0
            shared += present @ present.T
    union = sizes[:, None] + sizes - shared
    near = shared >= threshold * union - 1e-9
    np.fill_diagonal(near, False)
    if split is not None:
        near[:split, :split] = near[split:, split:] = False
    return near


def forest(near: np.ndarray) -> list[int]:
    """For each node the least node of its component."""
    label = np.arange(len(near))
    while True:
        best = np.where(near, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label.tolist()
        label = new
