"""Shingle sets of texts, and the signature tree that links the sets of one block."""

from __future__ import annotations

import hashlib

import numpy as np

#: Words from this many bytes on are hashed by the library (BLAKE2), shorter ones with numpy.
LONG_WORD = 64
#: Words hashed at once.
CHUNK_WORDS = 1 << 17
FANOUT = 4


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LETTER[32] = 0  # the separator adds nothing to a word
# a multiplier of its own for each place: powers of one number have words that collide whatever the number
_POWER = _mix(np.arange(1, LONG_WORD + 2, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_PLACE = _mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    joined = b" ".join(words)
    raw = np.frombuffer(joined, np.uint8)
    begin = np.concatenate([[0], np.flatnonzero(raw == 32) + 1])
    length = np.diff(np.append(begin, len(raw) + 1)) - 1
    within = np.arange(len(raw)) - np.repeat(begin, length + 1)[: len(raw)]
    if long := np.flatnonzero(length >= LONG_WORD).tolist():
        within = np.minimum(within, LONG_WORD)
    out = _mix(np.add.reduceat(_LETTER[raw] * _POWER[within], begin) + length.astype(np.uint64))
    for i in long:
        out[i] = int.from_bytes(hashlib.blake2b(words[i], digest_size=8).digest(), "little")
    return out


def shingles(text: bytes | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a UTF-8 text: letters A-Z
    lowered, words divided by ASCII white space. A text of fewer words is one shingle as a whole;
    one without words (or null) has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.concatenate([_word_hashes(words[i : i + CHUNK_WORDS]) for i in range(0, len(words), CHUNK_WORDS)])
    k = min(width, len(w))
    n = len(w) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s += w[j : j + n] * _PLACE[j]
    return np.unique(_mix(s))


def bitmap(s: np.ndarray) -> bytes:
    """Bitmap of a set, with as many bits as the next power of two from its size (64 at least)."""
    bits = 1 << max(6, (len(s) - 1).bit_length()) if len(s) else 64
    row = np.zeros(bits, bool)
    row[s & np.uint64(bits - 1)] = True
    return np.packbits(row, bitorder="little").tobytes()


def bitmaps_allow(n: int, a: bytes, m: int, b: bytes, num: int, den: int) -> bool:
    """Whether sets of n and m elements with these bitmaps can reach similarity num/den: every bit
    that one has alone stands for an element that isn't shared. The larger map is folded."""
    if den * n < num * m or den * m < num * n:
        return False
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
    return (num + den) * most >= num * (n + m)


def prefix_size(n: int, num: int, den: int) -> int:
    """How many first tokens of a set of n, in any order common to all sets, must hold a token that
    it shares with each set of Jaccard similarity num/den or more."""
    return n - -(-n * num // den) + 1


class Groups:
    """Union-find over a block."""

    def __init__(self, labels: np.ndarray):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels.tolist())]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(j)] = self.root(i)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = overlap(a, b)
    return den * both >= num * (len(a) + len(b) - both)


def link(sets: list[np.ndarray], labels: np.ndarray, num: int = 3, den: int = 4) -> list[tuple[int, int]]:
    """Pairs of sets of similarity num/den or more that join all sets of ``labels`` classes that any such
    pair joins (a spanning forest: pairs already in one class are not compared again).

    The tree's leaves are the sets in order of their least hashes; each node holds the OR of its
    sets' bitmaps, the range of their sizes, the most tokens that a set has beyond its bits and
    its class if it has only one. Two nodes are traversed together only while a pair below them
    can reach the overlap that the similarity needs: sets x and y share at most as many tokens as
    the node bitmaps share bits, plus the smaller of the two surpluses.
    """
    n = len(sets)
    if n < 2:
        return []
    order = sorted(range(n), key=lambda i: (sets[i][:2].tolist(), len(sets[i])))
    groups, found = Groups(labels), []

    def test(i: int, j: int) -> None:
        if groups.root(i) != groups.root(j) and similar(sets[i], sets[j], num, den):
            groups.join(i, j)
            found.append((i, j))

    for i, j in zip(order, order[1:], strict=False):
        test(i, j)
    size = np.array([len(sets[i]) for i in order], np.int64)
    bits = 1 << int(min(19, max(10, 3 + int(size.max()).bit_length())))
    maps = np.zeros((n, bits // 64), np.uint64)
    for at, i in enumerate(order):
        row = np.zeros(bits, bool)
        row[(sets[i] >> np.uint64(13)) & np.uint64(bits - 1)] = True
        maps[at] = np.packbits(row).view(np.uint64)
    extra = size - np.bitwise_count(maps).sum(1).astype(np.int64)
    kind = np.array([groups.root(i) for i in order], np.int64)
    levels = [(maps, size, size, extra, kind)]
    while len(levels[-1][1]) > 1:
        maps, low, high, extra, kind = levels[-1]
        cut = np.arange(0, len(low), FANOUT)
        least, most = np.minimum.reduceat(kind, cut), np.maximum.reduceat(kind, cut)
        levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(extra, cut), np.where(least == most, least, -1)))
    a = b = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        a, b = _may_link(levels[depth], a, b, num, den)
        if depth:
            below = len(levels[depth - 1][1])
            a, b = _children(a, b, below)
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        test(order[x], order[y])
    return found


def _children(a: np.ndarray, b: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(FANOUT)
    x = (a[:, None, None] * FANOUT + step[:, None]) + 0 * step
    y = (b[:, None, None] * FANOUT + step) + 0 * step[:, None]
    x, y = x.ravel(), y.ravel()
    keep = (x <= y) & (y < below)
    return x[keep], y[keep]


def _may_link(level: tuple, a: np.ndarray, b: np.ndarray, num: int, den: int, chunk: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """The node pairs below which a pair of sets can still be similar and not yet joined."""
    maps, low, high, extra, kind = level
    # |x| >= num/den |y| for similar sets, whichever is larger
    keep = (den * high[a] >= num * low[b]) & (den * high[b] >= num * low[a]) & ~((kind[a] == kind[b]) & (kind[a] >= 0))
    a, b = a[keep], b[keep]
    step = max(1, chunk // maps.shape[1])
    good = np.ones(len(a), bool)
    for at in range(0, len(a), step):
        x, y = a[at : at + step], b[at : at + step]
        shared = np.bitwise_count(maps[x] & maps[y]).sum(1).astype(np.int64) + np.minimum(extra[x], extra[y])
        most = np.minimum(shared, np.minimum(high[x], high[y]))
        good[at : at + step] = (num + den) * most >= num * (low[x] + low[y])
    return a[good], b[good]
