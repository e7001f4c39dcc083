"""Byte-level BPE encoding and decoding (operator 1).

A text is cut by the tokenizer's pattern and every match (a *piece*) is merged on its own.
The merge order of a piece comes from a segment tree over its byte positions: leaf ``p``
holds the rank of the pair that starts at byte ``p``, an inner node the smaller rank of its
children, so a descent that prefers the left child finds the leftmost minimum. One merge
changes three leaves (the merged pair, its live left neighbour and the swallowed right part),
which is three point updates of logarithmic cost. `merge_pieces` runs one such merge per step
for every piece of a batch at once, with numpy; pieces are batched by tree width.

Words repeat, so a task remembers the ids of the segments it has seen, up to a bound
(`CACHE_SEGMENTS`); the bound changes speed only, never a result. At its end it keeps those it met
most, so that an idle worker leaves its memory to the stages after it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Segments a worker remembers before it forgets the half it met least (about 150 bytes each).
CACHE_SEGMENTS = 400_000
#: Of these, the part that a worker keeps from one task to the next: workers stay while other stages run beside them.
REST = 8
#: Bytes of text, and code points of it, that a task of `encode_texts` has in work at once.
PART_BYTES, PART_CHARS = 4 << 20, 500_000
#: Code points encoded at once; longer texts are cut at safe places.
CHUNK_CHARS = 2_000_000
#: Rank of "no such pair".
NONE = np.int32(2**31 - 1)
#: Bytes from which a piece is merged alone.
LONG_PIECE = 256
#: Cells (pieces x tree width) merged at once.
MERGE_CELLS = 1 << 19

# White space other than blank and newline, as any of the regular-expression libraries sees it.
_ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x00"
_WIDE_SPACE = "\x85\xa0     　᠎" + "".join(map(chr, range(0x2000, 0x200C)))
_LONE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _marked(text: str) -> str | None:
    """The text with a null character between its `segments`; None if it holds one itself."""
    lone = not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1:].isspace())
    if lone and not any(c in text for c in _ASCII_SPACE) and (text.isascii() or not any(c in text for c in _WIDE_SPACE)):
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ")
    return None if "\0" in text else _LONE.sub("\0", text)


def segments(text: str) -> list[str]:
    """Parts of a text that the pattern's matches never cross.

    A blank or newline that stands alone between other characters always starts a match, so
    the text may be cut before it. Where all white space is of that kind (the usual text) two
    replaces and one split do it; other texts are cut at the lone ones by an expression.
    """
    marked = _marked(text)
    return _LONE.split(text) if marked is None else marked.split("\0")


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """A long text in parts of about ``size`` code points, cut only where `segments` may cut."""
    begin = 0
    while len(text) - begin > size:
        cut = _LONE.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


class Ranks:
    """A tiktoken rank file: id of every byte string, and the pairs of ids that merge."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        pairs = {}
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        # one key beyond all others, so that a search never runs past the end
        self.keys = np.append(keys[order], np.int64(2**62))
        self.merged = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], NONE)
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank (= id) of the merged pair, or NONE."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def merge_pieces(ranks: Ranks, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, end to end, and how many each has.

    A piece that is itself a token gets that id without merging, as the library does.
    """
    get = ranks.ids.get
    whole = np.array([get(p, -1) for p in pieces], np.int64)
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    counts = np.where(whole >= 0, 1, 0)
    rest = np.flatnonzero((whole < 0) & (length > 0))
    width = np.where(length > LONG_PIECE, 0, 1 << np.ceil(np.log2(np.maximum(length, 2))).astype(np.int64))
    found = []
    for w in np.unique(width[rest]).tolist():
        rows = rest[width[rest] == w]
        step = max(1, MERGE_CELLS // w) if w else 1
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            batch = [pieces[i] for i in some.tolist()]
            flat, counts[some] = _merge_width(ranks, batch, w) if w else _merge_long(ranks, batch[0])
            found.append((some, flat))
    begin = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint32)
    out[begin[whole >= 0]] = whole[whole >= 0]
    for some, flat in found:
        n = counts[some]
        out[np.repeat(begin[some] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
    return out, counts


def _merge_long(ranks: Ranks, piece: bytes) -> tuple[np.ndarray, int]:
    """The same tree and merges for one long piece, where a step for many pieces doesn't pay."""
    n = len(piece)
    width, none = 1 << (n - 1).bit_length(), int(NONE)
    ids = [int(ranks.byte[b]) for b in piece]
    get = ranks.pairs.get
    tree = [none] * (2 * width)
    tree[width : width + n - 1] = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(node: int, value: int) -> None:
        tree[node] = value
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    while (new := tree[1]) < none:
        node = 1
        while node < width:
            node *= 2
            if tree[node] != new:
                node += 1
        here = node - width
        swallowed = after[here]
        follows, precedes = after[swallowed], before[here]
        ids[here], after[here] = new, follows
        put(width + swallowed, none)
        if follows < n:
            before[follows] = here
        put(node, get(new << 32 | ids[follows], none) if follows < n else none)
        if precedes >= 0:
            put(width + precedes, get(ids[precedes] << 32 | new, none))
    out, at = [], 0
    while at < n:
        out.append(ids[at])
        at = after[at]
    return np.array(out, np.uint32), len(out)


def _merge_width(ranks: Ranks, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The merges of pieces of at most ``width`` bytes (a power of two), one per piece and step."""
    n = len(pieces)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    length = np.fromiter(map(len, pieces), np.int32, n)
    column = np.arange(width, dtype=np.int32)
    live = column < length[:, None]
    ids = ranks.byte[raw]
    tree = np.full((n, 2 * width), NONE, np.int32)
    pair = column[None, : width - 1] < length[:, None] - 1
    leaf = np.full((n, width - 1), NONE, np.int32)
    leaf[pair] = ranks.rank(ids[:, :-1][pair], ids[:, 1:][pair])
    tree[:, width : 2 * width - 1] = leaf
    level = width
    while level > 1:
        half = level // 2
        np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, half:level])
        level = half
    after = np.minimum(column + 1, length[:, None]).astype(np.int32)  # length: no live part follows
    before = np.tile(column - 1, (n, 1)).astype(np.int32)  # -1: none precedes

    tree, ids, after, before, alive = tree.ravel(), ids.ravel(), after.ravel(), before.ravel(), live.ravel()
    row = np.arange(n)
    while True:
        root = tree[row * 2 * width + 1]
        row = row[root < NONE]
        if not len(row):
            break
        new = root[root < NONE]
        trunk, base, end = row * 2 * width, row * width, length[row]
        node = np.ones(len(row), np.int64)
        for _ in range(width.bit_length() - 1):
            node *= 2
            node += tree[trunk + node] != new
        here = node - width
        swallowed = after[base + here].astype(np.int64)
        follows = after[base + swallowed].astype(np.int64)
        precedes = before[base + here].astype(np.int64)
        ids[base + here] = new
        after[base + here] = follows
        alive[base + swallowed] = False
        right, left = follows < end, precedes >= 0
        before[(base + follows)[right]] = here[right]
        value = np.full(len(row), NONE, np.int32)
        value[right] = ranks.rank(new[right], ids[(base + follows)[right]])
        tree[trunk + node] = value
        tree[trunk + width + swallowed] = NONE
        tree[(trunk + width + precedes)[left]] = ranks.rank(ids[(base + precedes)[left]], new[left])
        touched = [(trunk, node), (trunk, width + swallowed), (trunk[left], (width + precedes)[left])]
        trunks, nodes = (np.concatenate(x) for x in zip(*touched, strict=True))
        for _ in range(width.bit_length() - 1):
            nodes = nodes >> 1
            low = trunks + 2 * nodes
            tree[trunks + nodes] = np.minimum(tree[low], tree[low + 1])
    alive = alive.reshape(n, width)
    return ids.reshape(n, width)[alive], alive.sum(1)


class _Index(dict):
    """Number of a segment; a new one gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at


class SegmentCoder:
    """Texts to ids through remembered segments.

    ``encode`` gets new segments and returns their ids end to end and the count of each.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bound: int = CACHE_SEGMENTS):
        self.encode, self.bound = encode, bound
        self.index = _Index()
        self.flat, self.start, self.count, self.met = np.empty(1 << 16, np.uint32), *(np.empty(1 << 14, np.int64) for _ in range(3))
        self.used = 0

    def rest(self) -> None:
        """At the end of a task: keep the `REST`-th part of the bound, and give unused memory back."""
        if len(self.index) > self.bound // REST:
            self._forget(self.bound // REST)
        pa.default_memory_pool().release_unused()

    def _forget(self, keep: int) -> None:
        """Keep the segments that were met most; older meetings count half."""
        size = len(self.index)
        stay = np.sort(np.argsort(-self.met[:size], kind="stable")[:keep])
        segments, self.index = list(self.index), _Index()
        self.index.update(zip((segments[i] for i in stay.tolist()), range(len(stay)), strict=True))
        count, start = self.count[stay], self.start[stay]
        done = np.cumsum(count)
        self.used = int(done[-1]) if len(done) else 0
        self.flat = self.flat[np.repeat(start - (done - count), count) + np.arange(self.used)]
        self.start, self.count, self.met = done - count, count, self.met[stay] // 2

    def _learn(self) -> None:
        flat, count = self.encode(self.index.new)
        first, last = len(self.index) - len(self.index.new), len(self.index)
        self.flat = _room(self.flat, self.used + len(flat))
        self.start, self.count, self.met = _room(self.start, last), _room(self.count, last), _room(self.met, last)
        self.flat[self.used : self.used + len(flat)] = flat
        self.count[first:last] = count
        self.met[first:last] = 0
        self.start[first:last] = self.used + np.cumsum(count) - count
        self.used += len(flat)
        self.index.new = []

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, by chunks."""
        for part in chunks(text):
            yield from self.batch([part])

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the texts together should be about a chunk."""
        if len(self.index) > self.bound:
            self._forget(self.bound // 2)
        # only the distinct segments of a batch are looked up
        marked = [_marked(text) for text in texts]
        if None in marked:
            parts = [segments(text) for text in texts]
            found, sizes = pa.array([s for part in parts for s in part], pa.large_string()), [len(part) for part in parts]
        else:
            parts = pc.split_pattern(pa.array(marked, pa.large_string()), "\0")
            found, sizes = parts.flatten(), np.diff(parts.offsets)
        found, ends = found.dictionary_encode(), np.cumsum(sizes).tolist()
        number = np.array(list(map(self.index.__getitem__, found.dictionary.to_numpy(zero_copy_only=False))), np.int64)
        if self.index.new:
            self._learn()
        here = np.asarray(found.indices)
        self.met[number] += np.bincount(here, minlength=len(number))
        at = number[here]
        count = self.count[at]
        done = np.cumsum(count)
        total = int(done[-1]) if len(done) else 0
        out = self.flat[np.repeat(self.start[at] - (done - count), count) + np.arange(total)]
        return np.split(out, [int(done[e - 1]) if e else 0 for e in ends[:-1]])


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    return np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])


def bpe_coder(ranks: Ranks, pattern: str) -> SegmentCoder:
    find = regex.compile(pattern).findall

    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        numbers, at, per = _Index(), [], np.empty(len(new), np.int64)
        for i, segment in enumerate(new):
            pieces = find(segment)
            at.extend(map(numbers.__getitem__, pieces))
            per[i] = len(pieces)
        flat, count = merge_pieces(ranks, [p.encode() for p in numbers.new])
        start = np.cumsum(count) - count
        at = np.array(at, np.int64)
        n = count[at]
        done = np.cumsum(n)
        total = int(done[-1]) if len(done) else 0
        out = flat[np.repeat(start[at] - (done - n), n) + np.arange(total)] if total else np.empty(0, np.uint32)
        begin = np.concatenate([[0], done])
        stop = np.cumsum(per)
        return out, begin[stop] - begin[stop - per]

    return SegmentCoder(encode)


def grouped(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``size`` code points together."""
    begin = chars = 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > size:
            yield begin, i
            begin, chars = i, 0
        chars += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def text_ids(coder: SegmentCoder, texts: list[str], size: int | None = None) -> Iterator[list[np.ndarray]]:
    """For each text in order, its ids as a list of arrays (more than one for a very long text); texts of
    about ``size`` code points together (two chunks) are encoded at once."""
    for begin, end in grouped(texts, size or 2 * CHUNK_CHARS):
        if end - begin == 1 and len(texts[begin]) > CHUNK_CHARS:
            yield list(coder.ids(texts[begin]))
        else:
            for ids in coder.batch(texts[begin:end]):
                yield [ids]


_CODERS: dict[tuple[str, str], tuple[Ranks, SegmentCoder]] = {}


def worker_coder(path: str, pattern: str) -> tuple[Ranks, SegmentCoder]:
    """Rank file and coder of this Python worker; a worker is used for many tasks."""
    if (path, pattern) not in _CODERS:
        ranks = Ranks(path)
        _CODERS[path, pattern] = ranks, bpe_coder(ranks, pattern)
    return _CODERS[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, key: Column | str = "doc_id", text: Column | str = "text", ids: bool = True) -> DataFrame:
    """Encode a text column and decode the ids again, in one pass without a shuffle.

    Returns one row per input row, repeated rows too: the key under its own type as ``doc_id``,
    ``ids`` (array of int; left out with ``ids=False``), ``n_tokens``, ``ids_sha256`` (digest of
    the ids as little-endian unsigned 32-bit integers) and ``decoded_sha256`` (digest of the
    bytes that the ids decode to). A null or empty text has no ids and the digests of the empty
    string; a null key stays null. Only the two columns are read, so other columns of any name
    don't matter. An empty table gives an empty result. ``path`` must exist on every node.
    """
    key, text = (F.col(c) if isinstance(c, str) else c for c in (key, text))
    rows = docs.select(key.alias("doc_id"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}," + "ids array<int>," * ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    names = ["doc_id", *["ids"] * ids, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, coder = worker_coder(path, pattern)

        def encoded(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in part.column(1).to_pylist()]
            arrays, counts, digests, decoded = [], [], [], []
            for parts in text_ids(coder, texts, PART_CHARS):
                a, d = hashlib.sha256(), hashlib.sha256()
                for p in parts:
                    a.update(p.astype("<u4", copy=False).tobytes())
                    d.update(ranks.decode(p))
                counts.append(sum(map(len, parts)))
                digests.append(a.hexdigest())
                decoded.append(d.hexdigest())
                if ids:
                    arrays.append(np.concatenate(parts).astype(np.int32))
            columns = [part.column(0)]
            if ids:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays))))
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names)

        batch = None
        for batch in batches:
            for begin, end in _byte_ranges(batch.column(1), PART_BYTES):
                yield encoded(batch.slice(begin, end - begin))
                pa.default_memory_pool().release_unused()
        del batch
        coder.rest()

    return rows.mapInArrow(run, schema)


def _byte_ranges(texts: pa.Array, size: int = 16 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text, so that few texts are Python objects at once."""
    lengths = np.array(pc.fill_null(pc.binary_length(texts), 0))
    begin = 0
    while begin < len(lengths):
        end = begin + max(1, int(np.searchsorted(np.cumsum(lengths[begin:]), size)))
        yield begin, min(end, len(lengths))
        begin = end


def decode_ids(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids decodes to, as a binary column (null for null)."""
    names = frame.columns
    schema = frame.select("*", F.lit(b"").alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, _ = worker_coder(path, "")
        for batch in batches:
            found = [None if x is None else ranks.decode(np.array(x, np.int64)) for x in batch.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*names, out])

    return frame.mapInArrow(run, schema)
