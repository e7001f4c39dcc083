"""Removal of repeated passages by difference-cover anchors (operator 13).

Positions modulo a period v that lie in a difference cover D (every residue is a difference of two members) are
cover positions. For any two positions there is a shift below v that moves both to cover positions. So
two equal windows of W words share an *anchor*, the W - v + 1 words from a cover position inside them,
and only anchors at cover positions are hashed.

1. Anchors that occur twice or more are found by their hash (a chance collision costs work only).
2. They are extended: every window around a repeated anchor is a candidate, and of equal candidates (128-bit
   keyed hashes, of which 96 bits travel beside the bucket) all but the first by (document, start) are marked.
3. A word is removed when a marked window covers it.

Both exchanges work alike. A *chunk* of documents settles its own repeats first and sends one entry for
each hash, so a passage in a third of all rows sends one entry per chunk. Entries travel packed by bucket of the hash,
and marked places travel back packed by the *home* of the document, a hash of its row address; buckets and homes
grow in number with the text, not in size, and no more rows travel than entries. The texts are shuffled once, by home, and
the second and third step read that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import row_address

#: Period of the cover.
PERIOD = 7
#: Bytes of text worked on at once and words of a chunk, about (a document is never divided); words for each bucket and code
#: points for each home.
SLICE_BYTES, CHUNK_WORDS, BUCKET_WORDS, HOME_CHARS = 4 << 20, 1 << 20, 2 << 20, 4 << 20
#: Keys of the two word hashes (SipHash).
KEYS = ("repeated passage", "difference cover")
#: A null document id in the order of documents.
NULL_ID = -(2**63)
PACKED = "bucket long, docs binary, counts binary, places binary, hashes binary, known binary"
MARKED = "home long, docs binary, counts binary, places binary"


def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest set of residues (the first in order) whose differences are all residues."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("the period must be at least 1")


# -- words and windows -------------------------------------------------------------------------

def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    there = np.asarray(pc.binary_length(words)) > 0
    ends = np.cumsum(np.asarray(pc.list_value_length(lists)))
    counts = np.diff(np.concatenate([[0], np.cumsum(there)])[np.concatenate([[0], ends])])
    return words.filter(pa.array(there)), counts


def word_hashes(words: pa.Array, lanes: int) -> list[np.ndarray]:
    """Keyed 64-bit hashes of every word, ``lanes`` (1 or 2) of them."""
    coded = words.dictionary_encode()
    known, at = np.asarray(coded.dictionary.to_pylist(), object), coded.indices.to_numpy()
    return [pd.util.hash_array(known, hash_key=key, categorize=False)[at] if len(known) else np.empty(0, np.uint64) for key in KEYS[:lanes]]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position, by doubling; shorter by ``length`` - 1."""
    if len(h) < length:
        return np.empty(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    while True:
        if length & size:
            n = len(h) - done - size + 1
            out = power[:n] if out is None else _joined(out[:n], power[done : done + n])
            done += size
        if done == length:
            return out
        power = _joined(power[: len(power) - size], power[size:])
        size *= 2


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    begin = 0
    while begin < len(texts):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + size, "right")))
        yield begin, end
        begin = end


# -- packing -----------------------------------------------------------------------------------

def _planes(a: np.ndarray) -> bytes:
    """The numbers byte by byte, all lowest bytes first: small numbers compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _from_planes(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _runs(sorted_numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal numbers (0 or more) begins and ends."""
    edges = [*np.flatnonzero(np.diff(sorted_numbers, prepend=-1)), len(sorted_numbers)]
    return zip(edges, edges[1:], strict=False)


def _doc_rows(part: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Key, address and home of every document."""
    return np.stack([np.asarray(pc.fill_null(part.column("doc_id"), NULL_ID)), *(np.asarray(part.column(c)) for c in ("file", "row", "home"))])


class _Chunk:
    """Entries (document, place, hash lanes) of a chunk of documents."""

    def __init__(self) -> None:
        self.docs: list[np.ndarray] = []
        self.entries: list[tuple[np.ndarray, ...]] = []
        self.n_docs = self.n_words = 0

    def add(self, docs: np.ndarray, words: int, doc: np.ndarray, place: np.ndarray, *lanes: np.ndarray) -> None:
        self.docs.append(docs)
        self.entries.append((doc + self.n_docs, place.astype(np.uint32), *lanes))
        self.n_docs += docs.shape[1]
        self.n_words += words

    def packed(self, n_buckets: int, settle: Callable) -> list[dict]:
        """One row for each bucket, and one (with a bucket below 0) of what the chunk itself marks."""
        if not self.n_docs:
            return []
        docs = np.concatenate(self.docs, axis=1)
        doc, place, *lanes = (np.concatenate(x) for x in zip(*self.entries, strict=True))
        # documents in their order, so that entries are in the order of (document, place)
        order = np.lexsort(docs[:3][::-1])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        docs, doc = docs[:, order], rank[doc]
        entry = np.lexsort((place, doc))
        doc, place, lanes = doc[entry], place[entry], [x[entry] for x in lanes]
        sent, known, marked = settle(lanes)
        none = {"hashes": b"", "known": b""}
        own = -1 - int(docs[1, 0] ^ docs[2, 0]) % n_buckets
        rows = [_packed_row({"bucket": own}, docs, doc[marked], place[marked]) | none] if len(marked) else []
        bucket = (lanes[0][sent] % np.uint64(n_buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        for begin, end in _runs(bucket[by]):
            part = sent[by[begin:end]]
            hashes = b"".join(_planes(x[part]) if i == 0 else x[part].astype(np.uint32).tobytes() for i, x in enumerate(lanes))
            rows.append(_packed_row({"bucket": int(bucket[by[begin]])}, docs, doc[part], place[part]) | {"hashes": hashes, "known": np.packbits(known[part]).tobytes()})
        return rows


PACKED_SCHEMA = pa.schema([("bucket", pa.int64()), *((c, pa.binary()) for c in ("docs", "counts", "places", "hashes", "known"))])
MARKED_SCHEMA = pa.schema([("home", pa.int64()), *((c, pa.binary()) for c in ("docs", "counts", "places"))])


def _settle_anchors(lanes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries that are sent (one of each hash), which entries are known to be repeated, and
    the entries that the chunk marks: all with a hash that it has twice."""
    _, first, group, counts = np.unique(lanes[0], return_index=True, return_inverse=True, return_counts=True)
    known = counts[group] > 1
    return np.sort(first), known, np.flatnonzero(known)


def _settle_windows(lanes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first entry of each hash is sent; the chunk marks the others."""
    later = _later(lanes, np.arange(len(lanes[0])))
    return np.flatnonzero(~later), np.zeros(len(later), bool), np.flatnonzero(later)


def _later(lanes: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Which entries aren't the first, by ``order``, of those with equal hashes."""
    by = np.lexsort((order, *lanes[::-1]))
    same = np.ones(max(len(by) - 1, 0), bool)
    for x in lanes:
        same &= x[by[1:]] == x[by[:-1]]
    out = np.zeros(len(by), bool)
    out[by[1:]] = same
    return out


def _unpacked_docs(column: pa.ChunkedArray, parts: int) -> np.ndarray:
    """The numbers of the documents of all rows, a column per document."""
    docs = [np.stack([_from_planes(b[i * len(b) // parts : (i + 1) * len(b) // parts], np.int64) for i in range(parts)]) for b in column.to_pylist()]
    return np.concatenate(docs, axis=1) if docs else np.empty((parts, 0), np.int64)


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint32), *(_from_planes(b, np.uint32) for b in column.to_pylist())]).astype(np.int64)


def _marked(packed: DataFrame, lanes: int) -> DataFrame:
    """Marked places by home of their documents: of each bucket, entries with a repeated hash (one lane: anchors), or those
    that aren't the first of theirs (two: windows); and what the chunks have marked."""

    def run(group: pa.Table) -> pa.Table:
        docs, counts, place = _unpacked_docs(group["docs"], 4), _unpacked(group["counts"]), _unpacked(group["places"])
        doc = np.repeat(np.arange(len(counts)), counts)
        if group["bucket"][0].as_py() >= 0:
            hashes, ends = group["hashes"].to_pylist(), [len(b) // 4 for b in group["places"].to_pylist()]
            hs = [np.concatenate([_from_planes(b[: 8 * n], np.uint64) for b, n in zip(hashes, ends, strict=True)])]
            if lanes == 2:
                hs.append(np.concatenate([np.frombuffer(b, np.uint32, n, 8 * n) for b, n in zip(hashes, ends, strict=True)]))
                rank = np.empty(docs.shape[1], np.int64)
                rank[np.lexsort(docs[:3][::-1])] = np.arange(docs.shape[1])
                keep = _later(hs, rank[doc] << 32 | place)
            else:
                known = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(group["known"].to_pylist(), ends, strict=True)]).astype(bool)
                _, at, n = np.unique(hs[0], return_inverse=True, return_counts=True)
                anywhere = n > 1
                anywhere[at[known]] = True
                keep = anywhere[at] & ~known
            place, doc = place[keep], doc[keep]
        own, doc = np.unique(doc, return_inverse=True)
        docs = docs[:, own]
        home = docs[3][doc]
        by = np.lexsort((place, doc, home))
        rows = [_packed_row({"home": int(home[by[i]])}, docs[1:3], doc[by[i:j]], place[by[i:j]]) for i, j in _runs(home[by])]
        return pa.Table.from_pylist(rows, MARKED_SCHEMA)

    return packed.groupBy("bucket").applyInArrow(run, MARKED)


def _packed_row(key: dict, docs: np.ndarray, doc: np.ndarray, place: np.ndarray) -> dict:
    """Places of documents (in the order of documents) as one row."""
    own, counts = np.unique(doc, return_counts=True)
    return key | {"docs": b"".join(_planes(np.ascontiguousarray(x)) for x in docs[:, own]), "counts": _planes(counts.astype(np.uint32)), "places": _planes(place.astype(np.uint32))}


def _placed(marked: pa.Table, texts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each marked place, the number of its document among the texts, and the place."""
    files, counts = _unpacked_docs(marked["docs"], 2), _unpacked(marked["counts"])
    at = {key: i for i, key in enumerate(zip(texts["file"].to_pylist(), texts["row"].to_pylist(), strict=True))}
    doc = np.fromiter((at[key] for key in zip(*files.tolist(), strict=True)), np.int64, files.shape[1])
    return np.repeat(doc, counts), _unpacked(marked["places"])


def _covered(doc: np.ndarray, place: np.ndarray, begins: np.ndarray, total: int, before: int, after: int) -> np.ndarray:
    """Which of all positions lie from ``before`` in front of a place to ``after`` behind it (excluded), cut at the
    document's begin only."""
    starts, ends = begins[doc] + np.maximum(place - before, 0), begins[doc] + place + after
    edges = np.bincount(starts, minlength=total + 1)[: total + 1] - np.bincount(ends, minlength=total + 1)[: total + 1]
    return np.cumsum(edges)[:total] > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, period: int = PERIOD) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key as ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``
    (the words that stay, joined by one blank).

    Words are divided by ASCII white space and compared unchanged. A word goes when a window of ``window`` words covers it whose
    words also stand earlier: in a document with a smaller key (null first), or earlier in the same one. Of rows with equal keys one,
    by its place in the files, counts as earlier. Windows are judged on the input, so a chain of copies keeps its first. A null,
    empty or shorter text has no window and keeps its words. A very long text is worked on whole, by one task. ``period`` must
    lie below ``window``. Only the two columns are read, so other columns of any name don't matter.
    """
    cover, length = np.array(difference_cover(period)), window - period + 1
    placed = row_address(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    n_buckets, n_homes = 1 + chars // 5 // BUCKET_WORDS, 1 + chars // HOME_CHARS
    rows = placed.select("doc_id", F.xxhash64("__file").alias("file"), F.col("__row").alias("row"), "text")
    rows = rows.withColumn("home", F.pmod(F.xxhash64("file", "row"), F.lit(n_homes)))

    def words_of(texts: pa.Table | pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words, how many each text has and where its first one is; for each word its text and place."""
        words, counts = split_words(texts.column("text").combine_chunks() if isinstance(texts, pa.Table) else texts.column("text"))
        begins = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        return words, counts, begins, doc, np.arange(len(words)) - begins[doc]

    def anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            for begin, end in _slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(begin, end - begin)
                words, counts, _, doc, place = words_of(part)
                at = np.flatnonzero((counts[doc] - place >= length) & np.isin(place % period, cover))
                chunk.add(_doc_rows(part), len(words), doc[at], place[at], window_hashes(*word_hashes(words, 1), length)[at])
                if chunk.n_words >= CHUNK_WORDS:
                    yield pa.RecordBatch.from_pylist(chunk.packed(n_buckets, _settle_anchors), PACKED_SCHEMA)
                    chunk = _Chunk()
        yield pa.RecordBatch.from_pylist(chunk.packed(n_buckets, _settle_anchors), PACKED_SCHEMA)

    def windows(texts: pa.Table, marked: pa.Table) -> pa.Table:
        doc, place = _placed(marked, texts)
        known, to = np.unique(doc, return_inverse=True)  # other documents have no candidates
        texts = texts.take(pa.array(known))
        words, counts, begins, word_doc, word_place = words_of(texts)
        near = _covered(to, place, begins, len(words), period - 1, 1)
        at = np.flatnonzero(near & (counts[word_doc] - word_place >= window))
        chunk = _Chunk()
        if len(at):
            chunk.add(_doc_rows(texts), len(words), word_doc[at], word_place[at], *(window_hashes(h, window)[at] for h in word_hashes(words, 2)))
        return pa.Table.from_pylist(chunk.packed(n_buckets, _settle_windows), PACKED_SCHEMA)

    def kept(texts: pa.Table, marked: pa.Table) -> pa.Table:
        words, counts, begins, _, _ = words_of(texts)
        gone = _covered(*_placed(marked, texts), begins, len(words), 0, window)
        ends = np.cumsum(counts)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[ends], prepend=0)
        offsets = np.concatenate([[0], np.cumsum(counts - removed)]).astype(np.int32)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.filter(pa.array(~gone))), " ")
        return pa.table([texts["doc_id"], pa.array(counts.astype(np.int64)), pa.array(removed.astype(np.int64)), text], names=["doc_id", "n_words", "n_removed", "kept_text"])

    def at_home(marked: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        return rows.groupBy("home").cogroup(marked.groupBy("home")).applyInArrow(f, schema)

    anchored = _marked(rows.mapInArrow(anchors, PACKED), 1)
    repeated = _marked(at_home(anchored, windows, PACKED), 2)
    return at_home(repeated, kept, "doc_id long, n_words long, n_removed long, kept_text string")
