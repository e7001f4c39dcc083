"""Token ids in binary files of patched frame-of-reference blocks (operator 6).

A file holds the ids of neighbouring documents, in ascending key order over all files:

- blocks of `BLOCK` ids (the last may be shorter): least id (u32), bit width (u8), count (u16), number of
  exceptions (u16), the low bits of id - least at that width, and for ids that need more bits
  their places (u16) and id - least (u32). The width is that of the `PERCENTILE` of id - least;
- an index: start of every block (u64) and of its end, key (i64, with a null flag u8) and first id (u64) of every
  document;
- a trailer: place of the index, number of blocks, documents and ids (u64 each), and the magic bytes.

Tasks write files under names of their own to the shared folder, and a manifest names the files of
the tasks that counted, so a task that is run again, or twice, leaves no wrong result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.bpe import SegmentCoder, _byte_ranges, text_ids
from tallyspark.llm.common import shared_path, stored

BLOCK, PERCENTILE = 1024, 90
#: Blocks that are packed or read at once.
BATCH = 256
#: New segments that one call of the library takes, and how many of them make one text.
CALL, JOINED = 8192, 256
#: Segments a worker remembers before it forgets the half it met least; this changes speed only.
SEGMENTS = 800_000
MAGIC = b"PFORIDS1"
_HEAD, _TAIL = struct.Struct("<IBHH"), struct.Struct("<QQQQ8s")


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of the blocks of some ids, and the length of each block."""
    out, lengths = [], []
    for at in range(0, len(ids), BLOCK * BATCH):
        some = ids[at : at + BLOCK * BATCH].astype(np.uint32)
        whole = len(some) // BLOCK * BLOCK
        for rows in (some[:whole].reshape(-1, BLOCK), some[whole:].reshape(1, -1)):
            if not rows.size:
                continue
            least = rows.min(1)
            off = rows - least[:, None]
            rank = min(rows.shape[1] - 1, rows.shape[1] * PERCENTILE // 100)
            width = np.frexp(np.partition(off, rank, 1)[:, rank].astype(float))[1].astype(np.int64)  # bits; 0 for 0
            packed: list[bytes] = [b""] * len(rows)
            for w in np.unique(width).tolist():
                i = np.flatnonzero(width == w)
                if w:
                    bits = np.unpackbits(off[i].astype("<u4").view(np.uint8).reshape(len(i), rows.shape[1], 4), axis=2, bitorder="little")[:, :, :w]
                    for k, b in zip(i.tolist(), np.packbits(bits.reshape(len(i), -1), axis=1, bitorder="little"), strict=True):
                        packed[k] = b.tobytes()
            over = off >> width[:, None].astype(np.uint32) > 0
            for k in range(len(rows)):
                place = np.flatnonzero(over[k])
                block = _HEAD.pack(int(least[k]), int(width[k]), rows.shape[1], len(place)) + packed[k] + place.astype("<u2").tobytes() + off[k][place].astype("<u4").tobytes()
                out.append(block)
                lengths.append(len(block))
    return b"".join(out), np.array(lengths, np.int64)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``."""
    heads = [_HEAD.unpack_from(data, s) for s in starts.tolist()]
    count = np.array([h[2] for h in heads], np.int64)
    begin = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint32)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k, (_, w, n, _) in enumerate(heads):
        kinds.setdefault((w, n), []).append(k)
    for (w, n), ks in kinds.items():
        if not w:
            continue
        size = -(-w * n // 8)
        raw = np.stack([np.frombuffer(data, np.uint8, size, int(starts[k]) + _HEAD.size) for k in ks])
        bits = np.unpackbits(raw, axis=1, count=w * n, bitorder="little").reshape(len(ks), n, w)
        wide = np.zeros((len(ks), n, 32), np.uint8)
        wide[:, :, :w] = bits
        values = np.packbits(wide.reshape(len(ks), -1), axis=1, bitorder="little").view("<u4")
        for k, v in zip(ks, values, strict=True):
            out[begin[k] : begin[k] + n] = v
    for k, (least, w, n, e) in enumerate(heads):
        part = out[begin[k] : begin[k] + n]
        if e:
            at = int(starts[k]) + _HEAD.size + -(-w * n // 8)
            part[np.frombuffer(data, "<u2", e, at)] = np.frombuffer(data, "<u4", e, at + 2 * e)
        part += np.uint32(least)
    return out


def open_fs(path: str):
    """File system and path that a path of the shared folder names (file:, hdfs:, s3: and so on)."""
    import pyarrow.fs as pfs

    if path.startswith("file:"):
        return pfs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pfs.FileSystem.from_uri(path) if "://" in path else (pfs.LocalFileSystem(), path)


class Writer:
    """One file of ids, written as they come."""

    def __init__(self, path: str):
        fs, path = open_fs(path)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.file = fs.open_output_stream(path)
        self.at = self.ids = 0
        self.wait: list[np.ndarray] = []
        self.waiting = 0
        self.starts: list[np.ndarray] = []
        self.keys: list = []
        self.firsts: list[int] = []

    def document(self, key: int | None) -> None:
        self.keys.append(key)
        self.firsts.append(self.ids)

    def add(self, ids: np.ndarray) -> None:
        self.wait.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= 4 * BATCH * BLOCK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.wait) if self.wait else np.empty(0, np.uint32)
        data, lengths = pack(ids[:n])
        self.file.write(data)
        self.starts.append(self.at + np.cumsum(lengths) - lengths)
        self.at += len(data)
        self.wait, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.waiting)
        starts = np.append(np.concatenate(self.starts), self.at).astype("<u8")
        null = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        for part in (starts, keys, null, np.array(self.firsts, "<u8")):
            self.file.write(part.tobytes())
        self.file.write(_TAIL.pack(self.at, len(starts) - 1, len(keys), self.ids, MAGIC))
        self.file.close()


class Reader:
    """A file of ids: its index, and ids by block."""

    def __init__(self, path: str):
        fs, path = open_fs(path)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        at, blocks, docs, self.n_ids, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of ids")
        index = self.file.read_at(size - _TAIL.size - at, at)
        self.starts = np.frombuffer(index, "<u8", blocks + 1).astype(np.int64)
        place = 8 * (blocks + 1)
        keys, null = np.frombuffer(index, "<i8", docs, place), np.frombuffer(index, np.uint8, docs, place + 8 * docs)
        self.keys = [None if x else int(k) for k, x in zip(keys, null, strict=True)]
        self.firsts = np.append(np.frombuffer(index, "<u8", docs, place + 9 * docs), self.n_ids).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks from ``first`` to before ``last``."""
        begin, end = int(self.starts[first]), int(self.starts[last])
        return unpack(self.file.read_at(end - begin, begin), self.starts[first:last] - begin)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by the index."""
        begin, end = int(self.firsts[i]), int(self.firsts[i + 1])
        if begin == end:
            return np.empty(0, np.uint32)
        first = begin // BLOCK
        ids = self.blocks(first, -(-end // BLOCK))
        return ids[begin - first * BLOCK : end - first * BLOCK]


class LibraryCoder:
    """Ids of texts as the tokenizers library gives them in a plain call without special tokens added.

    Segments (`bpe.segments`) are remembered, and the library encodes every new one. Most begin with a lone blank,
    where a match always starts, so some of them end to end make a text that it cuts at their begins; a token's bytes tell which
    segment it is of. A text that holds an added token's own string goes to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # a byte-level token has a character for each byte
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.bytes = np.array([len(self.whole.id_to_token(i) or "") for i in range(size)], np.int64)
        self.coder = SegmentCoder(self._new, SEGMENTS)

    def _new(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.array([len(s) > 1 and s[0] == " " and not s[1].isspace() and not s[-1].isspace() for s in new], bool)
        size, count = np.asarray(pc.binary_length(pa.array(new, pa.large_string()))), np.zeros(len(new), np.int64)
        order, flat = [], [np.empty(0, np.uint32)]
        for at, takes in ((np.flatnonzero(joined), True), (np.flatnonzero(~joined), False)):
            for begin in range(0, len(at), CALL):
                part = at[begin : begin + CALL]
                some = [new[i] for i in part.tolist()]
                if takes:
                    texts = ["".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
                    ids = np.concatenate([np.array(e.ids, np.int64) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)])
                    ends = np.cumsum(size[part])
                    count[part] = np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends, "right"), prepend=0)
                else:
                    found = self.whole.encode(some, is_pretokenized=True, add_special_tokens=False)
                    ids = np.array(found.ids, np.int64)
                    count[part] = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
                flat.append(ids.astype(np.uint32))
                order.append(part)
        # back into the order of the segments
        where = np.concatenate([*order, np.empty(0, np.int64)])
        flat, n = np.concatenate(flat), count[where]
        start = np.empty(len(new), np.int64)
        start[where] = np.cumsum(n) - n
        done = np.cumsum(count)
        return flat[np.repeat(start - (done - count), count) + np.arange(len(flat))], count

    def ids(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """For each text in order, its ids as a list of arrays (more than one for a very long text)."""
        special = [any(t in text for t in self.added) for text in texts]
        plain = text_ids(self.coder, ["" if x else text for text, x in zip(texts, special, strict=True)])
        for text, x, found in zip(texts, special, plain, strict=True):
            yield [np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)] if x else found


_CODERS: dict[str, LibraryCoder] = {}


def library_coder(path: str) -> LibraryCoder:
    """The coder of this Python worker; a worker is used for many tasks."""
    if path not in _CODERS:
        _CODERS[path] = LibraryCoder(path)
    return _CODERS[path]


def write_ids(docs: DataFrame, path: str, end_id: int | None = None, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all documents and write their ids to files in ``folder`` (a new one in the shared
    folder by default). Returns the manifest: ``shard``, ``file``, ``n_docs``, ``n_ids``, ``start`` (ids in the files before).

    Ids are those of the library's plain call (``add_special_tokens=False``): a special token's string within a text
    is that token. Files and documents in them are in ascending key order (null first; ties by text). A null or
    empty text has no ids but ``end_id``. Keys must be whole numbers or null. Only the two columns
    are read, so other columns of any name don't matter. An empty table writes no files.
    """
    folder = folder or shared_path(docs.sparkSession, "ids")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    last = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, out = library_coder(path), None
        shard = TaskContext.get().partitionId()
        name = f"{folder}/{shard:06}-{uuid.uuid4().hex}.pfor"
        for batch in batches:
            for begin, end in _byte_ranges(batch.column(1)):
                part = batch.slice(begin, end - begin)
                out = out or Writer(name)
                for k, ids in zip(part.column(0).to_pylist(), coder.ids([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    out.document(k)
                    for x in ids:
                        out.add(x)
                    out.add(last)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([name]), pa.array([len(out.keys)], pa.int64()), pa.array([out.ids], pa.int64())], ["shard", "file", "n_docs", "n_ids"])

    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = stored(dealt.mapInArrow(run, "shard long, file string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """From the files of a manifest: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), one row per document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = Reader(name)
                n_docs, n_blocks = len(file.keys), len(file.starts) - 1
                crc = np.zeros(n_docs, np.int64)
                doc = 0
                for first in range(0, n_blocks, BATCH):
                    raw = file.blocks(first, min(first + BATCH, n_blocks)).astype("<u4").tobytes()
                    low, high = first * BLOCK, first * BLOCK + len(raw) // 4
                    while doc < n_docs and file.firsts[doc] < high:
                        a, b = max(int(file.firsts[doc]), low), min(int(file.firsts[doc + 1]), high)
                        crc[doc] = zlib.crc32(raw[4 * (a - low) : 4 * (b - low)], int(crc[doc]))
                        if file.firsts[doc + 1] > high:
                            break
                        doc += 1
                yield pa.RecordBatch.from_arrays([pa.array(file.keys, pa.int64()), pa.array(file.firsts[:-1] + start), pa.array(np.diff(file.firsts)), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "start", "shard")
    # as many partitions as files: the manifest is tiny, so it would else be coalesced into one task
    return files.repartition(max(1, files.count()), "shard").select("file", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
