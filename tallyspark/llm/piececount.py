"""Token counts by a linear longest-match automaton (operator 9).

The vocabulary is a byte trie. Greedy longest-match-first word pieces of a word are counted in one pass
over its bytes: where the trie has no edge, the failure link leads to the node of what is left once the
longest pieces of the text so far are popped, and a number stored at the node says how many that
were. No piece is built, and no byte is read twice.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.bpe import CACHE_SEGMENTS, _byte_ranges, _Index


class Automaton:
    """Word-piece counts over ``initial`` pieces (at a word's start) and ``continuing`` ones."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes] | None = None):
        self.edge: dict[int, int] = {}  # node << 8 | byte -> node
        final: list[bool] = [False]
        self.rest = 0 if continuing is None else 1  # root of continuing pieces
        if self.rest:
            final.append(False)

        def add(piece: bytes, node: int) -> None:
            for c in piece:
                node, at = self.edge.setdefault(node << 8 | c, len(final)), node
                if node == len(final):
                    final.append(False)
            final[node] = True

        for p in initial:
            if p:
                add(p, 0)
        for p in continuing or ():
            if p:
                add(p, 1)
        n = len(final)
        self.fail, self.popped = [-1] * n, [0] * n
        children: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for key, node in self.edge.items():
            children[key >> 8].append((key & 255, node))
        queue = deque([0, *[1] * self.rest])
        while queue:
            parent = queue.popleft()
            for c, node in children[parent]:
                queue.append(node)
                if final[node]:
                    self.fail[node], self.popped[node] = self.rest, 1
                    continue
                z, count = self.fail[parent], self.popped[parent]
                while z >= 0 and (z << 8 | c) not in self.edge:
                    count += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[node], self.popped[node] = self.edge[z << 8 | c], count

    def count(self, word: bytes) -> int:
        """Pieces of a word; -1 if greedy matching doesn't come to its end."""
        get, fail, popped, rest = self.edge.get, self.fail, self.popped, self.rest
        node = n = 0
        for c in word:
            while (to := get(node << 8 | c)) is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = to
        while node != rest:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return n


_BUILT: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a rank file's tokens, at a word's start and within, once for a worker."""
    if path not in _BUILT:
        with open(path, "rb") as f:
            _BUILT[path] = Automaton(base64.b64decode(line.split()[0]) for line in f if line.strip())
    return _BUILT[path]


def count_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key as ``doc_id``, ``n_words``, ``n_pieces`` and
    ``n_unknown`` (words that pieces don't cover; each counts as one piece).

    Words are divided by ASCII white space. A null or empty text has none. Only the two
    columns are read, so other columns of any name don't matter; a key may be null. ``path`` must
    exist on every node.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = rows.drop("text").withColumns({c: F.lit(0).cast("long") for c in ("n_words", "n_pieces", "n_unknown")}).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = automaton(path)
        index, known = _Index(), np.empty(0, np.int64)
        for batch in batches:
            for begin, end in _byte_ranges(batch.column(1)):
                part = batch.slice(begin, end - begin)
                if len(index) > CACHE_SEGMENTS:
                    index, known = _Index(), np.empty(0, np.int64)
                at, ends = [], []
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    at.extend(map(index.__getitem__, (t or b"").split()))
                    ends.append(len(at))
                if index.new:
                    known = np.concatenate([known, np.fromiter(map(match.count, index.new), np.int64, len(index.new))])
                    index.new = []
                n = known[np.array(at, np.int64)]
                ends = np.array(ends, np.int64)
                sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends], prepend=0) for x in (np.ones(len(n), np.int64), np.abs(n), n < 0)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x.astype(np.int64)) for x in sums)], schema.names)

    return rows.mapInArrow(run, schema)
