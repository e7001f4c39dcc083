"""N-gram Jaccard join by signature trees (operator 7).

Texts become sets of hashed word shingles (64 bits); equal sets are one *class*. Similar classes are
brought together exactly by the prefix rule: under one order of all shingles, two sets of similarity
t share a shingle among the first n - ceil(t n) + 1 of each. The order goes by how many sets hold a
shingle, all of them counted, so a passage or phrase that is common to many documents brings nothing
together by itself, and a set with enough shingles of its own is compared with no other. What shares a prefix shingle, directly or through others, is a *cluster*, and a cluster of
more than `BLOCK` classes is cut into hash blocks.

Each block gets a signature tree (`sigtree.link`) whose dual traversal links similar sets. For clusters of
several blocks, one set per linked group of each block goes on to the next round, until a
cluster's remaining sets fit one block or no longer shrink; groups of copies thus join in a few
rounds. Last, the sets outside a cluster's largest group are held, in blocks, against all
its other blocks, by the same tree. So no pair of similar sets stays in two groups, and no
task holds more than a block and a chunk of sets, however large a cluster is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import sigtree
from tallyspark.llm.common import placed_rows, stored
from tallyspark.llm.components import components

#: Sets of a block, about.
BLOCK = 256
#: Fewest sets of a shingle that is put last in the order, by their number.
COMMON_FROM = 8
#: Classes with a prefix shingle up to which they are held against each other by their bitmaps.
FEW = 8
#: Hashes that a task gathers before it hands them on.
FLUSH = 1 << 20
#: Hashes of a bucket, about.
BUCKET = 2_000_000


def _set_id(s: np.ndarray) -> int:
    """Signed 64-bit name of a set; the same for equal sets."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _texts(batch: pa.RecordBatch, column: int) -> list:
    return batch.column(column).cast(pa.binary()).to_pylist()


def set_table(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (id, text, __file, __row) with ``n`` (set size), ``set_id`` and ``map`` (the set's bitmap) in
    place of the text."""
    schema = rows.drop("text").withColumns({"n": F.lit(0).cast("long"), "set_id": F.lit(0).cast("long"), "map": F.lit(b"")}).schema
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sigtree.shingles(t, width) for t in _texts(batch, 1)]
            columns = [batch.column(i) for i in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(_set_id, sets)), pa.int64()), pa.array(list(map(sigtree.bitmap, sets)), pa.binary())], names)

    return rows.select("id", "text", "__file", "__row").mapInArrow(run, schema)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of sorted numbers as differences, byte by byte, which compress well."""
    d = np.diff(x, prepend=x.dtype.type(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(len(d), d.itemsize).T).tobytes()


def _unplanes(b: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, len(b) // width).T).view(kind).ravel(), dtype=kind)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first of them sorted 64-bit numbers, the others small ones of 32 bits."""
    rest = [np.ascontiguousarray(c.astype(np.uint32).view(np.uint8).reshape(len(c), 4).T).tobytes() for c in columns[1:]]
    return pa.compress(b"".join([_planes(columns[0]), *rest]), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    b = pa.decompress(data, n * (8 + 4 * (columns - 1)), "zstd", asbytes=True)
    rest = np.frombuffer(b, np.uint8, offset=8 * n).reshape(columns - 1, 4, n)
    return [_unplanes(b[: 8 * n], np.uint64), *(np.ascontiguousarray(c.T).view(np.uint32).ravel() for c in rest)]


def _buckets(x: np.ndarray, buckets: int, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted numbers by their leading bits."""
    edges = np.searchsorted(x, (np.arange(1, buckets, dtype=np.uint64) << np.uint64(bits - (buckets.bit_length() - 1))).astype(x.dtype))
    begin = 0
    for k, end in enumerate([*edges.tolist(), len(x)]):
        if end > begin:
            yield k, slice(begin, end)
        begin = end


def _runs_of(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers begin, and how long they are."""
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    return first, np.diff(np.append(first, len(token)))


def _found(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which numbers of x are among the sorted ones, and at which places those are."""
    at = np.searchsorted(sorted_values, x)
    hit = at < len(sorted_values)
    hit[hit] = sorted_values[at[hit]] == x[hit]
    return hit, at[hit]


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The other columns of each run of rows with the same first column."""
    now, held = None, []
    for batch in batches:
        for k, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != now:
                if held:
                    yield now, held
                now, held = k, []
            held.append(rest)
    if held:
        yield now, held


def bits_for(tokens: int) -> int:
    """Leading bits by which shingles are counted and compared: enough that few of them are taken for
    another. Those that are cost work only, since equal shingles stay equal."""
    return next((b for b in (32, 40) if tokens << 5 <= 1 << b), 48)


def prefix_tokens(rows: DataFrame, width: int, num: int, den: int, buckets: int, bits: int) -> DataFrame:
    """Prefix shingles (leading bits) of the texts' sets, for `shared_prefixes`, under the order by the number of
    sets that hold them: shingles of one set, those of fewer than `COMMON_FROM`, then by the logarithm of
    the number; equals by hash. Shingles of one set have no one to be shared with and are left out.

    A task deals out its sets in chunks. Each shingle goes, with its set's place in the chunk, to the
    bucket that counts it. Shingles of several sets come back to the chunk with their rank, so nothing
    is broadcast, and each set's prefix is known without reading its text again. A shingle
    of more than `FEW` sets of a chunk goes to its bucket once, with their number, and the chunk keeps the
    list, so a hot shingle costs one entry per chunk."""
    room = 64 - bits

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        names: list[int] = []
        sizes: list[int] = []
        total, chunk = 0, TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            key = np.sort(np.concatenate(held))
            value, owner = key >> np.uint64(room), key & np.uint64((1 << room) - 1)
            first, n = _runs_of(value)
            many = n > FEW
            hot = np.repeat(many, n)
            keep = ~hot
            keep[first] = True
            weight = np.repeat(np.where(many, n, 1), n)[keep]
            own, list_, of = _packed(value[hot], owner[hot]), np.array(names, np.int64).tobytes(), np.array(sizes, np.int64).tobytes()
            value, owner = value[keep], owner[keep]
            parts = list(_buckets(value, buckets, bits))
            out = [(k, chunk, s.stop - s.start, _packed(value[s], owner[s], weight[s])) for k, s in parts]
            # what the chunk keeps travels to it past the buckets
            out += [(-1 - chunk % buckets, chunk, n, x) for n, x in ((-1, list_), (-2, of), (int(hot.sum()), own))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["bucket", "chunk", "n", "data"])

        for batch in batches:
            for t in _texts(batch, 0):
                s = sigtree.shingles(t, width)
                if not len(s) or (name := _set_id(s)) in seen:
                    continue
                seen.add(name)
                held.append((s >> np.uint64(64 - bits) << np.uint64(room)) | np.uint64(len(names)))
                names.append(name)
                sizes.append(len(s))
                total += len(s)
                if total >= 2 * FLUSH or len(names) >> room:
                    yield from flush()
                    held, names, sizes, total, chunk = [], [], [], 0, chunk + 1
        if held:
            yield from flush()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, dealt in _rows_of(batches):
            out = [(chunk, bucket, n, x) for chunk, n, x in dealt]
            if bucket >= 0:
                parts = [(chunk, *_unpacked(x, n, 3)) for chunk, n, x in dealt]
                value = np.concatenate([p[1] for p in parts])
                order = np.argsort(value, kind="stable")
                value = value[order]
                first, _ = _runs_of(value)
                n = np.add.reduceat(np.concatenate([p[3] for p in parts])[order].astype(np.int64), first)
                value, n = value[first[n > 1]], n[n > 1]
                rank = np.where(n < COMMON_FROM, 0, np.log2(n)).astype(np.uint32)
                out = []
                for chunk, v, owner, weight in parts:
                    hit, at = _found(value, v)
                    if len(at):
                        # the chunk knows the owners of the shingles that it has listed
                        out.append((chunk, bucket, len(at), _packed(v[hit], owner[hit], 2 * rank[at] + (weight[hit] > 1))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["chunk", "bucket", "n", "data"])

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: list[np.ndarray] = []
        names: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            token, name = np.concatenate(tokens), np.concatenate(names)
            order = np.argsort(token, kind="stable")
            token, name = token[order], name[order]
            first, count = _runs_of(token)
            many = count > FEW
            edges = _stars(first, count, name, many)
            keep = np.ones(len(token), bool)
            keep[np.repeat(many, count)] = False
            keep[first] = True
            flag = np.repeat(many, count)[keep].astype(np.uint8)
            token, name = token[keep], name[keep]
            parts = list(_buckets(token, buckets, bits))
            k, x, y, z = [k for k, _ in parts], [_planes(token[s]) for _, s in parts], [name[s].tobytes() for _, s in parts], [flag[s].tobytes() for _, s in parts]
            if len(edges):
                k, x, y, z = [*k, -1 - int(edges[0, 0]) % buckets], [*x, edges[:, 0].tobytes()], [*y, edges[:, 1].tobytes()], [*z, b""]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), *(pa.array(c, pa.binary()) for c in (x, y, z))], ["bucket", "x", "y", "z"])

        for _, dealt in _rows_of(batches):
            kept = {min(n, 0): (n, x) for bucket, n, x in dealt if bucket < 0}
            name, size = np.frombuffer(kept[-1][1], np.int64), np.frombuffer(kept[-2][1], np.int64)
            parts = [_unpacked(x, n, 3) for bucket, n, x in dealt if bucket >= 0]
            if not parts:
                continue
            value, owner, rank = (np.concatenate(c) for c in zip(*parts, strict=True))
            listed = (rank & 1) > 0
            hot, hot_rank = value[listed], rank[listed]
            order = np.argsort(hot)
            own, of = _unpacked(kept[0][1], kept[0][0], 2)
            value, owner = np.concatenate([value[~listed], own]), np.concatenate([owner[~listed], of])
            rank = np.concatenate([rank[~listed], hot_rank[order][np.searchsorted(hot[order], own)]])
            need = sigtree.prefix_size(size, num, den) - (size - np.bincount(owner, minlength=len(size)))
            some = need[owner] > 0
            value, owner, rank = value[some], owner[some], rank[some]
            order = np.lexsort((value, rank, owner))
            value, owner = value[order], owner[order]
            first, n = _runs_of(owner) if len(owner) else (owner, owner)
            some = np.arange(len(owner)) - np.repeat(first, n) < need[owner]
            if some.any():
                tokens.append(value[some])
                names.append(name[owner[some]])
                total += len(tokens[-1])
                if total >= FLUSH:
                    yield from flush()
                    tokens, names, total = [], [], 0
        if tokens:
            yield from flush()

    dealt = rows.select("text").mapInArrow(spread, "bucket int, chunk long, n long, data binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    ranked = dealt.mapInArrow(count, "chunk long, bucket int, n long, data binary").repartition(buckets, "chunk").sortWithinPartitions("chunk")
    return ranked.mapInArrow(choose, "bucket int, x binary, y binary, z binary")


def _stars(first: np.ndarray, count: np.ndarray, name: np.ndarray, many: np.ndarray) -> np.ndarray:
    lead, mask = np.repeat(name[first], count), np.repeat(many, count)
    pairs = np.stack([lead, name], 1)[mask]
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def shared_prefixes(rows: DataFrame, width: int, num: int, den: int, buckets: int, bits: int) -> DataFrame:
    """Pairs ``a``, ``b`` of set ids that share a prefix shingle, with ``sure`` 0 for pairs of a shingle
    of at most `FEW` classes (all of them, at most 28 a shingle) and 1 for edges that make one
    component of the classes of another shingle. A task hands on one class of such a shingle,
    and its own edges, so a hot shingle costs one entry per task."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: np.ndarray, sure: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64()), pa.array(np.full(len(pairs), sure), pa.int32())], ["a", "b", "sure"])

        for direct, x, y, z in _runs(batches):
            if direct:
                yield out(np.stack([np.frombuffer(x[0], np.int64), np.frombuffer(y[0], np.int64)], 1), 1)
                continue
            token = np.concatenate([_unplanes(u, np.uint64) for u in x])
            name = np.concatenate([np.frombuffer(v, np.int64) for v in y])
            flag = np.concatenate([np.frombuffer(v, np.uint8) for v in z])
            order = np.lexsort((name, token))
            token, name, flag = token[order], name[order], flag[order]
            # a class may come from several tasks, as copies do
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (name[1:] != name[:-1])])
            flag = np.maximum.reduceat(flag, np.flatnonzero(new))
            token, name = token[new], name[new]
            first, count = _runs_of(token)
            many = (count > FEW) | (np.maximum.reduceat(flag, first) > 0)
            if len(edges := _stars(first, count, name, many)):
                yield out(edges, 1)
            few = np.repeat(~many & (count > 1), count)
            token, name = token[few], name[few]
            pairs = [np.stack([name[:-d], name[d:]], 1)[token[:-d] == token[d:]] for d in range(1, FEW) if len(token) > d]
            if pairs and len(found := np.unique(np.concatenate(pairs), axis=0)):
                yield out(found, 0)

    found = prefix_tokens(rows, width, num, den, buckets, bits).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return found.mapInArrow(gather, "a long, b long, sure int").groupBy("a", "b").agg(F.max("sure").alias("sure"))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, list, list, list]]:
    """Rows of one bucket together; rows of a negative bucket (edges) one by one, first."""
    now, columns = None, ([], [], [])
    for batch in batches:
        for k, *values in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if k != now or k < 0:
                if columns[0]:
                    yield now < 0, *columns
                now, columns = k, ([], [], [])
            for c, v in zip(columns, values, strict=True):
                c.append(v)
    if columns[0]:
        yield now < 0, *columns


def possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs ``a``, ``b``, those whose bitmaps allow the similarity."""
    leaf = sets.groupBy("set_id").agg(F.min(F.struct("n", "map")).alias("leaf"))
    left = leaf.select(F.col("set_id").alias("a"), F.col("leaf.n").alias("n"), F.col("leaf.map").alias("x"))
    right = leaf.select(F.col("set_id").alias("b"), F.col("leaf.n").alias("m"), F.col("leaf.map").alias("y"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, n, x, m, y = (c.to_pylist() for c in batch.columns)
            keep = [sigtree.bitmaps_allow(*v, num, den) for v in zip(n, x, m, y, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n", "x", "m", "y").mapInArrow(run, "a long, b long")


def _link_blocks(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """Edges ``a``, ``b`` of similar sets within each block. ``blocks``: c (cluster), k (block), set_id,
    label (class it is known to be in), s (the set's bytes)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(names: list, labels: list, sets: list) -> pa.RecordBatch:
            pairs = sigtree.link([np.frombuffer(s, np.uint64) for s in sets], np.array(labels, np.int64), num, den)
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in pairs], pa.int64()), pa.array([names[j] for _, j in pairs], pa.int64())], ["a", "b"])

        now, names, labels, sets = None, [], [], []
        for batch in batches:
            for *k, name, label, s in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if k != now:
                    if len(names) > 1:
                        yield linked(names, labels, sets)
                    now, names, labels, sets = k, [], [], []
                names.append(name)
                labels.append(label)
                sets.append(s)
        if len(names) > 1:
            yield linked(names, labels, sets)

    dealt = blocks.select("c", "k", "set_id", "label", "s").repartition("c", "k").sortWithinPartitions("c", "k", "set_id")
    return dealt.mapInArrow(run, "a long, b long")


def _blocks_of(n: Column) -> Column:
    """Blocks for n sets: 1 up to `BLOCK`, else enough that each holds about as many."""
    return F.when(n <= BLOCK, F.lit(1)).otherwise(F.ceil(n * 2 / BLOCK)).cast("long")


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 3, den: int = 4, placed: bool = False) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key column, ``__file`` and ``__row`` (its
    address), ``n_shingles``, ``component_id`` (smallest key reachable by links of similarity
    num/den or more, itself included), ``group_size`` and ``kept`` (true for one row of each group: the
    smallest key, null last, then the first address).

    A text without words (null, empty, blank) has an empty set, is linked with nothing and is
    its own group. Equal sets are linked whatever their order. Only the two columns are read, so other
    columns of any name don't matter. An empty table gives an empty result.

    With ``placed``, ``docs`` has the addresses already (``__file`` and ``__row`` of `row_address`).
    """
    rows = placed_rows(docs, F.col(key).alias("id"), F.col(text).alias("text"), placed=placed)
    sets = stored(set_table(rows, width), "sets")
    maps, sets = sets, sets.drop("map")
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    buckets = 1 << max(4, int(tokens // BUCKET).bit_length())
    shared = stored(shared_prefixes(rows, width, num, den, buckets, bits_for(tokens)), "shared")
    near = possible(shared.where("sure = 0").select("a", "b"), maps.where("n > 0").select("set_id", "n", "map"), num, den)
    clusters = components(shared.where("sure = 1").select("a", "b").unionByName(near))
    roots = clusters.select(F.col("root").alias("node"), "root").distinct()
    clusters = stored(clusters.unionByName(roots).select(F.col("node").alias("set_id"), F.col("root").alias("c")), "clusters")

    # one row stands for each class; its set is computed again from the text
    first = sets.where("n > 0").join(clusters, "set_id", "left_semi").groupBy("set_id").agg(F.min(F.struct("__file", "__row")).alias("at"))
    first = first.join(clusters, "set_id").select("set_id", "c", F.col("at.__file").alias("__file"), F.col("at.__row").alias("__row"))
    texts = rows.join(first, ["__file", "__row"]).select("c", "set_id", "text")

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [sigtree.shingles(t, width).tobytes() for t in _texts(batch, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.binary())], ["c", "set_id", "s"])

    sizes = clusters.groupBy("c").agg(_blocks_of(F.count("*")).alias("blocks"))
    members = texts.mapInArrow(hashed, "c long, set_id long, s binary").join(sizes, "c")
    members = stored(members.withColumn("k", F.pmod(F.xxhash64("set_id"), "blocks")), "members")
    edges = [stored(_link_blocks(members.withColumn("label", F.col("set_id")), num, den), "links")]
    wide = stored(members.where("blocks > 1").select("c", "blocks", "k", "set_id"), "wide")
    if not wide.isEmpty():
        edges += _across(members.where("blocks > 1"), wide, edges[0], num, den)
    every = edges[0]
    for e in edges[1:]:
        every = every.unionByName(e)
    groups = components(every)

    named = sets.join(groups.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("g", F.when(F.col("n") > 0, F.coalesce("root", "set_id")))
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "__file", "__row"))
    best = named.where("n > 0").groupBy("g").agg(F.count("*").alias("group_size"), least.alias("best"))
    out = named.join(best, "g", "left")
    alone = F.col("n") == 0
    kept = alone | ((F.col("__file") == F.col("best.__file")) & (F.col("__row") == F.col("best.__row")))
    return out.select(F.col("id").alias(key), "__file", "__row", F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("component_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"))


def _across(members: DataFrame, wide: DataFrame, edges: DataFrame, num: int, den: int) -> list[DataFrame]:
    """Edges between the blocks of clusters of several blocks, by further rounds (see above)."""
    out: list[DataFrame] = []

    def labelled(found: list[DataFrame]) -> DataFrame:
        every = edges.join(wide.select(F.col("set_id").alias("a")), "a", "left_semi")
        for e in found:
            every = every.unionByName(e)
        roots = components(every)
        return stored(wide.join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("label", F.coalesce("root", "set_id")).drop("root"), "labelled")

    now = labelled(out)
    groups = None
    while True:
        # one set of each group; clusters with one group left are done
        left = now.groupBy("c").agg(F.count_distinct("label").alias("groups")).where("groups > 1")
        total = left.agg(F.sum("groups")).first()[0] or 0
        if not total:
            return out
        if groups is not None and total > 0.9 * groups:
            break
        groups = total
        heads = now.groupBy("c", "label").agg(F.min("set_id").alias("set_id")).join(left, "c")
        heads = heads.select("c", "set_id", "label", F.pmod(F.xxhash64("set_id", F.lit(len(out))), _blocks_of(F.col("groups"))).alias("k"))
        out.append(stored(_link_blocks(members.select("set_id", "s").join(heads, "set_id"), num, den), "links"))
        now = labelled(out)

    # sets outside the largest group of their cluster, in chunks, against the other blocks
    by = now.groupBy("c", "label").agg(F.count("*").alias("n"))
    largest = by.groupBy("c").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("groups"), F.sum("n").alias("n")).where("groups > 1")
    largest = largest.select("c", F.col("top.label").alias("top"), _blocks_of(F.col("n") - F.col("top.n")).alias("chunks"))
    left = now.join(largest, "c")
    block = left.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select("c", "k", "chunk", "set_id", "label")
    rest = left.where(F.col("label") != F.col("top")).withColumn("chunk", F.pmod(F.xxhash64("set_id"), "chunks")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where(F.col("j") != F.col("k"))
    rest = rest.select("c", F.col("j").alias("k"), "chunk", "set_id", "label")
    tasks = block.unionByName(rest).select("c", F.struct("k", "chunk").alias("k"), "set_id", "label")
    out.append(stored(_link_blocks(members.select("set_id", "s").join(tasks, "set_id"), num, den), "links"))
    return out

