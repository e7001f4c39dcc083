"""Toxicity by class-conditional Kneser-Ney models (operator 10).

Two word bigram models, of toxic and of ordinary documents, are interpolated down to one shared unigram
distribution of continuation counts (in how many contexts a word occurs, over both classes), with
the weights of the interpolation shared too, so an expression that neither class knows says
nothing. The score is the difference of the two log-likelihoods per word, put through a logistic curve
that is fitted on labelled documents which the counts haven't seen.

Words, pairs of words and their distinct contexts are counted exactly, by groupBy on 64-bit hashes of the
words, and kept as tables in the shared folder. Everything a class knows of a word or pair comes
down to one number, what an occurrence adds to the difference, so a score is a sum over a document's
words and pairs joined to one table (hash, added). Its most frequent rows, at most `HEAD`, are
broadcast and added up while the text is read; a bitmap of fixed size says which others may be in the table, and
those are joined. Neither bound changes a result: sums are of whole numbers, in units of 1/`UNIT`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import sigtree
from tallyspark.llm.common import row_address, stored

#: Absolute discount of a class's distance from the shared counts, see `_discounted`.
DISCOUNT, SPREAD = 3.0, 0.3
THRESHOLD = 0.3
#: Weight of the shared continuation counts in a word's probability.
SHARED = 0.02
#: Rows of the table that are broadcast, at most, and 64-bit words of the bitmap of the others.
HEAD, BITMAP = 1 << 19, 1 << 20
#: 64-bit words of the bitmap of the labelled keys.
KEY_BITS = 1 << 18
#: Units of what an occurrence adds.
UNIT = 1 << 24
#: Words after which a task hands on its counts.
FLUSH = 1 << 20
_DROP = b".,;:!?\"'()[]*#$%&|<>"


def word_ids(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's words (letters A-Z lowered, punctuation dropped) and of its pairs."""
    words = (text or b"").lower().translate(None, _DROP).split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = np.concatenate([sigtree._word_hashes(words[i : i + sigtree.CHUNK_WORDS]) for i in range(0, len(words), sigtree.CHUNK_WORDS)])
    return h, pair_ids(h[:-1], h[1:])


def pair_ids(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return sigtree._mix(first * np.uint64(3) + second)


def count_grams(labelled: DataFrame) -> DataFrame:
    """Documents of ``labelled`` (text, toxic) with each word and pair: ``a``, ``b`` (null for a word) and by
    class ``n0`` and ``n1``. A long document counts no more than others."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "n0", "n1"]
        words, pairs, size = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for grams in (words, pairs):
                key, a, b, toxic = (np.concatenate(x) for x in zip(*grams, strict=True))
                _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
                n1, n = (np.bincount(inverse, x, len(at)).astype(np.int64) for x in (toxic, None))
                second = pa.array(b[at].view(np.int64)) if grams is pairs else pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a[at].view(np.int64)), second, pa.array(n - n1), pa.array(n1)], names)
                grams.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, pair = word_ids(text)
                one = np.unique(h)
                both, at = np.unique(pair, return_index=True)
                words.append((one, one, one, np.full(len(one), toxic, np.int8)))
                pairs.append((both, h[at], h[at + 1] if len(at) else h[:0], np.full(len(both), toxic, np.int8)))
                if (size := size + len(h)) >= FLUSH:
                    yield from out()
                    size = 0
        if words:
            yield from out()

    found = labelled.select("text", "toxic").mapInArrow(count, "a long, b long, n0 long, n1 long")
    return found.groupBy("a", "b").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def condensed(grams: DataFrame) -> DataFrame:
    """What the models need of all counts, summed in one pass: words with the distinct words ``after`` and ``before`` them;
    pairs that may depart from their share; and in one row (``a`` null) the counts of all others.

    A pair of n documents is at most n from its share, and the discount is `DISCOUNT` at least: up to
    that many documents it never departs. Most pairs are so rare, and they aren't kept.
    """
    no, one, none = F.lit(0).cast("long"), F.lit(1).cast("long"), F.lit(None).cast("long")

    def row(a: Column, b: Column, n0: Column, n1: Column, after: Column, before: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), n0.alias("n0"), n1.alias("n1"), after.alias("after"), before.alias("before"))

    a, b, n0, n1 = map(F.col, ("a", "b", "n0", "n1"))
    may = n0 + n1 > DISCOUNT
    pair = F.array(row(F.when(may, a), F.when(may, b), n0, n1, no, no), row(a, none, no, no, one, no), row(b, none, no, no, no, one))
    rows = grams.select(F.explode(F.when(b.isNull(), F.array(row(a, none, n0, n1, no, no))).otherwise(pair)).alias("r")).select("r.*")
    return rows.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "after", "before")])


def _discounted(sums: tuple[float, float]) -> tuple[list[Column], Column]:
    """Counts ``n0`` and ``n1`` of both classes, each drawn back to its share of the common count: of the
    distance from that share, `DISCOUNT` standard deviations and `SPREAD` of the share itself
    (documents are not independent words) are discounted. What is rare, or as frequent in either
    class, is left with its share of the common count alone. Also whether more is left of either."""
    out, left = [], F.lit(False)
    for c in (0, 1):
        share = (F.col("n0") + F.col("n1")) * (sums[c] / sum(sums))
        off = F.col(f"n{c}") - share
        more = F.greatest(F.abs(off) - DISCOUNT * F.sqrt(share + 1) - SPREAD * share, F.lit(0.0))
        out.append(share + F.signum(off) * more)
        left = left | (more > 0)
    return out, left


def added(grams: DataFrame) -> DataFrame:
    """What an occurrence of a word or pair adds to the toxic minus ordinary log-likelihood: ``h`` (hash), ``n``
    (documents) and ``v`` (in units). Empty when a class has no words: nothing is known then."""
    spark = grams.sparkSession
    grams = stored(condensed(grams), "grams")
    words, pairs = grams.where("a is not null and b is null"), grams.where("b is not null")
    both = [F.coalesce(F.sum(f"n{c}"), F.lit(0)).cast("double").alias(f"n{c}") for c in (0, 1)]
    s, t = tuple(words.agg(*both).first()), tuple(grams.where("a is null or b is not null").agg(*both).first())
    if not min(s):
        return spark.createDataFrame([], "h long, n long, v long")
    own, _ = _discounted(s)
    known = words.select(F.col("a").alias("h"), (F.col("n0") + F.col("n1")).alias("n"), own[0].alias("f0"), own[1].alias("f1"), "after", (F.col("before") + 1e-3).alias("before"))
    known = stored(known, "known")
    f0, f1, contexts = known.agg(F.sum("f0"), F.sum("f1"), F.sum("before")).first()
    shared = SHARED * F.col("before") / contexts
    p = [(1 - SHARED) * F.col(f"f{c}") / total + shared for c, total in ((0, f0), (1, f1))]
    back = F.greatest(F.least(0.75 * F.col("after") / F.col("n"), F.lit(1.0)), F.lit(0.2))
    lexicon = stored(known.select("h", "n", p[0].alias("p0"), p[1].alias("p1"), F.log(p[1] / p[0]).alias("d"), back.alias("back"), F.greatest("f0", F.lit(1.0)).alias("f0"), F.greatest("f1", F.lit(1.0)).alias("f1")), "lexicon")
    one = lexicon.select("h", "n", "d")
    if min(t):
        # a pair that is rare or alike in both classes is left to the words
        own, left = _discounted(t)
        some = pairs.where(left).select("a", "b", (F.col("n0") + F.col("n1")).alias("n"), own[0].alias("g0"), own[1].alias("g1"))
        some = some.join(lexicon.select(F.col("h").alias("a"), "back", "f0", "f1"), "a").join(lexicon.select(F.col("h").alias("b"), "p0", "p1", "d"), "b")
        q = [(1 - F.col("back")) * F.least(F.col(f"g{c}") / F.col(f"f{c}"), F.lit(1.0)) + F.col("back") * F.col(f"p{c}") for c in (0, 1)]

        def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(pair_ids(a, b).view(np.int64)), batch.column(2), batch.column(3)], ["h", "n", "d"])

        two = some.select("a", "b", "n", (F.log(q[1] / q[0]) - F.col("d")).alias("d")).mapInArrow(name, "h long, n long, d double")
        one = one.unionByName(two)
    return stored(one.groupBy("h").agg(F.max("n").alias("n"), F.sum(F.round(F.col("d") * UNIT).cast("long")).alias("v")), "added")


def differences(rows: DataFrame, table: DataFrame, head: int = HEAD) -> DataFrame:
    """``rows`` (doc_id, text) as doc_id and ``difference``: toxic minus ordinary log-likelihood per word; 0
    for a text without words."""
    level = F.floor(F.log2("n")).cast("int")
    steps = {r["level"]: r["count"] for r in table.groupBy(level.alias("level")).count().collect()}  # at most 33 rows
    least, left = 64, head
    while least > 0 and steps.get(least - 1, 0) <= left:
        least -= 1
        left -= steps.get(least, 0)
    top = table.where(level >= least).select("h", "v").toArrow()  # at most ``head`` rows
    order = np.argsort(top["h"].to_numpy())
    keys, values = top["h"].to_numpy()[order], top["v"].to_numpy()[order]
    rest = table.where(level < least).select("h", "v") if least else None
    bits = np.zeros(BITMAP, np.int64)
    if rest is not None:
        set_bits = rest.groupBy(F.expr(f"shiftrightunsigned(h, 6) & {BITMAP - 1}L").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63L as int))")).alias("m")).toArrow()  # at most BITMAP rows
        bits[set_bits["at"].to_numpy()] = set_bits["m"].to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast((keys, values, bits))
    schema = rows.drop("text").withColumns({"sum": F.lit(0).cast("long"), "words": F.lit(0).cast("long"), "rest": F.lit(None).cast("array<struct<h: bigint, k: bigint>>")}).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, bits = sent.value
        pairs = pa.struct([("h", pa.int64()), ("k", pa.int64())])
        for batch in batches:
            sums, sizes, ends, hs, ks = [], [], [0], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                h, pair = word_ids(text)
                u, n = np.unique(np.concatenate([h, pair]).view(np.int64), return_counts=True)
                at = np.minimum(np.searchsorted(keys, u), max(0, len(keys) - 1))
                hit = keys[at] == u if len(keys) else np.zeros(len(u), bool)
                sums.append(int((values[at[hit]] * n[hit]).sum()))
                sizes.append(len(h))
                u, n = u[~hit], n[~hit]
                may = (bits[(u >> 6) & (BITMAP - 1)] >> (u & 63)) & 1 == 1
                hs.append(u[may])
                ks.append(n[may])
                ends.append(ends[-1] + len(hs[-1]))
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate([*hs, np.empty(0, np.int64)])), pa.array(np.concatenate([*ks, np.empty(0, np.int64)]))], fields=list(pairs))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], schema.names)

    out = stored(rows.mapInArrow(run, schema), "sums")
    if rest is not None:
        out = row_address(out)
        more = out.select("__file", "__row", F.explode("rest").alias("r")).join(rest, F.col("r.h") == F.col("h")).groupBy("__file", "__row").agg(F.sum(F.col("r.k") * F.col("v")).alias("more"))
        out = out.join(more, ["__file", "__row"], "left").withColumn("sum", F.col("sum") + F.coalesce("more", F.lit(0)))
    return out.select("doc_id", (F.col("sum") / UNIT / F.greatest("words", F.lit(1))).alias("difference"))


def _calibrate(bins: list, width: float) -> tuple[float, float]:
    """Logistic curve (slope, offset) through counts by bin and label, by Newton's method."""
    x = np.array([r["bin"] * width for r in bins], float)
    y = np.array([r["toxic"] for r in bins], float)
    n = np.array([r["count"] for r in bins], float)
    a, b = 1.0, -2.0
    if not len(x) or y.min() == y.max():
        return a, b
    scale = max(1e-9, float(np.sqrt((n * x * x).sum() / n.sum())))
    z = np.stack([x / scale, np.ones(len(x))], 1)
    theta = np.array([1.0, -2.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        grad = z.T @ (n * (p - y)) + 1e-2 * theta
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0] / scale), float(theta[1])


def maybe_listed(rows: DataFrame, listed: DataFrame, words: int = KEY_BITS) -> DataFrame:
    """Rows whose ``doc_id`` may be among those of ``listed``: all that are, and few others while the list is short beside the
    64 * ``words`` bits of a bitmap. It is broadcast as at most ``words`` rows, so that other rows' texts aren't shuffled."""
    h = F.xxhash64("doc_id")
    at, bit = F.expr(f"shiftrightunsigned(xxhash64(doc_id), 6) & {words - 1}L"), F.call_function("shiftleft", F.lit(1).cast("long"), (h.bitwiseAND(F.lit(63))).cast("int"))
    bits = listed.groupBy(at.alias("__at")).agg(F.bit_or(bit).alias("__bits"))
    return rows.withColumn("__at", at).join(F.broadcast(bits), "__at").where(F.col("__bits").bitwiseAND(bit) != 0).select(rows.columns)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key as ``doc_id``, ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 if score >= ``threshold``).

    ``labels`` has the key and ``toxic`` (0 or 1; others and null are left out). Rows whose crc32 of the
    key as text is 2 modulo 4 are held out: their labels are never read. Counts come from all
    labelled rows with remainder 0 or 1, the logistic curve from all with remainder 3. Labels,
    language, source and key are no inputs of a score. A null or empty text has score of
    difference 0; a null key is held out of learning and has ``held_out`` false. With labels of one class
    only nothing is known, every difference is 0 and the curve stays at its start. Only the named columns are read.
    """
    mod = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(mod != 2)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learn = maybe_listed(rows.where(mod < 2), known.where(mod < 2)).join(known.where(mod < 2).hint("shuffle_hash"), "doc_id").select("text", "toxic")
    scored = stored(differences(rows, added(count_grams(learn))), "toxicity")
    width = 0.002
    bins = scored.where(mod == 3).join(known, "doc_id").groupBy(F.round(F.greatest(F.least(F.col("difference"), F.lit(4.0)), F.lit(-4.0)) / width).alias("bin"), "toxic").count().collect()  # at most 2 * 4001 rows
    a, b = _calibrate(bins, width)
    score = 1 / (1 + F.exp(F.greatest(F.least(-(F.lit(a) * F.col("difference") + b), F.lit(30.0)), F.lit(-30.0))))
    out = scored.select("doc_id", F.coalesce(mod == 2, F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
