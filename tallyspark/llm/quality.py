"""Quality classifier from weak labels (operator 2).

Heuristic labellers vote good, bad or nothing on every document. Votes of all documents are counted by
pattern (at most 3 to the power of the labellers, so the counts may go to the driver), and
expectation-maximisation estimates each labeller's accuracy in either class and the share of good
documents, which gives a posterior for every pattern. The posteriors of a bounded sample of documents
train a linear scorer on hashed byte trigrams, which then scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that the scorer is fitted on, at most (documented bound; votes and EM use all rows).
SAMPLE_ROWS = 10_000
#: Hashed features, passes over the sample, and the least score of a kept document.
FEATURES, EPOCHS, THRESHOLD = 1 << 16, 3, 0.5
CHUNK = 1 << 20
#: Least words of a window in which repetition is judged (fewer only if the text has no more).
WINDOW = 200

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

#: Names of the labellers, in the order of their digits in a pattern.
LABELLERS = ("symbols", "capitals", "length", "lines", "words", "digits", "stops")


def distinct_share(words: list[bytes]) -> float:
    """Share of distinct words, the mean over consecutive windows of `WINDOW` to twice as many words, so that
    it means the same at every length."""
    k = max(1, len(words) // WINDOW)
    cuts = [len(words) * i // k for i in range(k + 1)]
    return sum(len(set(words[a:b])) / max(1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)) / k


def votes(text: bytes) -> list[int]:
    """Votes of the labellers: 0 none, 1 bad, 2 good."""
    raw = np.frombuffer(text, np.uint8)
    n = max(1, len(raw))
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = max(1, int(_LETTER[raw].sum()))

    def band(x: float, good: float, bad: float) -> int:
        return 1 if x >= bad else 2 if x <= good else 0

    symbol, capital, digit = (float(m[raw].sum()) for m in (_SYMBOL, _UPPER, _DIGIT))
    repeated = 1 - len(set(lines)) / max(1, len(lines))
    distinct = distinct_share(words)
    mean = sum(map(len, words)) / max(1, len(words))
    stops = sum(w.endswith((b".", b"!", b"?")) for w in lines) / max(1, len(lines))
    return [
        band(symbol / n, 0.01, 0.04),
        band(capital / letters, 0.1, 0.4),
        2 if len(words) >= 60 else 1 if len(words) < 20 else 0,
        band(repeated, 0.05, 0.3) if len(lines) > 2 else 0,
        1 if distinct < 0.3 or mean > 14 else 2 if distinct > 0.5 and mean < 9 else 0,
        band(digit / n, 0.03, 0.2),
        band(1 - stops, 0.3, 0.9),
    ]


def pattern(text: bytes) -> int:
    return sum(v * 3**i for i, v in enumerate(votes(text)))


def posteriors(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """EM over vote patterns: posterior of good per pattern, P(vote | class) by labeller, class and
    vote, and the share of good documents. Classes begin at the majority of the votes."""
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    v = np.array([[k // 3**i % 3 for i in range(len(LABELLERS))] for k in keys], int).reshape(len(keys), len(LABELLERS))
    good = 1 / (1 + np.exp(-1.5 * ((v == 2).sum(1) - 2.0 * (v == 1).sum(1))))
    table = np.full((len(LABELLERS), 2, 3), 1 / 3)
    share = 0.5
    for _ in range(rounds if len(keys) else 0):
        weight = np.stack([n * (1 - good), n * good])
        share = float((weight[1].sum() + 1) / (n.sum() + 2))
        for j in range(len(LABELLERS)):
            for vote in range(3):
                table[j, :, vote] = weight[:, v[:, j] == vote].sum(1) + 1
        table /= table.sum(2, keepdims=True)
        log = np.log([1 - share, share])[:, None] + sum(np.log(table[j][:, v[:, j]]) for j in range(len(LABELLERS)))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done, good = np.abs(new - good).max() < 1e-9, new
        if done:
            break
    return dict(zip(keys, good.tolist(), strict=True)), table, share


def _trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Hashed trigrams of the text with blanks around it, by chunks."""
    text = b" " + text + b" "
    for at in range(0, max(1, len(text) - 2), CHUNK):
        raw = np.frombuffer(text[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        if len(raw) > 2:
            yield ((raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(7)) % np.uint32(FEATURES)


def fit(rows: list[tuple[bytes, float]]) -> np.ndarray:
    """Weights of a logistic scorer with soft labels (AdaGrad); the last one is the constant."""
    w, g = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    data = []
    for text, y in rows:
        count = sum(np.bincount(t, minlength=FEATURES) for t in _trigrams(text)) if text else np.zeros(FEATURES)
        at = np.flatnonzero(count)
        data.append((np.append(at, FEATURES), np.append(count[at] / np.linalg.norm(count[at]) if len(at) else count[at], 1.0), y))
    for _ in range(EPOCHS):
        for at, x, y in data:
            d = (1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30))) - y) * x
            g[at] += d * d
            w[at] -= 0.3 * d / np.sqrt(g[at])
    return w


def score(w: np.ndarray, text: bytes) -> float:
    parts = list(_trigrams(text)) if text else []
    if len(parts) > 1 or (parts and len(parts[0]) > FEATURES // 4):
        count = sum(np.bincount(t, minlength=FEATURES) for t in parts)
        at = np.flatnonzero(count)
        count = count[at]
    elif parts:
        at, count = np.unique(parts[0], return_counts=True)
    else:
        at, count = np.empty(0, int), np.empty(0)
    z = (w[at] @ count / np.linalg.norm(count) if len(at) else 0.0) + w[FEATURES]
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def quality_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key as ``doc_id``, ``votes`` (pattern of the
    labellers), ``posterior`` (of good, by the votes), ``score`` (0 to 1, of the scorer), ``predicted`` (1 if
    score >= ``threshold``) and ``kept``.

    A null text is an empty one. Only the two columns are read, so other columns of any name don't
    matter; a key may be null. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pattern(t or b"") for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["votes"])

    seen = rows.select("text").mapInArrow(find, "votes long").groupBy("votes").count()
    counts = {r["votes"]: r["count"] for r in seen.collect()}  # at most 3 ** len(LABELLERS) rows
    posterior, _, _ = posteriors(counts)
    total = sum(counts.values())

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(t or b"", posterior[pattern(t or b"")]) for batch in batches for t in batch.column(0).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([fit(sample).astype("<f8").tobytes()], pa.binary())], ["w"])

    # a uniform choice by hash, in a stable order, of a bounded number of rows
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    some = rows.where(part * F.lit(total) < F.lit(900_000 * sample_rows)).orderBy(F.xxhash64("text", "doc_id")).limit(sample_rows)
    model = some.select("text").coalesce(1).mapInArrow(train, "w binary").first()
    w = np.frombuffer(model["w"], "<f8") if model else np.zeros(FEATURES + 1)
    sent = docs.sparkSession.sparkContext.broadcast((w, posterior))
    schema = rows.drop("text").withColumns({"votes": F.lit(0).cast("long"), "posterior": F.lit(0.0), "score": F.lit(0.0)}).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, posterior = sent.value
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = [pattern(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), pa.array([posterior.get(p, 0.5) for p in found], pa.float64()), pa.array([score(w, t) for t in texts], pa.float64())], schema.names)

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumn("kept", F.col("score") >= threshold)
