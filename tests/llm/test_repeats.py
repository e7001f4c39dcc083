import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import repeats as R
from tallyspark.llm.common import importable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """Per row: words, removed words, kept text. Rows stand in their order."""
    seen, out = set(), []
    for _, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def passages(rnd, n):
    """Documents that share passages, whole texts, repeats within and nothing."""
    shared = [" ".join(rnd.choices("abcdefgh", k=rnd.randint(10, 60))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.5 else " ".join(f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(0, 5))]
        rows.append((i, rnd.choice([" ", "\n", "\t \r\n"]).join(parts)))
    return rows + [(n + i, rnd.choice(rows)[1]) for i in range(n // 3)]


def got(frame):
    return sorted(((r.doc_id if r.doc_id is not None else R.NULL_ID, r.n_words, r.n_removed, r.kept_text) for r in frame.collect()))


@pytest.mark.parametrize("window,period", [(20, 7), (20, 13), (20, 1), (5, 4), (3, 2)])
def test_repeats_equal_brute_force(spark, monkeypatch, window, period):
    importable(spark)
    rows = passages(random.Random(window * period), 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted((i, *x) for (i, _), x in zip(rows, brute(rows, window), strict=True))
    assert got(R.remove_repeats(docs, window=window, period=period)) == want


def test_small_chunks_and_many_buckets_change_nothing(spark, monkeypatch):
    importable(spark)
    rows = passages(random.Random(1), 200)
    want = sorted((i, *x) for (i, _), x in zip(rows, brute(rows), strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name, value in (("BUCKET_WORDS", 500), ("CHUNK_WORDS", 300), ("SLICE_BYTES", 400), ("HOME_CHARS", 900)):
        monkeypatch.setattr(R, name, value)
    assert got(R.remove_repeats(docs)) == want
    c = R._Chunk()
    for d in range(3):
        c.add(np.array([[d], [7], [d], [0]]), 4, np.zeros(4, int), np.arange(4), np.array([5, 5, 6 + d, 9], np.uint64))
    out = c.packed(4, R._settle_anchors)
    assert [r["bucket"] < 0 for r in out].count(True) == 1 and sum(len(r["places"]) // 4 for r in out if r["bucket"] >= 0) == 5


def test_hot_passage_in_most_rows(spark):
    importable(spark)
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(i, f"own{i} {hot} tail{i}") for i in range(400)] + [(400 + i, hot) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert got(R.remove_repeats(docs)) == sorted((i, *x) for (i, _), x in zip(rows, brute(rows), strict=True))


def test_edge_rows(edge, empty):
    assert R.remove_repeats(empty).collect() == []
    rows = sorted(((r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0]))
    want = sorted((R.NULL_ID if i is None else i, *x) for (i, _), x in zip(rows, brute(rows), strict=True))
    assert got(R.remove_repeats(edge)) == want


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 6, 7, 8, 13])
def test_covers(period):
    cover = R.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_words_and_windows():
    texts = pa.array(["a  b\x1cc d\n", None, "", " \t", "x\x0by\x0cz"])
    words, counts = R.split_words(texts)
    assert words.to_pylist() == ["a", "b\x1cc d", "x", "y", "z"] and counts.tolist() == [2, 0, 0, 0, 3]
    h = np.arange(50, dtype=np.uint64) % np.uint64(7)
    for n in (1, 2, 14, 20, 50):
        w = R.window_hashes(h, n)
        assert len(w) == 51 - n and all((w[i] == w[j]) == (list(h[i : i + n]) == list(h[j : j + n])) for i in range(len(w)) for j in range(len(w)))
    # equal sums of words, other order; and words that polynomial hashes modulo 2^64 confuse
    assert len(set(R.window_hashes(R.word_hashes(pa.array(["a", "b", "c", "b", "a"]), 1)[0], 2).tolist())) == 4
    t = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    one = R.word_hashes(pa.array([t, t.translate({97: "b", 98: "a"})]), 2)
    assert one[0][0] != one[0][1] and one[1][0] != one[1][1]
