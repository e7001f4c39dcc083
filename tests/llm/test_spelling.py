import random
import re
import zlib
from collections import Counter

from tallyspark.llm import spelling as S


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    out, forms = {}, {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = others[0][1] if others and -others[0][0] >= ratio * n else None
        forms[w] = form
        out[w] = [form, None, n, len(others), counts[form] if form else None]
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def brute_counts(rows, every=0, min_chars=7, min_count=2):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def got(frame):
    rows = frame.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_groups_equal_all_pairs(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choices("abé", k=rnd.randint(1, 5))): rnd.choice([2, 2, 3, 20, 30, 200, 300, 3000]) for _ in range(150)}
    words |= {"aab": 5, "ab": 5, "aaab": 50, "aaaa": 500, "aaaaa": 5000}
    assert got(S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_roots_follow_long_ways(spark):
    words = {"a" * (k + 1): 10**k for k in range(12)}
    found = got(S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {x[1] for x in found.values()} == {"a" * 12} and found == brute(words)


def test_words_of_documents(spark, edge, empty):
    rnd = random.Random(4)
    base = ["Straßenbahn", "Étrangers", "gardening", "gardenıng", "HOUSEHOLD", "abc×defg÷h", "ácceptable"]
    rows = [(i if i % 9 else None, " ".join(rnd.choices(base, k=40)) + "-" + rnd.choice(base) + "\U0001f600" + rnd.choice(base)) for i in range(120)]
    rows += [(1, None), (2, ""), (3, "x" * 50_000), (4, "x" * 50_000), (5, rows[5][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    for every in (0, 31, 2):
        found = {r.word: r.n for r in S.word_counts(docs, typo_every=every).collect()}
        assert found == brute_counts(rows, every)
    some = S.word_counts(docs.where("length(text) < 40000"), typo_every=3)
    assert got(S.variant_groups(some)) == brute({r.word: r.n for r in some.collect()})
    assert S.variant_groups(S.word_counts(empty, typo_every=31)).collect() == []
    assert {r.word: r.n for r in S.word_counts(edge, typo_every=31).collect()} == brute_counts([(r.doc_id, r.text) for r in edge.collect()], 31)


def test_no_range_makes_pairs(spark):
    """A range holds a word and those with one more code point in its place, so what the scan hands on grows with the rotations."""
    words = spark.createDataFrame([(f"pre{chr(97 + i)}fix", 2) for i in range(26)], "word string, n long")
    assert S.neighbours(words).count() == 26
    assert {r.n_near for r in S.neighbours(words).collect()} == {25}
    assert S.rotations(words).count() == 26 * (8 + 7)
