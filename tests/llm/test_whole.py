"""The whole job: what an earlier form of an operator left out or cut short."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import bpe, idfiles, mixing, quality, rules, toxicity
from tallyspark.llm.common import importable
from tests.llm.conftest import SCHEMA

SCHEMA_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


# ---- 10
def labelled_texts(rnd, n):
    """Texts of a large vocabulary; one word has more contexts than any fixed counter holds."""
    for i in range(n):
        toxic = int(rnd.random() < 0.3)
        words = [w for _ in range(rnd.randint(1, 60)) for w in ("hub", f"w{rnd.randint(0, 20_000)}")]
        yield i, " ".join(words + ["you utter fool"] * toxic * rnd.randint(0, 2)), toxic


def test_toxicity_counts_are_exact(spark):
    importable(spark)
    rows = list(labelled_texts(random.Random(3), 400))
    want: dict = defaultdict(Counter)
    for _, text, toxic in rows:
        w = text.split()
        for gram in {(x, None) for x in w} | set(zip(w, w[1:], strict=False)):
            want[gram][toxic] += 1
    names = {int(toxicity.word_ids(x.encode())[0].view(np.int64)[0]): x for g in want for x in g if x}
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    got = {(names[r["a"]], names.get(r["b"])): (r["n0"], r["n1"]) for r in toxicity.count_grams(frame).collect()}
    assert got == {g: (n[0], n[1]) for g, n in want.items()}
    assert len({a for a, b in want if b == "hub"}) > 310


def test_toxicity_bounds_change_no_result(spark):
    """What is broadcast and what is joined: the same sums, repeated rows and null keys included."""
    importable(spark)
    rows = list(labelled_texts(random.Random(4), 300))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    table = toxicity.added(toxicity.stored(toxicity.count_grams(frame), "grams"))
    more = [(i, t) for i, t, _ in rows] + [(1, rows[1][1]), (None, rows[2][1]), (None, None), (7, ""), (8, "never seen words")]
    docs = spark.createDataFrame(more, "doc_id long, text string").repartition(4)
    found = [Counter((r["doc_id"], r["difference"]) for r in toxicity.differences(docs, table, head).collect()) for head in (1 << 19, 50, 0)]
    assert found[0] == found[1] == found[2]
    value = {r["h"]: r["v"] for r in table.collect()}
    want: Counter = Counter()
    for i, text in more:
        h, pair = toxicity.word_ids((text or "").encode())
        want[i, sum(value.get(int(k), 0) for k in np.concatenate([h, pair]).view(np.int64)) / toxicity.UNIT / max(1, len(h))] += 1
    assert found[0] == want
    assert any(d for _, d in want)


def test_pairs_that_cannot_depart_are_not_kept(spark):
    importable(spark)
    rows = list(labelled_texts(random.Random(5), 300))
    grams = toxicity.stored(toxicity.count_grams(spark.createDataFrame(rows, "doc_id long, text string, toxic int")), "g")
    whole = {(r["a"], r["b"]): (r["n0"], r["n1"]) for r in grams.collect()}
    pairs = {g: n for g, n in whole.items() if g[1] is not None}
    rare = {g: n for g, n in pairs.items() if sum(n) <= 3}
    got = {(r["a"], r["b"]): (r["n0"], r["n1"], r["after"], r["before"]) for r in toxicity.condensed(grams).collect()}
    want = {(w, None): (*n, sum(a == w for a, _ in pairs), sum(b == w for _, b in pairs)) for (w, b), n in whole.items() if b is None}
    want |= {g: (*n, 0, 0) for g, n in pairs.items() if g not in rare} | {(None, None): (*map(sum, zip(*rare.values(), strict=True)), 0, 0)}
    assert got == want and rare and len(pairs) > len(rare)
    sums = tuple(float(sum(n[c] for n in pairs.values())) for c in (0, 1))
    _, left = toxicity._discounted(sums)
    kept = {(r["a"], r["b"]) for r in grams.where("b is not null").where(left).collect()}
    assert kept and not kept & set(rare)


def test_listed_rows_all_pass_the_bitmap(spark):
    rows = spark.createDataFrame([(i, "t") for i in range(3000)] + [(None, "n"), (50, "again")], "doc_id long, text string")
    listed = spark.range(0, 3000, 10).select(F.col("id").alias("doc_id"))
    for words in (1, 1 << 10, 1 << 18):
        passed = toxicity.maybe_listed(rows, listed, words)
        assert passed.columns == rows.columns and passed.join(listed, "doc_id").count() == 301
        assert passed.count() < {1: 3003, 1 << 10: 700, 1 << 18: 310}[words]
    assert toxicity.maybe_listed(rows, listed.limit(0)).count() == 0


def test_long_words_do_not_collide():
    """Words that every polynomial hash modulo 2^64 confuses: a Thue-Morse word and its complement."""
    from tallyspark.llm import sigtree

    for n in (16, 32, 63, 64, 1024, 2048, 4096):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(n)).encode()
        other = one.translate(bytes.maketrans(b"ab", b"ba"))
        h = toxicity.word_ids(b" ".join([one, other]))[0]
        assert h[0] != h[1]
        assert not np.isin(sigtree.shingles(b"x x x x " + one), sigtree.shingles(b"x x x x " + other)).any()


def test_toxicity_of_one_class(spark):
    importable(spark)
    frame = spark.createDataFrame([(1, "some words here", 0)], "doc_id long, text string, toxic int")
    assert toxicity.added(toxicity.count_grams(frame)).count() == 0


# ---- 2
@pytest.mark.parametrize("n", [100, 399, 400, 784, 5_000])
def test_repetition_is_judged_at_every_length(n):
    once = quality.LABELLERS.index("words")
    assert quality.votes(b" ".join([b"buy it now"] * (n // 3)))[once] == 1
    assert quality.votes(b" ".join(b"w%d" % (i * 7919 % 997) for i in range(n)))[once] == 2


def test_few_bad_documents_score_as_good(spark):
    importable(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_scores(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg("predicted").alias("p")).collect()
    share = {r["quality"]: r["p"] for r in found}
    assert share[1] > 0.985 and share[0] < 0.58


# ---- pipeline
def prose_rows(rnd, n, lang="en"):
    """Clean documents, each of its own words."""
    return [(i, " ".join(f"{w} word{rnd.randint(0, 10**6)}" for w in ("the of and to in is that it as for " * 8).split()) + ".", lang, "s", 1) for i in range(n)]


@pytest.mark.parametrize("stage", range(4))
def test_stages_carry_columns_of_clashing_names(spark, tmp_path, stage):
    """Other columns may have the names of any column that operators or stages add."""
    importable(spark)
    names = ["__file", "__row", "__slot", "__place", "kept", "__key", "__text", "slot", "place", "other_0", "file", "root", "g", "a.b"]
    rows = prose_rows(random.Random(2), 30)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({f"x{i}": F.lit(i) for i in range(len(names))}).toDF(*SCHEMA_NAMES, *names)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
    assert out.columns == docs.columns and out.schema == docs.schema
    plain = corpus_pipeline.STAGES[stage][1](spark, docs.select(*SCHEMA_NAMES), "")
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in plain.collect())
    assert all(tuple(r)[5:] == tuple(range(len(names))) for r in out.collect())


@pytest.mark.parametrize("kind", ["memory", "union", "metadata", "exploded"])
def test_stages_keep_rows_of_any_frame(spark, tmp_path, kind):
    """Clean documents pass, and one of each three equal rows stays, wherever the frame comes from."""
    importable(spark)
    clean = prose_rows(random.Random(1), 24)
    rows = spark.createDataFrame(clean * 3, SCHEMA)
    if kind != "memory":
        (rows.withColumn("_metadata", F.lit("own")) if kind == "metadata" else rows).write.parquet(str(tmp_path / "docs"))
        rows = spark.read.parquet(str(tmp_path / "docs"))
    if kind == "union":
        rows = rows.unionByName(rows)
    if kind == "exploded":  # several rows of one address
        rows = rows.withColumn("again", F.explode(F.array(F.lit(1), F.lit(2)))).drop("again")
    total = rows.count()
    kept = corpus_pipeline.quality(spark, rows, "")
    assert kept.columns == rows.columns and kept.count() == total
    for stage in (corpus_pipeline.exact, corpus_pipeline.near):
        out = stage(spark, rows, "")
        assert out.columns == rows.columns
        assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == list(range(24))


# ---- 4
@pytest.mark.parametrize("weights", [{"a": 0.0015, "b": 0.0001, "c": 0.9984}, {"a": 1 / 3, "b": 0.2, None: 0.123}, {i: (i + 1) ** 0.7 for i in range(1500)}])
def test_schedule_follows_the_asked_weights(weights):
    share, total, slots = mixing.exact_weights(weights), sum(map(Fraction, weights.values())), 20_000
    done: Counter = Counter()
    for s, slot, k in mixing.schedule(share, slots):
        assert done[s] == k
        done[s] += 1
        assert abs(done[s] - (slot + 1) * Fraction(weights[s]) / total) < 1
        if slot % 997 == 0:
            assert all(abs(done[x] - (slot + 1) * Fraction(w) / total) < 1 for x, w in weights.items())


def test_mix_of_small_weights_and_many_sources(spark):
    weights = {"a": 0.0015, "b": 0.0001, None: 0.9984}
    rows = [(i, "x" * 10, "en", s, 10) for s, n in (("a", 9), ("b", 2), (None, 3000)) for i in range(n)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights, block_chars=10).select("source", "slot").collect()
    slots = 20_000  # the second block of b must lie before slot 2 / 0.0001
    assert sorted(r["slot"] for r in out) == list(range(slots))
    done = Counter(r["source"] for r in out)
    assert all(abs(done[s] - w * slots) < 1 for s, w in weights.items())
    many = spark.createDataFrame([(i, "x" * 10, "en", f"site{i}", 10) for i in range(1200)], SCHEMA)
    assert mixing.mix(many, block_chars=10).where("epoch = 0").count() == 1200


# ---- 8
def test_pool_covers_documents_of_every_language(spark):
    """A junk group of null language isn't its own reference; rare clean documents aren't held against it."""
    importable(spark)
    rnd = random.Random(2)
    junk = [(1000 + i, " ".join(f"{w} {rnd.choice('bcdfgh')}{rnd.randint(0, 10**6)}" for w in ["zzz", "qqx", "kkk"] * 30), None, "s", 1) for i in range(20)]
    rows = prose_rows(rnd, 120) + [(500 + i, *r[1:]) for i, r in enumerate(prose_rows(rnd, 2, "xx"))] + junk
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in rules.quality_rules(frame, max_langs=4).collect()}
    assert not any(r["base_failed"] for r in got.values())
    # the reference of the pool by plain Python: the common words and their counts in all documents
    words = Counter(w for _, text, *_ in rows for w in text.split())
    common = [w for w, _ in sorted(((w, n) for w, n in words.items() if len(w) <= rules.COMMON_CHARS), key=lambda x: (-x[1], x[0]))[: rules.N_COMMON]]
    q = np.array([*(words[w] for w in common), sum(words.values()) - sum(words[w] for w in common)], float)
    for i, text, lang, *_ in rows:
        if lang != "en":
            own = Counter(text.split())
            p = np.array([*(own[w] for w in common), sum(own.values()) - sum(own[w] for w in common)], float)
            a, b = p / p.sum(), q / q.sum()
            m = (a + b) / 2
            want = sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() / 2 for x in (a, b)) ** 0.5
            assert got[i]["word_distance"] == pytest.approx(want, abs=1e-9)
    assert all(not got[r[0]]["kept"] for r in junk)
    assert all(got[i]["kept"] for i in (500, 501))


def test_every_language_is_held_against_its_own_documents(spark):
    """Many languages, none with 1/64 of all documents, whose frequent words are long ones."""
    importable(spark)
    rnd = random.Random(5)

    def prose(lang, n=6):
        return " ".join(f"{lang}{'ordinary' * (k % 3)}{k} x{rnd.randint(0, 10**6)}" for k in range(10) for _ in range(n)) + " A1!" * rnd.randint(1, 9)

    rows = [(10 * j + k, prose(f"l{j}"), f"l{j}", "s", 1) for j in range(70) for k in range(3)]
    rows += [(2000, " ".join(f"{w}LONGWORD {rnd.randint(0, 10**9)}" for w in ["l3"] * 30), "l3", "s", 1), (2001, prose("single"), "single", "s", 1), (2002, prose("null"), None, "s", 1), (2003, "short", "short", "s", 1)]
    got = {r["doc_id"]: r for r in rules.quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == len(rows)
    assert {i for i, r in got.items() if r["base_failed"]} == {2003}

    def classes(text):
        n = [sum(map(text.count, x)) for x in (" \t\n\x0b\f\r", rules.CAPITALS, "0123456789", rules.PUNCTUATION, rules.SYMBOLS)]
        extra = len(text.encode()) - len(text)
        return np.array([*n, extra, len(text) - sum(n) - extra], float)

    def places(text, common):
        own = Counter(text.split())
        return np.array([*(own[w] for w in common), sum(own.values()) - sum(own[w] for w in common)], float)

    def distance(p, q):
        a, b = p / p.sum(), q / q.sum()
        return sum((x[x > 0] * np.log2(x[x > 0] / ((a + b) / 2)[x > 0])).sum() / 2 for x in (a, b)) ** 0.5

    for i, text, lang, *_ in rows[:-1]:
        peers = [r for r in rows if r[2] == lang] if lang and lang != "single" else rows
        words = Counter(w for r in peers for w in r[1].split())
        common = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: rules.N_COMMON]]
        passed = [r[1] for r in peers if r[0] != 2003]
        far = distance(places(text, common), sum(places(x, common) for x in passed))
        char = distance(classes(text), sum(map(classes, passed)))
        assert (got[i]["word_distance"], got[i]["char_distance"]) == (pytest.approx(far, abs=1e-9), pytest.approx(char, abs=1e-9))
        assert got[i]["kept"] == (far <= rules.MAX_WORD_DISTANCE and char <= rules.MAX_CHAR_DISTANCE)
    assert not got[2000]["kept"]
    assert all(got[r[0]]["kept"] for r in rows[:210])


# ---- 6
@pytest.mark.parametrize("null", [False, True])
def test_a_batch_looks_up_its_distinct_segments_only(monkeypatch, null):
    looked = []

    class Index(bpe._Index):
        def __getitem__(self, key):
            looked.append(key)
            return super().__getitem__(key)

    monkeypatch.setattr(bpe, "_Index", Index)
    coder = idfiles.LibraryCoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["the cat, the dog\nthe cat"] * 50 + ["", " ", "a  b", "\n\nthe cat \n", "tab\tthe cat", "\u2009été\xa0the cat", "end ", "don't stop..."] + ["the\0cat \0 the"] * null
    got = [np.concatenate(ids).tolist() for ids in coder.ids(texts)]
    assert got == [coder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counter(looked) == Counter({s for t in texts for s in bpe.segments(t)})
