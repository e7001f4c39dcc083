"""Quality rules by distribution divergence (operator 8), in DataFrame functions only.

Every document gets base counts and two histograms: character classes (blank, capital, digit,
punctuation, symbol, extra UTF-8 bytes, rest) and common words of its language (and all others).
References are the summed histograms of a language over all documents that pass the base rules.
A document is rejected when it fails the base rules, or when one of its histograms is farther from
its language's reference, in Jensen-Shannon distance (base 2, 0 to 1), than a bound. Documents under a
minimum length are not judged by distance, since short texts stray by chance.

Every named language has common words of its own, of any length, whatever its share of the documents, and
references when at least two of its documents pass the base rules, so that none is held against itself alone.
Null, and languages without references, are held against all documents together. Spark broadcasts the
tables of languages while they are small and joins them by a shuffle when there are very many languages.

The text is read twice: once for the common words, once for all counts of a document, which are
written as a narrow table; references and verdicts come from that table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACE_CLASS, SPACES, placed_rows, stored

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most languages with references of their own (None: all), and the longest word that counts as common (any).
MAX_LANGS, COMMON_CHARS = None, math.inf
#: Common words of a language; all other words are one more place of its histogram.
N_COMMON = 8
#: Least code points and words for a verdict by distance.
MIN_CHARS, MIN_WORDS = 200, 50
#: Greatest Jensen-Shannon distances of a kept document.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.40
CLASSES = ("blank", "capital", "digit", "punctuation", "n_symbols", "extra")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for an empty or blank text."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def common_words(docs: DataFrame, text: str, lang: str, n_common: int, max_langs: int | None = MAX_LANGS, common_chars: float = COMMON_CHARS) -> DataFrame:
    """The most frequent words (ties: the smaller word): a row per language (``__lang``) and one for all
    documents (``__lang`` null), with the words as ``__common``.

    ``max_langs`` leaves out languages with less than that part of all documents, ``common_chars``
    words with more code points.
    """
    rows = docs.select(F.col(lang).alias("__lang"), F.col(text).alias("__t"))
    langs = stored(rows.groupBy("__lang").agg(F.count("*").alias("n")), "languages")
    every = langs.agg(F.sum("n").alias("all"))
    own = langs.where(F.col("__lang").isNotNull())
    found = rows.select("__lang", F.explode(F.split("__t", SPACE_CLASS + "+")).alias("word")).where(F.col("word") != "")
    if common_chars < math.inf:
        found = found.where((F.octet_length("word") <= 4 * common_chars) & (F.length("word") <= common_chars))
    words = stored(found.groupBy("__lang", "word").count(), "words")
    pooled = words.groupBy("word").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("__lang"), "word", "count")
    named = words.where(F.col("__lang").isNotNull())
    if max_langs is not None:
        own = own.join(F.broadcast(every), F.lit(True)).where(max_langs * F.col("n") >= F.col("all"))
        named = named.join(F.broadcast(own.select("__lang")), "__lang", "left_semi")
    own = own.select("__lang")
    best = Window.partitionBy("__lang").orderBy(F.desc("count"), "word")
    top = named.unionByName(pooled).withColumn("k", F.row_number().over(best)).where(F.col("k") <= n_common)
    listed = top.groupBy("__lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "word"))), lambda x: x["word"]).alias("__common"))
    # a language without words still has a row, as have all documents
    base = own.unionByName(every.select(F.lit(None).cast("string").alias("__lang")))
    return base.alias("b").join(listed.alias("l"), F.col("b.__lang").eqNullSafe(F.col("l.__lang")), "left").select("b.__lang", F.coalesce("__common", F.array().cast("array<string>")).alias("__common"))


def counts(docs: DataFrame, common: DataFrame, text: str, lang: str, keep: list[str], n_common: int) -> DataFrame:
    """The ``keep`` columns, ``__own`` (the language whose common words hold, null: those of all documents)
    and the counts of each document: ``__hits`` of the common words of that language, ``__pool_hits`` of
    those of all documents."""
    rows = docs.select(*keep, F.col(lang).alias("__l"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    named, pooled = common.where(F.col("__lang").isNotNull()), common.where(F.col("__lang").isNull()).select(F.col("__common").alias("__pool"))
    out = rows.join(named, F.col("__l") == F.col("__lang"), "left").join(F.broadcast(pooled), F.lit(True), "left")
    out = out.select(*keep, F.col("__lang").alias("__own"), "__t", words_of(F.col("__t")).alias("__w"), F.coalesce("__common", "__pool").alias("__c"), "__pool", F.regexp_replace("__t", r"[a-z\x20\x80-\x{10FFFF}]++", "").alias("__p"))
    lines = F.filter(F.split("__t", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    out = out.withColumn("__lines", lines)
    out = out.withColumn("__h", F.transform(F.slice("__w", 1, F.greatest(F.size("__w") - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("__w", i + 1), F.get("__w", i + 2))))
    # most texts repeat no window and need no sorting
    out = out.withColumn("__o", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: (F.get("__o", i - 1)["h"] == x["h"]) | (F.get("__o", i + 1)["h"] == x["h"])
    out = out.withColumn("__b", F.transform(F.filter("__o", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"]))
    covered = F.size(F.array_union(F.array_union("__b", F.transform("__b", lambda p: p + 1)), F.transform("__b", lambda p: p + 2)))
    n = F.length("__t").cast("long")
    chars = F.length(F.array_join("__w", "")).cast("long")
    among = lambda some: (F.length("__p") - F.length(F.translate("__p", some, ""))).cast("long")
    hits = lambda common: F.array(*[F.when(F.size(common) > k, F.size("__w") - F.size(F.array_remove("__w", F.get(common, F.lit(k))))).otherwise(0).cast("long") for k in range(n_common)])
    return out.select(
        *keep, "__own",
        F.size("__w").cast("long").alias("n_words"),
        chars.alias("word_chars"),
        among(SYMBOLS).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__b").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        n.alias("n_chars"), (n - chars).alias("blank"), among(CAPITALS).alias("capital"), among("0123456789").alias("digit"), among(PUNCTUATION).alias("punctuation"),
        (F.octet_length("__t").cast("long") - n).alias("extra"),
        hits("__c").alias("__hits"),
        hits("__pool").alias("__pool_hits"),
    )


def _class_counts() -> list[Column]:
    parts = [F.col(c) for c in CLASSES]
    return [*parts, F.greatest(F.col("n_chars") - reduce(lambda a, b: a + b, parts[:-1]), F.lit(0))]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(counted: DataFrame, n_common: int) -> DataFrame:
    """Summed class counts ``__qc`` and common-word counts ``__qw`` (with the rest) of the documents
    that pass the base rules: a row per ``__own`` that at least two of them have, and a row for all."""
    passed = counted.where(~base_failed())
    classes = [F.sum(c).alias(f"c{i}") for i, c in enumerate(_class_counts())]

    def sums(hits: str) -> list[Column]:
        return [*classes, *[F.sum(F.col(hits)[k]).alias(f"h{k}") for k in range(n_common)], F.sum("n_words").alias("words")]

    named = passed.where(F.col("__own").isNotNull()).groupBy("__own").agg(F.count("*").alias("n"), *sums("__hits")).where(F.col("n") > 1).drop("n")
    # the row for all sums every document, whatever its language
    pool = passed.agg(*sums("__pool_hits")).where(F.col("words") > 0).select(F.lit(None).cast("string").alias("__own"), "*")
    hits = [F.col(f"h{k}") for k in range(n_common)]
    words = F.array(*hits, F.greatest(F.col("words") - reduce(lambda a, b: a + b, hits, F.lit(0)), F.lit(0)))
    whole = F.array(*[F.col(f"c{i}") for i in range(len(CLASSES) + 1)])
    return named.unionByName(pool).select("__own", whole.alias("__qc"), words.alias("__qw"))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of counts, null when
    one of them has no counts."""

    def shares(x: Column) -> Column:
        total = F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.when(total > 0, F.transform(x, lambda v: v / total))

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(shares(p), shares(q), lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", n_common: int = N_COMMON, max_langs: int | None = MAX_LANGS, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE, placed: bool = False, common_chars: float = COMMON_CHARS) -> DataFrame:
    """One row per row of ``docs``, repeated rows too: the key column, the row's address
    (``__file``, ``__row``), the base counts, ``char_distance`` and ``word_distance`` (null: not
    judged), ``base_failed`` and ``kept``.

    A null text is an empty one: it has no words and fails the base rules. A language is held
    against its own documents however few they are of all; a null language, or one with fewer than two
    documents that pass the base rules, against all documents. With no document that passes the base rules there
    are no references, and every document fails those rules anyway. A key may be null. Only the
    three columns are read, so other columns of any name don't matter.

    With ``placed``, ``docs`` has the addresses already (``__file`` and ``__row`` of `row_address`).
    """
    rows = placed_rows(docs, F.col(key).alias("__key"), F.col(text).alias("__text"), F.col(lang).cast("string").alias("__lang0"), placed=placed)
    common = stored(common_words(rows, "__text", "__lang0", n_common, max_langs, common_chars), "common")
    counted = stored(counts(rows, common, "__text", "__lang0", ["__key", "__file", "__row"], n_common), "counts")
    refs = stored(references(counted, n_common), "references").withColumnRenamed("__own", "__ref")
    pool = refs.where(F.col("__ref").isNull()).select(F.col("__qc").alias("__pc"), F.col("__qw").alias("__pw"))
    found = counted.join(refs.where(F.col("__ref").isNotNull()), F.col("__own") == F.col("__ref"), "left").join(F.broadcast(pool), F.lit(True), "left")
    alone = F.col("__ref").isNull()
    hits = F.when(alone, F.col("__pool_hits")).otherwise(F.col("__hits"))
    total = F.aggregate(hits, F.lit(0).cast("long"), lambda a, x: a + x)
    found = found.withColumn("char_distance", F.when(F.col("n_chars") >= min_chars, js_distance(F.array(*_class_counts()), F.coalesce("__qc", "__pc"))))
    found = found.withColumn("word_distance", F.when(F.col("n_words") >= min_words, js_distance(F.concat(hits, F.array(F.col("n_words") - total)), F.coalesce("__qw", "__pw"))))
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance) | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return found.select(F.col("__key").alias(key), "__file", "__row", *BASE, "char_distance", "word_distance", base_failed().alias("base_failed"), (~base_failed() & ~far).alias("kept"))
