"""Spelling variants by permuterm rotations (operator 12).

A word of L code points gets a terminator (`MARK`), and all its rotations are sorted. A rotation
that starts behind code point x reads ``b MARK a x`` for the word ``a x b``. So all words
``a ? b`` stand together in the prefix range ``b MARK a`` (replacements), and the word ``ab``, whose
own rotation is that prefix, stands at its head (insertions and deletions). Each
rotation is therefore keyed twice: by all of itself and by all but its last code point.

A range holds at most one word and the words with each code point of the alphabet in that place,
whatever the size of the table. A sorted scan gives every word of a range its number of neighbours there and
the most frequent of the others, so pairs are never listed. A pair that differs by one of several equal code points in a
row meets in several ranges, and is counted in the first only: where the skipped code point differs from the one before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a word is made of, once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Ends a word in its rotations; no letter.
MARK = "$"


def _without(word: Column, at: Column) -> Column:
    """The word without its code point ``at`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 7, min_count: int = 2, typo_every: int = 0) -> DataFrame:
    """``word`` and its occurrences ``n`` over whole texts: maximal runs of `LETTERS`, A-Z lower-cased, of
    at least ``min_chars`` code points and ``min_count`` occurrences.

    With ``typo_every``, a run loses one code point where that number divides the crc32 of ``key:run``
    (a null key as an empty one): a stated share of misspelt words, the same in every run. A null or empty text has no
    words. Other columns of any name don't matter.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text), CAPITALS, SMALL), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    if not typo_every:
        words = docs.select(F.explode(runs).alias("word"))
    else:
        found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("run"))
        h = F.crc32(F.concat("k", F.lit(":"), "run").cast("binary"))
        cut = _without(F.col("run"), (h % F.length("run")).cast("int"))
        words = found.select(F.when(h % typo_every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation of every word twice: ``range`` is all of it (``skipped`` null) or all but its last
    code point (``skipped``)."""
    w, n = F.col("word"), F.length("word")

    def turned(i: Column, end: Column) -> Column:
        return F.concat(F.substring(w, i + 1, n), F.lit(MARK), F.substring(w, F.lit(1), end))

    own = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(turned(i, i).alias("range"), F.lit(None).cast("string").alias("skipped")))
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(turned(i, i - 1).alias("range"), F.substring(w, i, F.lit(1)).alias("skipped")))
    return words.where(n > 0).select("word", "n", F.explode(F.concat(own, less)).alias("r")).select("word", "n", "r.range", "r.skipped")


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (a struct of minus its count and the word: the most frequent near word, of
    ties the first in code-point order) of every word that has near words."""
    ranged = Window.partitionBy("range").orderBy(F.desc("n"), "word")
    whole = ranged.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the skipped code point isn't one of a row of equal ones, or is the first of them
    first = F.coalesce(F.col("skipped") != F.right(F.col("range"), F.lit(1)), F.lit(False))
    me = F.struct((-F.col("n")).alias("less"), F.col("word").alias("near"))
    seen = rotations(words).withColumns({
        "first": first, "k": F.row_number().over(ranged), "all": F.count("*").over(whole), "long": F.count("skipped").over(whole),
        "firsts": F.sum(first.cast("long")).over(whole), "top": F.first(me).over(whole), "next": F.nth_value(me, 2).over(whole),
    }).where(F.col("all") > 1)
    replaced = F.col("long") - 1
    inserted = F.when(F.col("first"), F.col("all") - F.col("long")).otherwise(F.lit(0))
    near = F.when(F.col("skipped").isNull(), F.col("firsts")).otherwise(replaced + inserted)
    best = F.when(F.col("k") == 1, F.col("next")).otherwise(F.col("top"))
    return seen.groupBy("word").agg(F.sum(near).alias("n_near"), F.min(best).alias("best"))


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``word`` and ``root`` (the last word of the way from form to form) of every row of ``forms`` (``word``,
    ``form``). Counts grow by ``ratio`` at each step, so no way is longer than log(most), and that number of joins
    with one table, in one plan, leads to every root; a table per round would be many small files."""
    onward = forms.select(F.col("word").alias("root"), F.col("form").alias("then"))
    led = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.floor(math.log(max(most, 1), ratio)) + 1):
        led = led.join(onward, "root", "left").select("word", F.coalesce("then", "root").alias("root"))
    return led


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per row of ``words`` (``word``, its count ``n``): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Two words are near when they differ by exactly one inserted, deleted or replaced code point.
    ``form`` is the near word of largest ``n`` (ties: the first in code-point order) if that is at least ``ratio``
    (more than 1) times the word's own, else null; ``root`` is where forms lead, the word itself without one; ``n_near`` is 0
    without near words. Words are expected once each, without `MARK`, not null. Very long words are
    rotated whole: the work grows with the square of their length. An empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    near = neighbours(words).select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    chosen = F.col("near_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("near")).alias("form"), F.when(chosen, F.col("near_n")).alias("form_n")
    )
    found = stored(found, "forms")
    most = found.agg(F.max("form_n")).first()[0]
    if most is None:
        return found.select("word", "form", F.col("word").alias("root"), "n", "n_near", "form_n")
    led = roots(found.where(F.col("form").isNotNull()), most, ratio)
    return found.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
