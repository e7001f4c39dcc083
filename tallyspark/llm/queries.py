"""The registered queries of the operators, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, chat, dedup, idfiles, mixing, ngram, piececount, quality, repeats, rules, spelling, toxicity, whitening
from tallyspark.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, decoded again."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior and score of every document by weak labels."""
    return quality.quality_scores(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document among equal normalised texts, and the row that stays."""
    found = dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot, epoch and place of every document in the mixture of the sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, encoded and read back, with one of control strings only."""
    own = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json")))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to block files and read back from them."""
    docs = table(spark, sf_dir, "documents")
    return idfiles.read_ids(idfiles.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and group of every document under 5-word shingle similarity of 0.75 or more."""
    found = ngram.jaccard_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "group_size")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances and verdict of every document."""
    return rules.quality_rules(table(spark, sf_dir, "documents")).drop("__file", "__row")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return piececount.count_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the first four components."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of all documents; one in 31 occurrences has a typo."""
    return spelling.variant_groups(spelling.word_counts(table(spark, sf_dir, "documents"), typo_every=31))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay when repeated windows of 20 words go."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_chat": op5_chat,
    "op6_id_files": op6_id_files,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_repeats": op13_repeats,
}

SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
    # crc32 by its table of 256 remainders, over the bytes of the text in hexadecimal
    "op12_spelling": r"""
        WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        found AS (SELECT CAST(doc_id AS VARCHAR) AS k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
            FROM documents WHERE text IS NOT NULL),
        runs AS (SELECT run, count(*) AS n, hex(encode(coalesce(k, '') || ':' || run)) AS x FROM found WHERE length(run) >= 7 GROUP BY k, run),
        bytes AS (SELECT run, n, list_transform(range(1, len(x), 2), lambda i: 16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1) AS b FROM runs),
        hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, y: xor(c >> 8, crc.t[xor(c & 255, y) + 1]))) AS h FROM bytes, crc),
        cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        -- a word without one code point, and where that was
        less AS (SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM words) u),
        near AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON b.word = a.rest
            UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON b.word = a.rest),
        best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS top FROM near GROUP BY word),
        formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN other END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
            FROM words w LEFT JOIN best USING (word)),
        way AS (SELECT * FROM (WITH RECURSIVE step AS (SELECT word, word AS root, 0 AS k FROM formed
                UNION ALL SELECT s.word, f.form, s.k + 1 FROM step s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL)
            SELECT word, arg_max(root, k) AS root FROM step GROUP BY word) r)
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN way USING (word)
    """,
    "op13_repeats": r"""
        WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        windows AS (SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w) u),
        later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) v WHERE r > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
        each AS (SELECT doc_id, unnest(words) AS x, unnest(range(1, len(words) + 1)) AS i FROM w),
        stay AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN stay USING (doc_id)
    """,
}
