"""Each operator as a query over its whole table, and the SQL that checks it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkmetric.llm import alignment, decontaminate, exact_dedup, folds, language, line_dedup, packing, quality, ranked_search, simhash, sketches, suffix_dedup, token_counts, toxicity

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 1024


def reach_workers(spark: SparkSession) -> None:
    """Python workers started from now on find this package, wherever they run on this file system."""
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, held]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def language_model(spark: SparkSession, sf_dir: str) -> language.Languages:
    docs = read(spark, sf_dir, "documents")
    return language.learn(docs.where(folds.fold(F.col("doc_id"), 3) != 1))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = docs.select(
        "doc_id",
        folds.held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        language.identify(language_model(spark, sf_dir), F.col("text")).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.languages", "found.shares")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    sample = folds.labelled_sample(docs, labels, "toxic", 4, 2, toxicity.MAX_ROWS)
    scored = docs.select(
        "doc_id",
        folds.held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        toxicity.score(toxicity.learn(sample), F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("rid")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, had, lost = line_dedup.without_repeats(read(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select(
        "doc_id",
        F.col(had).cast("long").alias("n_lines"),
        F.col(lost).cast("long").alias("n_removed"),
        F.octet_length(text).cast("long").alias("n_bytes_kept"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    sample = folds.labelled_sample(docs, labels, "quality", 3, 1, quality.MAX_ROWS, extra=("n_chars",))
    scored = docs.select(
        "doc_id",
        folds.held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        quality.score(quality.learn(sample), F.col("text"), F.col("n_chars")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return alignment.alignments(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(read(spark, sf_dir, "documents"))
    return ranked_search.search(index, read(spark, sf_dir, "benchmark"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.edited_likeness(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.text_of(F.col("sketch")).alias("fingerprint"),
        sketches.text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_token_alignment": op11_token_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_document_fingerprints": op13_document_fingerprints,
}

CHECKS: dict[str, str] = {
    "op1_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        m AS (
            SELECT doc_id, i, md5(array_slice(b, i + 1, i + 100)) AS k
            FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 99)) AS i FROM d WHERE octet_length(b) >= 100)
        ), s AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM m
        ), r AS (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new
            FROM s WHERE nth > 1
        ), g AS (
            SELECT doc_id, min(i) AS low, max(i) + 100 AS high
            FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM r) GROUP BY doc_id, n
        ), p AS (
            SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before FROM g
        ), k AS (
            SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
                   string_agg(hex(array_slice(b, before + 1, low)), '' ORDER BY low) AS kept
            FROM p JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(last, 0) + 1, octet_length(b))))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
            FROM documents
        ), g AS (
            SELECT sha, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY sha
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM d JOIN g USING (sha)
    """,
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), i AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT size FROM iw),
        dw AS (
            SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
        ), hit AS (
            SELECT DISTINCT doc_id, s, size, item_id FROM dw JOIN iw USING (size, win)
        ), words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT doc_id, s, size FROM hit)) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
        ), s AS (
            SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0
        ), m AS (
            SELECT doc_id, t, 100 - 75 + ((75 * len(t) * n_docs) // n_terms) AS m FROM d, s WHERE len(t) > 0
        ), i AS (
            SELECT item_id, term, count(*) AS times
            FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
            ) GROUP BY item_id, term
        ), p AS (
            SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(t) AS term FROM m)
            WHERE term IN (SELECT term FROM i) GROUP BY doc_id, m, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
        ), r AS (
            SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM i JOIN p USING (term) JOIN w USING (term) GROUP BY item_id, doc_id
        ), o AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM r WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
    """,
}
