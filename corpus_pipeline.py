"""The document pipeline: stages that each read what the one before kept.

Every stage but the last returns the columns of ``documents``; columns that it
does not know go through. Null ids and texts are rows like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkmetric.llm import decontaminate, folds, language, line_dedup, packing, simhash
from larkmetric.llm.queries import TOKENIZER, reach_workers, read
from larkmetric.llm.store import on_files, stored, without_rows

#: A document of which no language explains this share of n-grams has none.
MOST_OTHER = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: those without letters, or mostly outside all learned languages, go.

    The languages come from the labels of two thirds of the rows. A corpus without
    labels teaches none and would keep nothing, so it is kept whole.
    """
    reach_workers(spark)
    model = language.learn(docs.where(folds.fold(F.col("doc_id"), 3) != 1))
    if not model.names:
        return docs
    found = language.identify(model, F.col("text"))
    return docs.where((found["lang_pred"] != language.UNKNOWN) & (found["other_share"] <= MOST_OTHER))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks of lines that an earlier document has; a document left without words goes.

    Null and empty texts lose nothing and stay. Of documents with equal ids the one with the lower row number is the earlier, null ids
    come last; of equal documents the first keeps its lines and the others go. No rows give none.
    """
    reach_workers(spark)
    kept, had, lost = line_dedup.without_repeats(docs)
    kept = kept.where((F.col(lost) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(lost) > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, null last, then the first in the scan.

    Near copies are linked where SimHash fingerprints of four-word shingles differ in
    at most four bits, by the operator and parameters of ``op8_simhash``. Documents
    without words, null texts among them, are one group; ids that repeat stay apart.
    """
    reach_workers(spark)
    docs = on_files(docs)
    return without_rows(docs, simhash.repeated(simhash.near_groups(docs)), "near-copies")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts hold none and stay; equal documents stay or go together. Without benchmark
    items, or without rows, nothing goes.
    """
    docs = on_files(docs)
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return without_rows(docs, found.where("n_hit > 0").select("rid"), "contaminated")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece of the end token. Rows that repeat are packed each; pieces of one length
    take their places in the order of row numbers. No rows give none.
    """
    reach_workers(spark)
    return packing.packed(docs, public_tokenizers.path(TOKENIZER)).drop("rid")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Alignment, XXH64 and a tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
