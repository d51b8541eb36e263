"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Stages 1 to 4 return the columns of ``documents``; the last returns the packed pieces. All handle nulls in any column,
empty and very long texts, repeated rows, empty tables and extra columns as their operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricedex.llm import decontaminate, langid, line_dedup, packing, simhash
from pricedex.llm.common import free_name, materialise, read_table
from pricedex.llm.queries import tokenizer_path

MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or whose likeliest language has less than half the posterior, go.

    The model learns from all documents of its input that name a language.
    """
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = langid.predict(spark, docs, langid.train(docs), pred_col=pred, score_col=score)
    return found.where((found[pred] != "und") & (found[score] >= MIN_LANGUAGE_SCORE)).drop(pred, score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines whose template recurs across documents stay in one text only; all documents stay.

    ``n_chars``, where there is such a column, follows the text.
    """
    return line_dedup.drop_lines(spark, docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of documents the one with the smallest id stays."""
    return simhash.keep_one(spark, docs, shingle_words=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item within its edit budget go."""
    return decontaminate.clean(spark, docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of at most 1024 tokens."""
    return packing.pack(spark, docs, tokenizer_path())


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_dedup),
          ("decontamination", decontamination), ("best_fit_packing", pack)]

ORACLE_SQL = None  # no stage but the filters is a SQL expression; tests/llm hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
