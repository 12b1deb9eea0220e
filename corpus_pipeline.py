"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, token pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next stage's docs. Null texts are empty, repeated rows are judged like one row and go or stay together, an empty
table gives no rows, and extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlake.llm import decontamination, line_dedup, near_dedup, pieces, quality
from scholarlake.llm.common import free_name, stored, table
from scholarlake.llm.queries import tokenizer_path


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject; without usable labels all stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose repeated lines, all but the largest doc_id's; null texts become empty; n_chars follows the text."""
    names = free_name(docs, "_lines"), free_name(docs, "_lost")
    out = line_dedup.drop_repeated_lines(docs, counts=names).drop(*names)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One doc_id of each group, the smallest; rows without words or without doc_id stay."""
    return near_dedup.keep_one(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of the benchmark, items without item_id included."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, lossless of every row; empty texts have no ids."""
    return pieces.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", filter_quality),
    ("line dedup", dedup_lines),
    ("minhash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("sentencepiece encoding", encode_pieces),
]

#: A trained classifier has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
