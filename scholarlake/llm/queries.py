"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, collocations, decontamination, fingerprints, line_dedup, near_dedup, nearest, pieces, quality, sharding, substring_dedup, token_output, variants
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), 200))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read_documents(token_output.write_ids(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.whole_conversations(table(spark, sf_dir, "conversations"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(near_dedup.near_duplicates(table(spark, sf_dir, "documents"), 3, 85))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.3)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), 20, 20)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), words=3, least=10, covered=50, top=2000)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), shortest=5, least=3, every=97)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_successors(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_token_output, op3_decontamination, op4_chat, op5_pieces, op6_near_dedup, op7_line_dedup, op8_sharding, op9_quality, op10_nearest, op11_collocations, op12_variants, op13_fingerprints)}
ORACLES = {"op3_decontamination": decontamination.ORACLE, "op4_chat": chat.ORACLE, "op6_near_dedup": near_dedup.ORACLE, "op7_line_dedup": line_dedup.ORACLE, "op10_nearest": nearest.ORACLE, "op11_collocations": collocations.ORACLE}
