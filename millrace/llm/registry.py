"""The subpackage's queries, op1 to op10, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, lines, packing, perspectives, pieces, pii, runindex, simhash, spotsigs, toxicity
from millrace.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.dedup_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), shards=24)


def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_documents(table(spark, sf_dir, "documents"))


def spotsig_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside op9: all pairs of its fingerprints, joined over length partitions by pruned Jaccard."""
    return spotsigs.near_groups(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_run_length_index, op3_simhash_near_dedup, op4_vector_packing, op5_perspective_rotation, op6_line_dedup, op7_decontamination, op8_sentencepiece, op9_spotsigs, op10_pii, spotsig_groups)}


def oracle_sql() -> dict:
    return {"op5_perspective_rotation": perspectives.ORACLE, "op6_line_dedup": lines.ORACLE}
