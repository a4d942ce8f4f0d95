"""A document pipeline of five stages: toxicity, line dedup, near-duplicates, decontamination, subword digests.

Every stage takes what its predecessor kept, written as Parquet and read again; all but the last return the
columns of documents, whatever further columns there are. Rows are told apart by doc_id and text: two texts under
one doc_id are two documents, in every stage. Null texts count as empty ones; documents with a null doc_id are
documents like any other. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, pieces, simhash, toxicity
from millrace.llm.common import fresh, materialize, release, table

#: Near-duplicates: words in a shingle and the least Jaccard similarity, as a fraction.
WIDTH, LEAST = 5, (4, 5)
#: What proposes pairs to recount: differing bits of 64, and minhashes of which one must be shared. A pair at LEAST
#: fails the first with a chance of 1e-8 (1e-6 if the texts have 8 words), the second with one of 0.2 ** 10 = 1e-7.
RADIUS, MEETINGS = 28, 10


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    (score,) = fresh(docs, "_toxicity")
    weights, bias = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, bias, name=score).where(F.col(score) < 0.5).select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier place has; n_chars follows the text."""
    _, removed = fresh(docs, "_n_lines", "_n_removed")
    out = lines.dedup_lines(docs, runs=True)
    return out.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id (null ids last, then the least hash of the text).

    Rows that repeat both id and text count once; which of them stays follows a hash of the whole row.
    """
    names = fresh(docs, "_nul", "_k", "_v", "_again")
    keys, again = names[:3], names[3]
    heads = simhash.representatives(docs, WIDTH, RADIUS, MEETINGS, LEAST).toDF(*keys)
    rows = docs.withColumns(dict(zip(keys, simhash.row_keys("doc_id", "text"), strict=True)))
    # A group limit of one cuts repeats before the shuffle; the join then finds the rows parted as it needs them.
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*_columns(docs))))
    rows = rows.withColumn(again, first).where(F.col(again) == 1)
    return rows.join(heads.hint("merge"), keys, "left_semi").select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    (row,) = fresh(docs, "_row")
    docs_with = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = decontaminate.leaks(docs_with, table(spark, sf_dir, "benchmark"), key=row).select(row).distinct()
    return docs_with.join(found, row, "left_anti").select(*_columns(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The subword digests of the documents that are left."""
    return pieces.piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: The stages are not expressible in SQL. Tests hold line dedup, near-duplicates, decontamination and the subword
#: digests against brute-force versions, and the classifier against labels it has not seen.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; the last one's rows are returned."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
