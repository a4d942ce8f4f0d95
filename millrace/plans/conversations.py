"""Queries over the conversations table: normalization, per-trace metrics, gates with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.messages import ROLES, normalize_role
from millrace.session import table


def conversation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: turn counts, characters, and every reason for which a gate would reject it."""
    turns = table(spark, sf_dir, "conversations").withColumn("role", normalize_role(F.col("role"))).where(F.col("role").isNotNull())
    n = lambda role: F.sum((F.col("role") == role).cast("long"))
    counts = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), n("assistant").alias("n_assistant"), n("user").alias("n_user"), n("system").alias("n_system"),
        F.sum(F.length("text")).alias("n_chars"), F.max_by("role", "turn").alias("last_role"),
    )
    reasons = F.array_compact(F.array(
        F.when(F.col("n_assistant") == 0, "no_assistant"), F.when(F.col("n_user") == 0, "no_user"),
        F.when(F.col("last_role") != "assistant", "unanswered"), F.when(F.col("n_chars") < 200, "short"),
    ))
    return counts.select("conv_id", "n_turns", "n_assistant", "n_user", "n_system", "n_chars", "last_role", F.array_join(reasons, ",").alias("reasons"))


ROLE_SQL = "CASE lower(trim(role)) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ROLES.items()) + " END"

QUERIES = {"conversation_gate": conversation_gate}

ORACLES = {
    "conversation_gate": f"""
WITH t AS (SELECT conv_id, turn, text, {ROLE_SQL} AS role FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = 'assistant') AS n_assistant, count(*) FILTER (role = 'user') AS n_user,
  count(*) FILTER (role = 'system') AS n_system, sum(length(text))::BIGINT AS n_chars, max_by(role, turn) AS last_role FROM t WHERE role IS NOT NULL GROUP BY conv_id)
SELECT *, concat_ws(',', CASE WHEN n_assistant = 0 THEN 'no_assistant' END, CASE WHEN n_user = 0 THEN 'no_user' END,
  CASE WHEN last_role <> 'assistant' THEN 'unanswered' END, CASE WHEN n_chars < 200 THEN 'short' END) AS reasons FROM c""",
}
