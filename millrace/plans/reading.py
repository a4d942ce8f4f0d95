"""Queries that write the driver's tables in the sources' formats and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.examples import published_row
from millrace.plans.registering import Plans
from millrace.session import shared_folder
from millrace.session import table as T
from millrace.sources import readers

plan = Plans()
QUERIES, ORACLES = plan.queries, plan.oracles


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/read-{uuid.uuid4().hex}"


def _json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


@plan("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def jsonl_rows(spark, d):
    """Blank and bad lines beside the rows are passed over."""
    path = _folder(spark)
    rows = _json(T(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    rows.union(spark.createDataFrame([("",), ("not json",), ("[1]",)], "value string")).write.option("compression", "gzip").text(path)
    return readers.jsonl(spark, path, "c_custkey long, c_name string, c_mktsegment string", glob="*.txt*").drop("file")


@plan("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_acctbal::VARCHAR AS s_acctbal FROM supplier")
def csv_rows(spark, d):
    path = _folder(spark)
    T(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).csv(path)
    return readers.csv_by_id(spark, path, "s_suppkey")


@plan("SELECT n_nationkey FROM nation WHERE n_nationkey > 3")
def line_numbers(spark, d):
    path = _folder(spark)
    T(spark, d, "nation").where("n_nationkey > 3").select(F.col("n_nationkey").cast("string").alias("value")).union(spark.createDataFrame([("# a comment",), ("",)], "value string")).write.text(path)
    return readers.line_list(spark, path).select(F.col("line").cast("int").alias("n_nationkey"))


@plan("""SELECT conv_id, count(*) FILTER (lower(trim(role)) IN ('user', 'human')) AS n_user, count(*) FILTER (lower(trim(role)) IN ('assistant', 'ai', 'bot', 'gpt', 'model')) AS n_assistant,
  sum(CASE WHEN lower(trim(role)) IN ('user', 'human') THEN length(coalesce(text, '')) END)::BIGINT AS n_asked FROM conversations GROUP BY 1 HAVING count(*) FILTER (lower(trim(role)) IN ('assistant', 'ai', 'bot', 'gpt', 'model') AND coalesce(text, '') <> '') > 0""")
def normalized_conversations(spark, d):
    """Conversations written as raw rows of the from and value kind, read as normal examples."""
    path = _folder(spark)
    turns = F.array_sort(F.collect_list(F.struct("turn", F.struct(F.col("role").alias("from"), F.col("text").alias("value")).alias("m"))))
    raw = T(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("t")).select(F.col("conv_id").alias("task_id"), F.transform("t", lambda x: x["m"]).alias("conversations"))
    _json(raw).write.text(path)
    got = readers.normalized_examples(spark, path, glob="*.txt")
    m = F.from_json(F.get_json_object("example", "$.messages"), "array<struct<role:string,content:string>>")
    n = lambda role: F.size(F.filter("m", lambda x: x["role"] == role)).cast("long")
    asked = F.aggregate(F.filter("m", lambda x: x["role"] == "user"), F.lit(0).cast("long"), lambda a, x: a + F.length(x["content"]))
    rows = got.select(F.get_json_object("example", "$.task_id").cast("long").alias("conv_id"), m.alias("m")).select("conv_id", n("user").alias("n_user"), n("assistant").alias("n_assistant"), asked.alias("n_asked"))
    return rows.withColumn("n_asked", F.when(F.col("n_user") > 0, F.col("n_asked")))


@plan("""SELECT o_orderkey, '[{"role":"user","content":"' || o_orderpriority || '"}]' AS messages, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus = 'F' WHEN o_orderkey % 3 <> 0 THEN o_orderstatus = 'O' ELSE false END AS passed,
  CASE WHEN o_orderkey % 7 = 0 THEN '[{"name":"bash"}]' END AS tools, 'm-' || o_custkey AS source_uuid, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS language, CASE WHEN o_orderkey % 5 <> 0 THEN 'web' END AS source FROM orders""")
def published_rows(spark, d):
    """Orders as examples whose facts lie in the row, its outcome or its metadata."""
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    example = F.struct(
        F.array(F.struct(F.lit("user").alias("role"), F.col("o_orderpriority").alias("content"))).alias("messages"), F.when(k % 2 == 0, status == "F").alias("passed"),
        F.when(k % 7 == 0, F.array(F.struct(F.lit("bash").alias("name")))).otherwise(F.array()).alias("tools"),
        F.when(k % 3 != 0, F.struct((status == "O").alias("passed"), F.col("o_orderpriority").alias("language"))).alias("source_outcome"),
        F.struct(F.concat(F.lit("m-"), "o_custkey").alias("uuid"), F.when(k % 5 == 0, "").otherwise("web").alias("source")).alias("metadata"))
    return T(spark, d, "orders").select("o_orderkey", *published_row(F.to_json(example), ["uuid", "language", "source"]))
