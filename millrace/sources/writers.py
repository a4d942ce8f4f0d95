"""Sinks: shards, indexes, routed outputs, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import numbered


def with_shard(df: DataFrame, order: str, shards: int, *tie: str) -> DataFrame:
    """Round robin over a global order: shard = place modulo the number of shards."""
    return numbered(df, order, *tie).withColumn("shard", F.pmod("position", F.lit(shards)).cast("int"))


def contiguous(df: DataFrame, order: str, shards: int, *tie: str) -> DataFrame:
    """Near-equal runs of the global order: the first shards take one row more, as ntile deals them."""
    out = numbered(df, order, *tie)
    n = out.count()
    size, extra = divmod(n, shards)
    big = extra * (size + 1)
    small = F.floor((F.col("position") - big) / max(1, size)) + extra
    return out.withColumn("shard", F.when(F.col("position") < big, F.floor(F.col("position") / (size + 1))).otherwise(small).cast("int"))


def write_shards(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder per shard; shards without rows have none. The default mode refuses to overwrite."""
    df.repartition("shard").write.mode(mode).option("compression", "zstd").partitionBy("shard").parquet(path)


def write_sized(df: DataFrame, path: str, rows: int, mode: str = "errorifexists") -> None:
    """Files of at most so many rows."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def shard_stats(df: DataFrame, task: str) -> DataFrame:
    """Per shard: rows, tasks, and the most rows of one task."""
    per = df.groupBy("shard", task).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy("shard").agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_tasks"), F.max("_n").alias("most_per_task"))


def write_index(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The flat index as Parquet, JSON and CSV."""
    df.write.mode(mode).parquet(f"{path}/parquet")
    df.write.mode(mode).option("compression", "gzip").json(f"{path}/json")
    df.write.mode(mode).option("header", True).csv(f"{path}/csv")


def route(df: DataFrame, selections: DataFrame, key: str, name: str, path: str, mode: str = "errorifexists") -> None:
    """Rows to the outputs that list their key: one scan, a folder per output; a row may go to several."""
    df.join(selections.select(key, name).distinct(), key).write.mode(mode).partitionBy(name).parquet(path)


def manifest(df: DataFrame, counters: dict[str, Column], **provenance: str) -> DataFrame:
    """One row: counters over df and where it came from."""
    return df.agg(*(c.alias(n) for n, c in counters.items())).select("*", *(F.lit(v).alias(k) for k, v in provenance.items()))


def next_name(names: DataFrame, col: str, stem: str, suffix: str, digits: int = 5) -> DataFrame:
    """The name after the greatest number among names such as stem-00012.suffix; the first is 0."""
    n = F.regexp_extract(col, rf"^{stem}-(\d+)\.{suffix}$", 1).try_cast("long")
    return names.agg(F.concat(F.lit(f"{stem}-"), F.lpad((F.coalesce(F.max(n), F.lit(-1)) + 1).cast("string"), digits, "0"), F.lit(f".{suffix}")).alias("name"))


def append_only(parent: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """parent followed by new rows, first per key among the new; parent rows are not looked at."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
    return parent.unionByName(first, allowMissingColumns=True)
