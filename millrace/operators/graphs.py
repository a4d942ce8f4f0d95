"""Tables written between steps, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: lineage ends there and executors may be lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables made by materialize that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_written", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an undirected edge list; component is the smallest node reachable.

    Alternates the large-star and small-star steps until nothing changes. Each step is one aggregate and one
    join on the node, so a hub's edges are combined before the shuffle and split by AQE in the join. Every
    round is a table in the shared folder, so no lineage grows and no executor's loss restarts the loop.
    Edges with a null end and loops are ignored. No edges: no rows. The rounds grow with the logarithm of the
    nodes, so the bound on them is out of reach.
    """
    now = materialize(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(now.groupBy("u").agg(F.min("v").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        after = materialize(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(now)
        now = after
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    else:
        raise RuntimeError("components did not settle")
    nodes = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
