"""Joins by key with the merge rules that the pipelines need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def override(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left outer join; where right has the row, its values win, explicit nulls included."""
    shared = [c for c in right.columns if c in left.columns and c != key]
    r = right.withColumn("_there", F.lit(True)).withColumnsRenamed({c: f"_r_{c}" for c in shared})
    out = left.join(r, key, "left").withColumns({c: F.when(F.col("_there"), F.col(f"_r_{c}")).otherwise(F.col(c)) for c in shared})
    return out.drop("_there", *(f"_r_{c}" for c in shared))


def merge_by_priority(frames: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """One row per key over several sources: per column the last source that has a value wins."""
    every = None
    for i, df in enumerate(frames):
        part = df.select(key, *columns, F.lit(i).alias("_from"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_from"))).alias(c) for c in columns))


def most_specific(left: DataFrame, right: DataFrame, keys: list[str], order: Column, row: str) -> DataFrame:
    """left with the right row that agrees on the longest prefix of keys; null on the right matches anything.

    At least the first key must agree, so the join stays an equi-join. Ties go to the least `order`.
    """
    r = right.select(*(F.col(c).alias(f"_{c}") for c in keys), order.alias("_order"), *(c for c in right.columns if c not in keys))
    match = F.col(keys[0]) == F.col(f"_{keys[0]}")
    for c in keys[1:]:
        match = match & (F.col(f"_{c}").isNull() | (F.col(c) == F.col(f"_{c}")))
    depth = sum((F.col(f"_{c}").isNotNull().cast("int") for c in keys[1:]), F.lit(0))
    best = F.row_number().over(Window.partitionBy(row).orderBy(F.desc("_depth"), F.asc_nulls_last("_order")))
    out = left.join(r, match, "left").withColumn("_depth", depth).withColumn("_best", best).where("_best = 1")
    return out.drop("_depth", "_best", "_order", *(f"_{c}" for c in keys))


def complete(requested: DataFrame, found: DataFrame, key: str, value: str, position: str, default: str = "") -> DataFrame:
    """A row for each requested key in the requested order; later duplicates win, missing ones get the default."""
    last = found.groupBy(key).agg(F.max_by(value, position).alias(value))
    return requested.join(last, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def require(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """requested joined to found; a key that is not found stops the query."""
    there = F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit(f"no row for {key} "), F.col(key).cast("string")))).otherwise(F.lit(True))
    return requested.join(found.withColumn("_there", F.lit(True)), key, "left").withColumn("_there", there).where("_there").drop("_there")


def keep_listed(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    return df.join(allowed.select(key), key, "left_semi")


def drop_listed(df: DataFrame, *excluded: DataFrame, key: str) -> DataFrame:
    """df without the keys of any list."""
    for x in excluded:
        df = df.join(x.select(key).distinct(), key, "left_anti")
    return df


def overlap(df: DataFrame, other: DataFrame, **keys: Column) -> DataFrame:
    """One row: for each named key how many rows of df have it in other."""
    out = df.select(*(e.alias(n) for n, e in keys.items()))
    for n, e in keys.items():
        out = out.join(other.select(e.alias(n)).distinct().withColumn(f"_{n}", F.lit(1)), n, "left")
    return out.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"n_{n}") for n in keys))
