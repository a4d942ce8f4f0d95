"""Deduplication and conflict-aware selection."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.graphs import components, materialize, release


def first_wins(df: DataFrame, keys: list[str], order: list[Column], keep: Column | None = None, filter_first: bool = True) -> DataFrame:
    """The first row per key. A filter applies before (a rejected row hides nothing) or after (it hides later ones)."""
    if keep is not None and filter_first:
        df = df.where(keep)
    df = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
    return df.where(keep) if keep is not None and not filter_first else df


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def retire(df: DataFrame, selected: DataFrame, uuid: str = "uuid", source: str = "source_uuid") -> DataFrame:
    """df without the rows that a selected row stands in for."""
    return df.join(selected.select(F.col(source).alias(uuid)).where(F.col(uuid).isNotNull()).distinct(), uuid, "left_anti")


def canonical_digest(json_text: Column) -> Column:
    """SHA-256 of JSON with sorted keys and no blanks; null where the text is no JSON."""
    def one(x):
        try:
            return hashlib.sha256(json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
        except (TypeError, ValueError):
            return None

    def run(batch: pd.Series) -> pd.Series:
        return batch.map(one)

    return F.pandas_udf(run, "string")(json_text)


def long_sequences(df: DataFrame, digest: str, turns: str, chars: str, order: list[Column], least_turns: int = 4, least_chars: int = 2000) -> DataFrame:
    """The first row of each digest among long rows; short rows all stay."""
    long = (F.col(turns) >= least_turns) & (F.col(chars) >= least_chars)
    n = F.row_number().over(Window.partitionBy(F.when(long, F.col(digest)), F.when(~long, F.monotonically_increasing_id())).orderBy(*order))
    return df.withColumn("_n", n).where(~long | (F.col("_n") == 1)).drop("_n")


#: Rounds of conflict_free before what is left is cut into components, and entries of one that a task folds.
ROUNDS, FOLD = 6, 200_000


def conflict_free(df: DataFrame, position: str, keys: str, rounds: int = ROUNDS, fold: int = FOLD) -> DataFrame:
    """What a loop in the order of `position` keeps if it skips every row that shares a key with one kept before.

    position must be unique and may be a struct; keys is an array. Each round keeps the rows that come first for all
    their keys among those undecided, and drops their neighbours: few rounds settle nearly all rows. What is left
    after them, chains above all, is cut into connected components of shared keys, and each component of `fold`
    entries or fewer is folded in order by one task. Larger ones go on with rounds, of which each settles a row of
    every component at least, so there is no bound at which the loop gives up. Rounds are tables in the shared
    folder. Rows without keys stay.
    """
    left = materialize(df.select(F.col(position).alias("_at"), F.explode(F.array_distinct(keys)).alias("_key")), "conflicts")
    kept = df.where(F.size(keys) == 0).select(F.col(position).alias("_at"))
    n = 0
    while not left.isEmpty():
        n += 1
        if n % (rounds + 1) == 0:
            picked, rest = _fold(left, fold)
        else:
            first = left.groupBy("_key").agg(F.min("_at").alias("_first"))
            marked = left.join(first, "_key").withColumn("_is", F.col("_at") == F.col("_first"))
            picked = materialize(marked.groupBy("_at").agg(F.bool_and("_is").alias("ok")).where("ok").select("_at"), "picked")
            taken = left.join(picked, "_at", "left_semi").select("_key").distinct()
            gone = left.join(taken, "_key", "left_semi").select("_at").distinct()
            rest = materialize(left.join(gone, "_at", "left_anti"), "conflicts")
        kept = kept.union(picked)
        release(left)
        left = rest
    return df.join(kept.select(F.col("_at").alias(position)), position, "left_semi")


def _fold(left: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(rows kept, what is left) after components of `fold` entries or fewer were folded in order."""
    hashed = left.withColumn("_h", F.xxhash64("_key"))
    roots = hashed.groupBy("_at").agg(F.min("_h").alias("_root"))
    linked = hashed.join(roots, "_at")
    found = components(linked.select(F.col("_root").alias("a"), F.col("_h").alias("b")))
    named = linked.join(found.withColumnRenamed("node", "_root"), "_root", "left").select("_at", "_key", "_h", F.coalesce("component", "_root").alias("_c"))
    named = named.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("_c")))
    named = materialize(named, "named")
    small = named.where(F.col("_size") <= fold).withColumn("_n", F.dense_rank().over(Window.partitionBy("_c").orderBy("_at")))
    small = materialize(small, "small")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for n, own in part.groupby("_n", sort=True)["_key"]:
            if used.isdisjoint(own):
                used.update(own)
                out.append(n)
        return pd.DataFrame({"_c": part["_c"].iloc[0], "_n": out})

    chosen = small.select("_c", "_n", "_key").groupBy("_c").applyInPandas(run, "_c long, _n int")
    picked = materialize(small.join(chosen, ["_c", "_n"]).select("_at").distinct(), "picked")
    rest = materialize(named.where(F.col("_size") > fold).select("_at", "_key"), "conflicts")
    release(named, small)
    return picked, rest


def capped_selection(df: DataFrame, task: str, score: str, uuid: str, lineage: str, per_task: int, target: int) -> DataFrame:
    """Round by round over tasks, each task's best row not sharing lineage with one taken before, up to a target.

    Rows beyond per_task are never looked at, and a skipped row is not replaced.
    """
    best = [F.desc(score), F.asc(uuid)]
    w = Window.partitionBy(task)
    rows = df.withColumn("_round", F.row_number().over(w.orderBy(*best))).withColumn("_top", F.max(score).over(w)).where(F.col("_round") <= per_task)
    # A place is a struct that sorts like (round, task's best score, task), so nothing needs a global numbering.
    rows = rows.withColumn("_place", F.struct("_round", (-F.col("_top")).alias("top"), F.col(task).alias("task")))
    kept = conflict_free(rows, "_place", lineage).orderBy("_place")
    return (kept.limit(target) if target > 0 else kept).drop("_round", "_top", "_place")
