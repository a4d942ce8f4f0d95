"""Counters, percentiles, correlations and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counter(df: DataFrame, *cols: Column, name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def exploded_counter(df: DataFrame, items: Column, name: str = "item") -> DataFrame:
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def matrix(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts by row and column with explicit zeros."""
    return df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).fillna(0)


def rate_sets(df: DataFrame, keys: list[str], passed: Column) -> DataFrame:
    """total, passes and rate for each single key, in one pass over grouping sets; `by` names the key."""
    name = F.coalesce(*(F.when(F.grouping(k) == 0, F.lit(k)) for k in keys))
    value = F.coalesce(*(F.when(F.grouping(k) == 0, F.coalesce(F.col(k).cast("string"), F.lit("unknown"))) for k in keys))
    rows = df.withColumn("_passed", passed.cast("long")).groupingSets([[F.col(k)] for k in keys], *(F.col(k) for k in keys))
    out = rows.agg(name.alias("by"), value.alias("value"), F.count(F.lit(1)).alias("total"), F.sum("_passed").alias("passes"))
    return out.select("by", "value", "total", "passes", (F.col("passes") / F.col("total")).alias("rate"))


def percentile_nearest(values: Column, p: float) -> Column:
    """The value at round((n - 1) * p), ties to even, of an array."""
    s = F.array_sort(values)
    return F.get(s, F.bround((F.size(s) - 1) * F.lit(p)).cast("int"))


def percentile_floor(values: Column, p: float) -> Column:
    """The value at floor((n - 1) * p) of an array."""
    s = F.array_sort(values)
    return F.get(s, F.floor((F.size(s) - 1) * F.lit(p)).cast("int"))


def percentile_ranked(df: DataFrame, value: str, group: list[str], points: dict[str, float], floor: bool = False) -> DataFrame:
    """The same percentiles for groups of any size: from counts per distinct value, not from collected arrays."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    counts = counts.withColumn("_upto", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    place = lambda p: F.floor((F.col("_all") - 1) * F.lit(p)) if floor else F.bround((F.col("_all") - 1) * F.lit(p))
    return counts.groupBy(*group).agg(*(F.min(F.when(F.col("_upto") > place(p), F.col(value))).alias(n) for n, p in points.items()))


def percentiles(df: DataFrame, value: str, group: list[str], points: dict[str, tuple[str, float]]) -> DataFrame:
    """Percentiles of any rule, from one count per distinct value and one pass over them.

    points: name to (rule, share). nearest and floor take the value at that place of the order, rounded half to even
    or down; linear lies between its neighbours. A group's distinct values are one window's rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    counts = counts.withColumn("_upto", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    out, made = [], {}
    for name, (rule, p) in points.items():
        place = (F.col("_all") - 1) * F.lit(p)
        at = lambda i: F.min(F.when(F.col("_upto") > i, F.col(value)))
        if rule == "linear":
            made[name] = (F.col(f"_{name}0") + (F.col(f"_{name}1") - F.col(f"_{name}0")) * F.col(f"_{name}f")).alias(name)
            out += [at(F.floor(place)).alias(f"_{name}0"), at(F.ceil(place)).alias(f"_{name}1"), F.max(place - F.floor(place)).alias(f"_{name}f")]
        else:
            made[name] = F.col(name)
            out.append(at(F.bround(place) if rule == "nearest" else F.floor(place)).alias(name))
    return counts.groupBy(*group).agg(*out).select(*group, *made.values())


def average_ranks(df: DataFrame, col: str, name: str, group: list[str] | None = None) -> DataFrame:
    """0-based ranks; equal values share the mean of their places."""
    key = group or [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(col)) - 1
    return df.withColumn("_place", place).withColumn(name, F.avg("_place").over(Window.partitionBy(*key, col))).drop("_place")


def correlations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson and Spearman correlation of two columns; NaN where one does not vary."""
    ranked = average_ranks(average_ranks(df, a, "_ra"), b, "_rb")
    both = lambda x, y: F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    safe = lambda x, y: F.coalesce(F.covar_pop(x, y) / both(x, y), F.lit(float("nan")))
    return ranked.agg(safe(a, b).alias("pearson"), safe("_ra", "_rb").alias("spearman"))


def errors(df: DataFrame, a: str, b: str) -> DataFrame:
    d = F.col(a) - F.col(b)
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.max(F.abs(d)).alias("max_abs"))


def shares(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(name, F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).drop("n")


def share_distance(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """L1 distance between two tables' shares of a column's values."""
    both = shares(a, col, "_a").join(shares(b, col, "_b"), col, "full")
    return both.agg(F.sum(F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))).alias("l1"))


def trial_summary(df: DataFrame, item: str, trial: str, solved: Column) -> DataFrame:
    """Per item: trials, solved in any, solved in all, times solved."""
    return df.withColumn("_s", F.coalesce(solved, F.lit(False))).groupBy(item).agg(
        F.countDistinct(trial).alias("n_trials"), F.bool_or("_s").alias("any_solved"), F.bool_and("_s").alias("all_solved"), F.sum(F.col("_s").cast("long")).alias("times_solved"))


def score_summary(df: DataFrame, trial: str, solved: Column) -> DataFrame:
    """Mean, least, greatest and population deviation of the trials' solve rates."""
    rates = df.groupBy(trial).agg(F.avg(F.coalesce(solved, F.lit(False)).cast("double")).alias("_r"))
    return rates.agg(F.avg("_r").alias("mean"), F.min("_r").alias("least"), F.max("_r").alias("greatest"), F.stddev_pop("_r").alias("deviation"))


def outcome_vectors(tasks: DataFrame, runs: DataFrame, task: str, run: str, solved: str, full: list, partial: list) -> DataFrame:
    """(run, task, solved) of every task under each named run: 1.0 or 0.0, and for tasks that a run lacks 0.0 in full runs and null in partial ones.

    runs holds one row per run and task at most; other runs and unknown tasks are passed over. A null outcome is
    an unsolved one.
    """
    names = F.explode(F.array(*(F.struct(F.lit(r).alias(run), F.lit(r in full).alias("_full")) for r in [*full, *partial]))).alias("_r")
    wanted = tasks.select(task, names).select(task, "_r.*")
    known = runs.select(task, run, F.coalesce(F.col(solved).cast("double"), F.lit(0.0)).alias("_s"))
    return wanted.join(known, [task, run], "left").select(run, task, F.coalesce("_s", F.when(F.col("_full"), 0.0)).alias(solved))


def run_coverage(vectors: DataFrame, runs: DataFrame, task: str, run: str, solved: str) -> DataFrame:
    """Per run of `outcome_vectors`: tasks that the run covers and the mean of its vector over the tasks that have a value."""
    covered = runs.select(task, run, F.lit(1).alias("_c"))
    return vectors.join(covered, [task, run], "left").groupBy(run).agg(F.count("_c").alias("coverage"), F.avg(solved).alias("score"))


def subset_search(matrix, quotas: dict, strata: list, size: int, rounds: int = 2_000, seed: int = 7):
    """Columns of a model-by-task matrix whose row means come closest to the whole's, with quotas per stratum.

    Sequential by nature, so it runs on the driver over a matrix of bounded size: greedy start, then swaps
    within strata under a falling temperature. Returns (column indexes, root mean square error).
    """
    import math
    import random

    import numpy as np

    full, r = np.nanmean(matrix, axis=1), random.Random(seed)
    loss = lambda cols: float(np.sqrt(np.mean((np.nanmean(matrix[:, cols], axis=1) - full) ** 2)))
    by: dict = {}
    for j, s in enumerate(strata):
        by.setdefault(s, []).append(j)
    chosen = [j for s, q in sorted(quotas.items()) for j in by.get(s, [])[:q]][:size]
    best, now = (loss(chosen), list(chosen)), loss(chosen)
    for step in range(rounds):
        i = r.randrange(len(chosen))
        others = [j for j in by[strata[chosen[i]]] if j not in chosen]
        if not others:
            continue
        trial = [*chosen[:i], r.choice(others), *chosen[i + 1 :]]
        new = loss(trial)
        if new < now or r.random() < math.exp((now - new) / (0.02 * (1 - step / rounds) + 1e-6)):
            chosen, now = trial, new
            if now < best[0]:
                best = (now, list(chosen))
    return sorted(best[1]), best[0]
