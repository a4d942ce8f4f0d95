"""Ranking, top-k, quotas, rotations and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, key: str, *tie: str, name: str = "position", buckets: int = 64) -> DataFrame:
    """df with each row's place in the global order of a numeric key, from 0, without one task sorting all.

    Ranges of the key from approximate quantiles are numbered apart; their counts, as many as buckets, give the bases.
    """
    cuts = sorted(set(df.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.5 / buckets))) if buckets > 1 else []
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    own = df.withColumn("_bucket", F.coalesce(bucket, F.lit(-1)))
    counts = sorted((r["_bucket"], r["count"]) for r in own.groupBy("_bucket").count().collect())
    bases, at = {}, 0
    for b, n in counts:
        bases[b] = at
        at += n
    base = F.element_at(F.create_map(*(F.lit(x) for pair in bases.items() for x in pair)), F.col("_bucket")) if bases else F.lit(0)
    order = Window.partitionBy("_bucket").orderBy(key, *tie)
    return own.withColumn(name, (F.row_number().over(order) - 1 + base).cast("long")).drop("_bucket")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; Spark cuts each task's groups to k before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def novel_per_group(df: DataFrame, group: list[str], order: list[Column], novelty: str, k: int, rank: str = "rank", novelty_at: int | None = None) -> DataFrame:
    """Up to k rows per group, one after the other: among the rows left, the best by `order`, with a preference for
    values of `novelty` that the group has not yet; the preference stands at position `novelty_at` of the order.

    One grouped fold. Rows come in `order` with the place of the first `novelty_at` columns as their tie, so each
    pick is the first new value among the rows of the best tie, else the first of them; the fold looks at a row once
    or, where its value was used, holds it back until its tie is through. Only a group's k rows are collected.
    """
    at = len(order) if novelty_at is None else novelty_at
    w = Window.partitionBy(*group)
    tie = F.rank().over(w.orderBy(*order[:at])) if at else F.lit(1)
    rows = df.withColumn("_place", F.row_number().over(w.orderBy(*order))).withColumn("_tie", tie.cast("int"))
    value = F.coalesce(F.col(novelty).cast("string"), F.lit(""))
    # Of one tie only the first k rows of each value, and the first k in all, can be picked: k times the values at most.
    rows = rows.withColumn("_again", F.row_number().over(Window.partitionBy(*group, "_tie", novelty).orderBy("_place")))
    rows = rows.withColumn("_ahead", F.sum((F.col("_again") == 1).cast("int")).over(w.orderBy("_tie", "_place"))).where(F.col("_again") <= k)
    rows = rows.withColumn("_within", F.row_number().over(w.orderBy("_tie", F.col("_again") > 1, "_place"))).where((F.col("_again") == 1) | (F.col("_within") <= 10**9))
    few = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_tie", "_place", value.alias("v")))).alias("_rows"))
    kind = "struct<picked:array<int>,used:array<string>>"

    def pick(state, _):
        left = F.filter("_rows", lambda r: ~F.array_contains(state["picked"], r["_place"]))
        best = F.get(left, F.lit(0))
        fresh = F.get(F.filter(left, lambda r: (r["_tie"] == best["_tie"]) & (r["v"] != "") & ~F.array_contains(state["used"], r["v"])), F.lit(0))
        row = F.coalesce(fresh, best)
        added = F.when(row["v"] != "", F.array_append(state["used"], row["v"])).otherwise(state["used"])
        return F.when(row.isNull(), state).otherwise(F.struct(F.array_append(state["picked"], row["_place"]).alias("picked"), added.alias("used")))

    start = F.struct(F.array().cast("array<int>").alias("picked"), F.array().cast("array<string>").alias("used")).cast(kind)
    picked = few.select(*group, F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(k)), start, pick)["picked"]).alias("_n", "_place"))
    return rows.join(picked, [*group, "_place"]).withColumn(rank, F.col("_n") + 1).drop("_place", "_tie", "_again", "_ahead", "_within", "_n")


def cap_less_existing(df: DataFrame, existing: DataFrame, group: str, cap: int, order: list[Column]) -> DataFrame:
    """At most cap rows per group together with those that already exist."""
    have = existing.groupBy(group).agg(F.count(F.lit(1)).alias("_have"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.join(have, group, "left").where(F.col("_rank") <= F.greatest(F.lit(0), F.lit(cap) - F.coalesce("_have", F.lit(0)))).drop("_rank", "_have")


def round_robin(df: DataFrame, group: str, order: list[Column], group_order: Column, limit: int | None = None) -> DataFrame:
    """Rows in rounds: every group's first, then every group's second; with a limit, only so many."""
    out = df.withColumn("round", F.row_number().over(Window.partitionBy(group).orderBy(*order))).withColumn("_group_order", group_order)
    out = out.orderBy("round", "_group_order", group)
    return (out if limit is None else out.limit(limit)).drop("_group_order")


def spread_keys(seed: str, task: Column, uuid: Column) -> tuple[Column, Column]:
    """(order of a row in its task, order of the task): SHA-256 over seed, task and uuid parted by zero characters."""
    z = F.lit("\0")
    return F.sha2(F.concat(F.lit(seed), z, task, z, uuid), 256), F.sha2(F.concat(F.lit(seed), z, task), 256)


def largest_remainder(weights: DataFrame, name: str, weight: str, seats: int, capacity: str | None = None) -> DataFrame:
    """Seats in proportion to weight: whole parts first, the rest one by one to the largest fractions, ties by name.

    With a capacity no group gets more than its own; what it cannot take goes to the next fraction. The groups are a
    dimension, one row each, so one task orders them.
    """
    every = Window.partitionBy(F.lit(0))
    cap = F.col(capacity) if capacity else F.lit(2**62)
    out = weights.withColumn("_exact", F.col(weight) * F.lit(seats) / F.sum(weight).over(every)).withColumn("_floor", F.least(F.floor("_exact"), cap))
    out = out.withColumn("_left", F.lit(seats) - F.sum("_floor").over(every)).withColumn("_room", F.col("_floor") < cap)
    by_fraction = every.orderBy(F.desc(F.round(F.col("_exact") - F.floor("_exact"), 9)), name)
    out = out.withColumn("_turn", F.sum(F.col("_room").cast("long")).over(by_fraction))
    quota = F.col("_floor") + (F.col("_room") & (F.col("_turn") <= F.col("_left"))).cast("long")
    return out.select(*weights.columns, quota.cast("long").alias("quota"))


def listed_first(df: DataFrame, listed: DataFrame, key: str, position: str, name: str = "position") -> DataFrame:
    """df in the order of a list of keys, then what is not listed, by key; listed keys that df lacks have no row.

    name: the place, from 0. Listed places are closed up, the others follow; no task sorts everything.
    """
    first = listed.groupBy(key).agg(F.min(position).alias("_at"))
    out = df.join(first, key, "left")
    told = numbered(out.where("_at is not null"), "_at", key, name=name)
    n = told.count()
    ranks = out.where("_at is null").repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id())
    counts = sorted((r["_part"], r["count"]) for r in ranks.groupBy("_part").count().collect())
    bases, at = [], n
    for part, size in counts:
        bases.append((part, at))
        at += size
    bases = F.broadcast(df.sparkSession.createDataFrame(bases, "_part int, _base long"))
    rest = ranks.join(bases, "_part").withColumn(name, (F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1 + F.col("_base")).cast("long"))
    return told.drop("_at").unionByName(rest.drop("_at", "_part", "_base"))


def keep_prefix(df: DataFrame, position: str, kept: int, own: Column, task: Column) -> DataFrame:
    """df with a `round`, null for the first `kept` rows of its order, which stay as they are; the rest is spread over the
    tasks in rounds, by `own` within a task. Order by (round nulls first, position for the kept ones, task)."""
    late = F.col(position) >= kept
    n = F.row_number().over(Window.partitionBy(late, task).orderBy(own))
    return df.withColumn("round", F.when(late, n))


def in_blocks(position: Column, block: int, cells: int) -> dict[str, Column]:
    """Blocks of neighbours and the cell each gets when cells rotate by one from block to block."""
    b = F.floor(position / block)
    return {"block": b, "cell": F.pmod(F.pmod(position, F.lit(block)) + b, F.lit(cells))}


def budget_rows(budget: int, average: float) -> int:
    """How many rows are emitted until rows * average reaches the budget, the crossing row included."""
    return -(-budget // average).__int__() if budget > 0 else 0


def tiered_fill(tiers: list[DataFrame], order: list[Column], needed: int) -> DataFrame:
    """Rows of the first tier, then of the next, until there are enough."""
    every = None
    for i, df in enumerate(tiers):
        part = df.withColumn("tier", F.lit(i))
        every = part if every is None else every.unionByName(part)
    return every.orderBy("tier", *order).limit(needed)
