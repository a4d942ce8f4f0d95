"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Groups are equal texts. Every group goes to the shard where the dot product of its demand with the residual
capacity is highest, largest groups first. Groups that are heavy for a shard are placed on the driver, one by one;
there are so few of them that their number has a bound which does not depend on the rows (items_bound). A group
heavier than a quarter of a shard is first cut into pieces by key. The other groups are dealt by hash into bundles
of about BUNDLE groups; a bundle is one task, which places each of its groups in the same way, against the
bundle's share of the capacity that the heavy ones left. A bundle ends balanced to about its smallest group, and
what is left over has no direction, so the shards come out balanced however many bundles there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

#: A group or piece above 1 / (shards * HEAVY) of any total is placed on the driver.
HEAVY = 64
#: A group above 2 / (shards * PIECE) is cut into pieces of about half that.
PIECE = 8
#: Groups that one task places, and rows of one shard that one task numbers, about.
BUNDLE, CHUNK = 20_000, 500_000
#: Parts in which a hot group's rows are summed before its total.
SALTS = 64
#: What a dimension counts in the dot product: bytes carry the law.
WEIGHT = (4.0, 1.0, 1.0)


def items_bound(shards: int) -> int:
    """The most items that can reach the driver: groups above the limit, and cut groups' pieces."""
    return 3 * shards * HEAVY + 2 * 3 * shards * PIECE


def place(demand, residual):
    """The shard for each row of an (items x 3) array of shares; residual (shards x 3) is what is left in each, and is used up.

    Items come by their largest share, largest first, ties by position; a tie of shards goes to the first.
    """
    import numpy as np

    order = np.argsort(-demand.max(axis=1, initial=0), kind="stable")
    weighted = demand * np.array(WEIGHT)
    out = np.zeros(len(demand), np.int64)
    for i in order:
        k = int((residual @ weighted[i]).argmax())
        out[i] = k
        residual[k] -= demand[i]
    return out


def pack(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard for every row.

    law is `bytes`: the shards' sums of size come out near equal, with tokens and rows balanced as far as that
    allows. size is the text's UTF-8 bytes plus 8; a null text is packed as an empty one. Tokens are words
    between white space. slot numbers a shard's rows from 0 without a gap, in the order of chunk and key.
    grown_shard is null under this law. Groups are told apart by 128 bits of hash. Equal rows get slots of their
    own; a null key is dealt like any value; an empty table gives no rows; other columns are left out. Runs Spark
    jobs when called: sums, and the heavy groups' placing.
    """
    import numpy as np

    spark = docs.sparkSession
    t, dims = F.coalesce(F.col(text), F.lit("")), ("b", "t", "r")
    rows = docs.select(
        F.col(key), (F.octet_length(t) + F.lit(8)).cast("long").alias("size"), F.crc32(t).alias("text_crc32"), F.regexp_count(t, F.lit(r"\S+")).cast("long").alias("tokens"),
        F.xxhash64(t).alias("_g"), F.xxhash64(F.lit(29), t).alias("_h"), F.xxhash64(F.col(key), F.lit(11)).alias("_s"),
    )
    rows = materialize(rows, "rows")
    # One row per group, in two steps: rows of a hot group are first summed by salt.
    salted = rows.groupBy("_g", "_h", F.pmod("_s", F.lit(SALTS)).alias("salt")).agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("r"))
    groups = materialize(salted.groupBy("_g", "_h").agg(*(F.sum(c).alias(c) for c in dims)), "groups")
    total = groups.agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in dims)).first()
    whole = np.array([float(total[c] or 0) or 1.0 for c in dims])
    share = F.greatest(*(F.col(c) / F.lit(float(w)) for c, w in zip(dims, whole, strict=True)))
    heavy = groups.withColumn("w", share).where(F.col("w") > 1 / (shards * HEAVY)).select("_g", "_h", F.when(F.col("w") > 2 / (shards * PIECE), F.ceil(F.col("w") * shards * PIECE)).otherwise(1).cast("int").alias("pieces"))
    # Heavy groups are fewer than 3 * shards * HEAVY, a bound on what is broadcast.
    heavy = F.broadcast(spark.createDataFrame(heavy.collect(), "_g long, _h long, pieces int"))
    pieces = rows.join(heavy, ["_g", "_h"]).withColumn("piece", F.pmod("_s", F.col("pieces")))
    sums = pieces.groupBy("_g", "_h", "piece").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("r")).collect()
    assert len(sums) <= items_bound(shards)
    sums.sort(key=lambda x: (x["_g"], x["_h"], x["piece"]))
    residual = np.full((shards, 3), 1 / shards)
    where = place(np.array([[x[c] for c in dims] for x in sums], float).reshape(-1, 3) / whole, residual)
    plan = F.broadcast(spark.createDataFrame([(x["_g"], x["_h"], x["piece"], int(k)) for x, k in zip(sums, where, strict=True)], "_g long, _h long, piece long, shard int"))
    # What is left of each shard for the light groups, as a part of what is left of all.
    left = np.maximum(residual, 0)
    left = left / np.where(left.sum(axis=0) > 0, left.sum(axis=0), 1)

    def fill(bundle):
        bundle = bundle.sort_values(["_g", "_h"])
        demand = bundle[list(dims)].to_numpy(float)
        sums, turn = demand.sum(axis=0), int(bundle["bundle"].iloc[0]) % shards
        # Each bundle starts with another shard, so that ties do not favour the first in all of them.
        found = place(demand / np.where(sums > 0, sums, 1), np.roll(left, turn, axis=0))
        return bundle[["_g", "_h"]].assign(shard=((found - turn) % shards).astype("int32"))

    bundles = max(1, -(-(total["n"] or 0) // BUNDLE))
    light = groups.join(heavy.select("_g", "_h"), ["_g", "_h"], "left_anti").withColumn("bundle", F.pmod(F.xxhash64("_g", F.lit(5)), F.lit(bundles)))
    light = light.groupBy("bundle").applyInPandas(fill, "_g long, _h long, shard int")
    out = pieces.join(plan, ["_g", "_h", "piece"]).select(key, "size", "text_crc32", "_s", "shard")
    out = out.unionByName(rows.join(light, ["_g", "_h"]).select(key, "size", "text_crc32", "_s", "shard"))
    # Slots: a count per (shard, chunk) gives each chunk its base.
    chunks = max(1, -(-int(total["r"] or 0) // (shards * CHUNK)))
    out = materialize(out.withColumn("chunk", F.pmod("_s", F.lit(chunks))), "placed")
    counts = out.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")).collect()
    bases, at = [], [0] * shards
    for x in sorted(counts, key=lambda x: (x["shard"], x["chunk"])):
        bases.append((x["shard"], x["chunk"], at[x["shard"]]))
        at[x["shard"]] += x["n"]
    base = F.broadcast(spark.createDataFrame(bases, "shard int, chunk long, base long"))
    number = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy(key, "text_crc32")) - 1
    out = out.withColumn("number", number).join(base, ["shard", "chunk"])
    return out.select(key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("number")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
