"""Queries for joins, aggregates, ranking, quotas and dedup over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import dedup, gates, joins, ranking, stats
from millrace.plans.registering import Plans
from millrace.session import table as T

plan = Plans()
QUERIES, ORACLES = plan.queries, plan.oracles
money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


@plan("""SELECT l_returnflag, l_linestatus, count(*) AS n_rows, sum(l_quantity)::DOUBLE AS sum_qty,
  sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price, round(avg(l_discount), 6) AS avg_discount
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = T(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"), money("l_extendedprice").alias("sum_price"), F.round(F.avg("l_discount"), 6).alias("avg_discount"))


@plan("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_linenumber, l_partkey, l_suppkey) = 1""")
def best_per_group(spark, d):
    order = [F.desc("l_extendedprice"), F.desc("l_quantity"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]
    return ranking.top_per_group(T(spark, d, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@plan("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem),
  f AS (SELECT l_orderkey, l_linestatus AS first_status FROM l WHERE r = 1),
  s AS (SELECT l.*, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l_returnflag, l_linestatus = first_status, l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS r2 FROM l JOIN f USING (l_orderkey) WHERE r > 1)
  SELECT l_orderkey, 1 AS pick, l_linenumber, l_partkey, l_extendedprice FROM l WHERE r = 1
  UNION ALL SELECT l_orderkey, 2, l_linenumber, l_partkey, l_extendedprice FROM s WHERE r2 = 1""")
def best_two_novel(spark, d):
    order = [F.asc("l_returnflag"), F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]
    out = ranking.novel_per_group(T(spark, d, "lineitem"), ["l_orderkey"], order, "l_linestatus", 2, rank="pick", novelty_at=1)
    return out.select("l_orderkey", "pick", "l_linenumber", "l_partkey", "l_extendedprice")


@plan("""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS k FROM lineitem),
  p AS (SELECT l_orderkey, 1 AS pick, k, l_returnflag, l_partkey, [k] AS took, [l_returnflag] AS used FROM l WHERE k = 1 UNION ALL
    SELECT * FROM (SELECT l.l_orderkey, p.pick + 1, l.k, l.l_returnflag, l.l_partkey, list_append(took, l.k), list_append(used, l.l_returnflag) FROM p JOIN l USING (l_orderkey) WHERE p.pick < 3 AND NOT list_contains(took, l.k)
    QUALIFY row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_quantity DESC, list_contains(used, l.l_returnflag), l.k) = 1))
  SELECT l_orderkey, pick::INT AS pick, l_returnflag, l_partkey FROM p""")
def three_per_group_novelty_last(spark, d):
    """Rank first, a value the group has not yet second: among rows of one rank new values go first."""
    order = [F.desc("l_quantity"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_linenumber"), F.asc("l_extendedprice")]
    out = ranking.novel_per_group(T(spark, d, "lineitem"), ["l_orderkey"], order, "l_returnflag", 3, rank="pick", novelty_at=1)
    return out.select("l_orderkey", "pick", "l_returnflag", "l_partkey")


@plan("""WITH h AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'F')
  SELECT r.o_custkey, o_orderkey FROM r LEFT JOIN h USING (o_custkey) WHERE k <= greatest(0, 4 - coalesce(n, 0))""")
def cap_less_existing(spark, d):
    o = T(spark, d, "orders")
    return ranking.cap_less_existing(o.where("o_orderstatus <> 'F'"), o.where("o_orderstatus = 'F'"), "o_custkey", 4, [F.asc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey")


@plan("""WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
  SELECT c_nationkey, c_custkey, rank::INT AS rank FROM r WHERE rank <= 5""")
def top_customers_per_nation(spark, d):
    return ranking.top_per_group(T(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 5).select("c_nationkey", "c_custkey", "rank")


@plan("""WITH r AS (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS round FROM customer)
  SELECT c_mktsegment, c_custkey, round::INT AS round FROM r ORDER BY round, c_mktsegment LIMIT 97""")
def balanced_round_robin(spark, d):
    return ranking.round_robin(T(spark, d, "customer"), "c_mktsegment", [F.asc("c_acctbal"), F.asc("c_custkey")], F.col("c_mktsegment"), 97).select("c_mktsegment", "c_custkey", "round")


@plan("""WITH h AS (SELECT o_orderkey, o_custkey, sha256('s1' || chr(0) || o_custkey || chr(0) || o_orderkey) AS own, sha256('s1' || chr(0) || o_custkey) AS task FROM orders)
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY own)::INT AS round, task AS task_hash FROM h""")
def spread_order(spark, d):
    own, task = ranking.spread_keys("s1", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    rows = T(spark, d, "orders").select("o_orderkey", "o_custkey", own.alias("own"), task.alias("task_hash"))
    return rows.withColumn("round", F.row_number().over(Window.partitionBy("o_custkey").orderBy("own"))).drop("own")


@plan("""WITH c AS (SELECT c_mktsegment, count(*) AS weight FROM customer GROUP BY 1),
  e AS (SELECT *, weight * 50 / sum(weight) OVER () AS x FROM c), f AS (SELECT *, floor(x) AS fl, 50 - sum(floor(x)) OVER () AS rest FROM e)
  SELECT c_mktsegment, weight, (fl + (row_number() OVER (ORDER BY round(x - fl, 9) DESC, c_mktsegment) <= rest)::INT)::BIGINT AS quota FROM f""")
def largest_remainder_quotas(spark, d):
    weights = T(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("weight"))
    return ranking.largest_remainder(weights, "c_mktsegment", "weight", 50)


@plan("""WITH RECURSIVE g AS (SELECT n_name AS name, n_nationkey + 1 AS weight, n_nationkey % 4 AS cap FROM nation), e AS (SELECT *, weight * 30 / sum(weight) OVER () AS x FROM g), f AS (SELECT *, least(cap, floor(x)) AS fl FROM e),
  o AS (SELECT *, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, name) AS i, greatest(0, 30 - sum(fl) OVER ()) AS rest FROM f), t AS (SELECT *, sum((fl < cap)::INT) OVER (ORDER BY i) AS turn FROM o)
  SELECT name, weight, cap, (fl + (fl < cap AND turn <= rest)::INT)::BIGINT AS quota FROM t""")
def capped_quotas(spark, d):
    """Seats that a full group cannot take go to the next fractions."""
    groups = T(spark, d, "nation").select(F.col("n_name").alias("name"), (F.col("n_nationkey") + 1).alias("weight"), (F.col("n_nationkey") % 4).alias("cap"))
    return ranking.largest_remainder(groups, "name", "weight", 30, "cap")


@plan("""WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
  SELECT p_partkey, i AS position, i // 4 AS block, (i % 4 + i // 4) % 3 AS cell, i % 5 AS model, i % 2 = 0 AS even_style FROM p""")
def block_rotation(spark, d):
    rows = ranking.numbered(T(spark, d, "part").select("p_partkey"), "p_partkey")
    b = ranking.in_blocks(F.col("position"), 4, 3)
    return rows.select("p_partkey", "position", b["block"].alias("block"), b["cell"].alias("cell"), F.pmod("position", F.lit(5)).alias("model"), (F.pmod("position", F.lit(2)) == 0).alias("even_style"))


@plan("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 67")
def token_budget_limit(spark, d):
    """1,000 tokens at 15 a row: the 67th row crosses the budget and counts."""
    return T(spark, d, "orders").orderBy("o_orderdate", "o_orderkey").limit(ranking.budget_rows(1000, 15)).select("o_orderkey", "o_totalprice")


@plan("""SELECT p_partkey, p_size, p_retailprice FROM part ORDER BY p_size, p_retailprice, p_brand, p_partkey LIMIT 40""")
def smallest_change_first(spark, d):
    return T(spark, d, "part").orderBy("p_size", "p_retailprice", "p_brand", "p_partkey").limit(40).select("p_partkey", "p_size", "p_retailprice")


@plan("""WITH t AS (SELECT o_orderkey, o_totalprice, 0 AS tier FROM orders WHERE o_totalprice > 480000 UNION ALL
  SELECT o_orderkey, o_totalprice, 1 FROM orders WHERE o_totalprice BETWEEN 470000 AND 480000)
  SELECT o_orderkey, tier FROM t ORDER BY tier, o_totalprice DESC, o_orderkey LIMIT 700""")
def strict_then_fallback(spark, d):
    o = T(spark, d, "orders")
    out = ranking.tiered_fill([o.where("o_totalprice > 480000"), o.where("o_totalprice between 470000 and 480000")], [F.desc("o_totalprice"), F.asc("o_orderkey")], 700)
    return out.select("o_orderkey", "tier")


@plan("""WITH e AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS position FROM part WHERE p_size BETWEEN 10 AND 30 AND p_retailprice < 1500)
  SELECT p_partkey, position - 5 AS place FROM e WHERE position >= 5""")
def offset_over_eligible(spark, d):
    rows = ranking.numbered(T(spark, d, "part").where("p_size between 10 and 30 and p_retailprice < 1500").select("p_partkey"), "p_partkey")
    return rows.where("position >= 5").select("p_partkey", (F.col("position") - 5).alias("place"))


@plan("""WITH t AS (SELECT s_suppkey, unnest(range(3)) AS rollout FROM supplier)
  SELECT s_suppkey, rollout::INT AS rollout, s_suppkey * 3 + rollout AS run_index FROM t WHERE NOT (s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) AND rollout = 1)""")
def rollout_replication(spark, d):
    rows = T(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("rollout"))
    done = T(spark, d, "supplier").where("s_acctbal < 0").select("s_suppkey", F.lit(1).alias("rollout"))
    return rows.join(done, ["s_suppkey", "rollout"], "left_anti").withColumn("run_index", F.col("s_suppkey") * 3 + F.col("rollout"))


@plan("""WITH p AS (SELECT *, o_orderstatus = 'F' AS ok FROM orders)
  SELECT 'o_orderpriority' AS "by", o_orderpriority AS value, count(*) AS total, sum(ok::INT)::BIGINT AS passes, round(sum(ok::INT) / count(*), 9) AS rate FROM p GROUP BY 2
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*), sum(ok::INT)::BIGINT, round(sum(ok::INT) / count(*), 9) FROM p GROUP BY 2""")
def grouping_set_rates(spark, d):
    out = stats.rate_sets(T(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], F.col("o_orderstatus") == "F")
    return out.withColumn("rate", F.round("rate", 9))


@plan("""SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def cube_counts(spark, d):
    return T(spark, d, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@plan("""SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_counts(spark, d):
    rows = T(spark, d, "customer").join(T(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(T(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"))


@plan("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) FILTER (o_orderstatus = 'X') AS "X" FROM orders GROUP BY 1""")
def zero_filled_matrix(spark, d):
    return stats.matrix(T(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P", "X"])


@plan("""SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, CASE WHEN n_orders IS NOT NULL THEN top_status ELSE c_mktsegment END AS c_mktsegment FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n_orders, max(o_orderstatus) AS top_status FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def override_join(spark, d):
    right = T(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderstatus").alias("c_mktsegment"))
    out = joins.override(T(spark, d, "customer").select("c_custkey", "c_mktsegment"), right, "c_custkey")
    return out.select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "c_mktsegment")


@plan("""WITH u AS (SELECT o_custkey, o_orderpriority AS p, NULL AS s, 0 AS k FROM orders WHERE o_orderstatus = 'O' UNION ALL
  SELECT o_custkey, NULL, o_orderstatus, 1 FROM orders WHERE o_orderstatus <> 'O')
  SELECT o_custkey, max(p) AS p, max(s) AS s FROM u GROUP BY 1""")
def merge_by_priority(spark, d):
    o = T(spark, d, "orders")
    a = o.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("p")).withColumn("s", F.lit(None).cast("string"))
    b = o.where("o_orderstatus <> 'O'").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("s")).withColumn("p", F.lit(None).cast("string"))
    return joins.merge_by_priority([a, b], "o_custkey", ["p", "s"])


RULES = "SELECT * FROM (VALUES (0, 'BUILDING', 'exact', 1), (0, NULL, 'region', 2), (1, NULL, 'region', 3), (2, 'MACHINERY', 'exact', 4), (2, 'MACHINERY', 'later', 5)) v(n_regionkey, c_mktsegment, rule, place)"


@plan(f"""WITH rules AS ({RULES}), c AS (SELECT c_custkey, n_regionkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey)
  SELECT c.c_custkey, c.n_regionkey, c.c_mktsegment, rule FROM c LEFT JOIN rules r ON c.n_regionkey = r.n_regionkey AND (r.c_mktsegment IS NULL OR r.c_mktsegment = c.c_mktsegment)
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (r.c_mktsegment IS NOT NULL) DESC, place) = 1""")
def fallback_key_join(spark, d):
    rules = spark.sql(RULES)
    c = T(spark, d, "customer").join(T(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey", "c_mktsegment")
    return joins.most_specific(c, rules, ["n_regionkey", "c_mktsegment"], F.col("place"), "c_custkey").select("c_custkey", "n_regionkey", "c_mktsegment", "rule")


@plan("""SELECT c_custkey, coalesce((SELECT max_by(o_orderpriority, o_orderkey) FROM orders WHERE o_custkey = c_custkey), '') AS o_orderpriority FROM customer""")
def completed_predictions(spark, d):
    found = T(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderkey")
    return joins.complete(T(spark, d, "customer").select("c_custkey"), found, "c_custkey", "o_orderpriority", "o_orderkey")


@plan("SELECT c_custkey, c_nationkey AS n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def required_lookup(spark, d):
    return joins.require(T(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), T(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")


@plan("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def excluded_twice(spark, d):
    o = T(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return joins.drop_listed(T(spark, d, "customer").select("c_custkey"), o.where("o_orderstatus = 'P'"), o.where("o_totalprice > 400000"), key="c_custkey")


@plan("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)")
def allowlisted(spark, d):
    o = T(spark, d, "orders").where("o_totalprice > 490000").withColumnRenamed("o_custkey", "c_custkey")
    return joins.keep_listed(T(spark, d, "customer").select("c_custkey", "c_name"), o, "c_custkey")


@plan("""SELECT count(*) AS n, coalesce(sum((s_suppkey IN (SELECT c_custkey FROM customer))::INT), 0)::BIGINT AS n_id, coalesce(sum((s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900))::INT), 0)::BIGINT AS n_nation FROM supplier""")
def overlap_counts(spark, d):
    s = T(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.lit(0.0).alias("bal"))
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 9900, F.col("c_nationkey")).alias("nation"), "c_acctbal")
    return joins.overlap(s, c, id=F.col("id"), nation=F.col("nation"))


@plan("""WITH o AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
  SELECT o_orderpriority, max(o_totalprice) FILTER (i = round_even((n - 1) * 0.5, 0)) AS p50_nearest, max(o_totalprice) FILTER (i = floor((n - 1) * 0.9)) AS p90_floor,
  round(quantile_cont(o_totalprice, 0.95), 4) AS p95_linear FROM o GROUP BY 1""")
def percentiles(spark, d):
    points = {"p50_nearest": ("nearest", 0.5), "p90_floor": ("floor", 0.9), "p95_linear": ("linear", 0.95)}
    return stats.percentiles(T(spark, d, "orders"), "o_totalprice", ["o_orderpriority"], points).withColumn("p95_linear", F.round("p95_linear", 4))


@plan("""WITH m AS (SELECT s_nationkey, count(*)::DOUBLE AS a, avg(s_acctbal) AS b FROM supplier GROUP BY 1),
  r AS (SELECT *, row_number() OVER (ORDER BY a) - 1 AS pa, row_number() OVER (ORDER BY b) - 1 AS pb FROM m), k AS (SELECT *, avg(pa) OVER (PARTITION BY a) AS ra, avg(pb) OVER (PARTITION BY b) AS rb FROM r)
  SELECT round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM k""")
def correlation_pair(spark, d):
    m = T(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).cast("double").alias("a"), F.avg("s_acctbal").alias("b"))
    return stats.correlations(m, "a", "b").select(F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


@plan("""SELECT round(sqrt(avg((l_discount - l_tax) * (l_discount - l_tax))), 8) AS rmse, round(avg(abs(l_discount - l_tax)), 8) AS mae, round(max(abs(l_discount - l_tax)), 8) AS max_abs FROM lineitem""")
def error_measures(spark, d):
    return stats.errors(T(spark, d, "lineitem"), "l_discount", "l_tax").select(*(F.round(c, 8).alias(c) for c in ("rmse", "mae", "max_abs")))


@plan("""WITH a AS (SELECT c_nationkey AS k, count(*) / sum(count(*)) OVER () AS x FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) / sum(count(*)) OVER () AS y FROM supplier GROUP BY 1)
  SELECT round(sum(abs(coalesce(x, 0) - coalesce(y, 0))), 9) AS l1 FROM a FULL JOIN b USING (k)""")
def share_distance(spark, d):
    out = stats.share_distance(T(spark, d, "customer").select(F.col("c_nationkey").alias("k")), T(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), "k")
    return out.select(F.round("l1", 9).alias("l1"))


@plan("""WITH t AS (SELECT l_partkey % 100 AS task, l_suppkey % 4 AS trial, l_returnflag = 'R' AS solved FROM lineitem)
  SELECT task, count(DISTINCT trial) AS n_trials, bool_or(solved) AS any_solved, bool_and(solved) AS all_solved, sum(solved::INT)::BIGINT AS times_solved FROM t GROUP BY 1""")
def trial_summary(spark, d):
    t = T(spark, d, "lineitem").select((F.col("l_partkey") % 100).alias("task"), (F.col("l_suppkey") % 4).alias("trial"), (F.col("l_returnflag") == "R").alias("solved"))
    return stats.trial_summary(t, "task", "trial", F.col("solved"))


@plan("""WITH r AS (SELECT l_suppkey % 4 AS trial, avg((l_returnflag = 'R')::INT) AS r FROM lineitem GROUP BY 1)
  SELECT round(avg(r), 9) AS mean, round(min(r), 9) AS least, round(max(r), 9) AS greatest, round(stddev_pop(r), 9) AS deviation FROM r""")
def score_summary(spark, d):
    t = T(spark, d, "lineitem").select((F.col("l_suppkey") % 4).alias("trial"), (F.col("l_returnflag") == "R").alias("solved"))
    return stats.score_summary(t, "trial", F.col("solved")).select(*(F.round(c, 9).alias(c) for c in ("mean", "least", "greatest", "deviation")))


@plan("""SELECT p_brand, count(*) AS n, min(p_partkey) AS first_seen FROM part GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 20""")
def top_twenty(spark, d):
    return T(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(20)


@plan("SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_values(spark, d):
    return dedup.duplicates(T(spark, d, "part"), "p_name")


@plan("""SELECT p_name, p_partkey, p_size FROM part WHERE p_size > 20 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1""")
def filter_then_dedup(spark, d):
    return dedup.first_wins(T(spark, d, "part"), ["p_name"], [F.asc("p_partkey")], F.col("p_size") > 20).select("p_name", "p_partkey", "p_size")


@plan("""SELECT * FROM (SELECT p_name, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1) WHERE p_size > 20""")
def dedup_then_filter(spark, d):
    return dedup.first_wins(T(spark, d, "part"), ["p_name"], [F.asc("p_partkey")], F.col("p_size") > 20, filter_first=False).select("p_name", "p_partkey", "p_size")


@plan("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey - 1 FROM orders WHERE o_totalprice > 450000)""")
def retired_sources(spark, d):
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("uuid"), "o_totalprice")
    chosen = o.where("o_totalprice > 450000").select((F.col("uuid") - 1).alias("source_uuid"))
    return dedup.retire(o, chosen).select(F.col("uuid").alias("o_orderkey"))


@plan("""(SELECT c_nationkey AS k, 'both' AS part FROM customer INTERSECT SELECT s_nationkey, 'both' FROM supplier)
  UNION ALL (SELECT c_nationkey, 'only_customers' FROM customer EXCEPT SELECT s_nationkey, 'only_customers' FROM supplier)
  UNION ALL (SELECT k, 'any' FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier))""")
def id_sets(spark, d):
    a, b = T(spark, d, "customer").select(F.col("c_nationkey").alias("k")), T(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    sets = {"both": a.intersect(b), "only_customers": a.subtract(b), "any": a.union(b).distinct()}
    out = None
    for name, s in sets.items():
        s = s.withColumn("part", F.lit(name))
        out = s if out is None else out.union(s)
    return out


@plan("""WITH g AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 1000 THEN 'small' WHEN o_orderpriority = '5-LOW' THEN 'low' END AS r FROM orders)
  SELECT coalesce(r, 'kept') AS decision, count(*) AS n FROM g GROUP BY 1""")
def gate_decisions(spark, d):
    reason = gates.first_reason(pending=F.col("o_orderstatus") == "P", small=F.col("o_totalprice") < 1000, low=F.col("o_orderpriority") == "5-LOW")
    return gates.decisions(T(spark, d, "orders"), reason)


@plan("""WITH r AS (SELECT unnest(list_filter([CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_totalprice > 400000 THEN 'large' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'low' END], lambda x: x IS NOT NULL)) AS item FROM orders)
  SELECT item, count(*) AS n FROM r GROUP BY 1""")
def reason_counts(spark, d):
    r = gates.reasons(pending=F.col("o_orderstatus") == "P", large=F.col("o_totalprice") > 400000, low=F.col("o_orderpriority") == "5-LOW")
    return stats.exploded_counter(T(spark, d, "orders"), r)


@plan("""WITH r AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '' WHEN o_orderpriority = '1-URGENT' THEN 'missing_submit_command' WHEN o_orderpriority = '2-HIGH' THEN 'patch_artifact_assembly' WHEN o_orderpriority = '5-LOW' THEN 'weak_patch_check_before_submit' ELSE 'verifier_reward_not_1' END AS found FROM orders)
  SELECT o_orderkey, CASE WHEN found = '' THEN 'resolved' WHEN o_totalprice > 400000 AND o_custkey % 2 = 0 THEN 'harness_error' WHEN o_custkey % 11 = 0 THEN 'patch_apply_failed' WHEN found = 'missing_submit_command' THEN 'missing_submit' WHEN o_orderkey % 10 = 0 THEN 'empty_patch'
    WHEN found = 'patch_artifact_assembly' THEN 'malformed_or_manual_patch' WHEN found = 'verifier_reward_not_1' THEN 'unresolved' ELSE found END AS outcome FROM r""")
def outcome_categories(spark, d):
    """An order's fields stand in for its audit's reasons and its result."""
    found = F.when(F.col("o_orderpriority") == "1-URGENT", "missing_submit_command").when(F.col("o_orderpriority") == "2-HIGH", "patch_artifact_assembly").when(F.col("o_orderpriority") == "5-LOW", "weak_patch_check_before_submit").otherwise("verifier_reward_not_1")
    found = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")).otherwise(F.array(found))
    result = F.when(F.col("o_custkey") % 11 == 0, '{"error": "git apply did fail"}').otherwise("{}")
    c = gates.outcome_category(found, F.col("o_orderkey") % 10, F.lit(1), result, F.col("o_custkey") % 2, F.col("o_totalprice") > 400000)
    return T(spark, d, "orders").select("o_orderkey", c.alias("outcome"))


@plan("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, coalesce(l_returnflag = 'A' AND l_tax > 0 AND l_quantity BETWEEN 1 AND 30 AND l_discount >= 0.03, false) AS ok FROM lineitem""")
def hard_pass_gate(spark, d):
    one = F.lit(1)
    ok = gates.hard_pass(F.col("l_returnflag") == "A", F.col("l_tax"), F.lit("Submitted"), F.col("l_quantity"), F.col("l_discount"), one, one, one, most_patch=30, least_reasoning=0.03)
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", ok.alias("ok"))


@plan("""SELECT o_orderkey, year(o_orderdate)::INT AS year_bucket, CASE WHEN o_totalprice < 100000 THEN 'easy' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'hard' END AS difficulty FROM orders""")
def bins(spark, d):
    level = F.when(F.col("o_totalprice") < 100000, "easy").when(F.col("o_totalprice") < 300000, "medium").otherwise("hard")
    return T(spark, d, "orders").select("o_orderkey", F.substring(F.col("o_orderdate").cast("string"), 1, 4).cast("int").alias("year_bucket"), level.alias("difficulty"))


@plan("""SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_tasks, sum((o_orderstatus = 'F')::INT)::BIGINT AS n_passed, 'orders' AS source FROM orders""")
def manifest_row(spark, d):
    from millrace.sources.writers import manifest

    return manifest(T(spark, d, "orders"), {"n_rows": F.count(F.lit(1)), "n_tasks": F.countDistinct("o_custkey"), "n_passed": F.sum((F.col("o_orderstatus") == "F").cast("long"))}, source="orders")


@plan("""WITH p AS (SELECT o_custkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 8 AS shard FROM orders), q AS (SELECT shard, o_custkey, count(*) AS n FROM p GROUP BY ALL)
  SELECT shard::INT AS shard, sum(n)::BIGINT AS n_rows, count(*) AS n_tasks, max(n) AS most_per_task FROM q GROUP BY 1""")
def round_robin_shards(spark, d):
    from millrace.sources.writers import shard_stats, with_shard

    return shard_stats(with_shard(T(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 8), "o_custkey")


@plan("SELECT s_suppkey, (ntile(7) OVER (ORDER BY s_suppkey) - 1)::INT AS shard FROM supplier")
def contiguous_shards(spark, d):
    from millrace.sources.writers import contiguous

    return contiguous(T(spark, d, "supplier").select("s_suppkey"), "s_suppkey", 7).select("s_suppkey", "shard")


@plan("""SELECT s_suppkey, s_name, 'parent' AS origin FROM supplier UNION ALL
  SELECT * FROM (SELECT c_custkey, c_name, 'new' FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) = 1)""")
def append_only(spark, d):
    from millrace.sources.writers import append_only as append

    parent = T(spark, d, "supplier").select("s_suppkey", "s_name", F.lit("parent").alias("origin"))
    new = T(spark, d, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"), F.lit("new").alias("origin"), "c_nationkey")
    return append(parent, new, ["c_nationkey"], [F.asc("s_suppkey")]).drop("c_nationkey")


@plan("""SELECT 'part-' || lpad((max(p_partkey) + 1)::VARCHAR, 5, '0') || '.jsonl' AS name FROM part""")
def next_shard_name(spark, d):
    from millrace.sources.writers import next_name

    return next_name(T(spark, d, "part").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string"), F.lit(".jsonl")).alias("f")), "f", "part", "jsonl")


@plan("""WITH RECURSIVE c AS (SELECT l_orderkey::VARCHAR AS task_id, l_orderkey || '-' || l_partkey AS uuid, round(max(l_extendedprice), 0) AS score, list(DISTINCT l_suppkey) AS lineage FROM lineitem GROUP BY l_orderkey, l_partkey),
  r AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY score DESC, uuid) AS k, max(score) OVER (PARTITION BY task_id) AS top FROM c),
  o AS (SELECT *, row_number() OVER (ORDER BY k, top DESC, task_id) AS i FROM r WHERE k <= 2),
  f AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS used, false AS ok UNION ALL
    SELECT o.i, CASE WHEN list_has_any(f.used, o.lineage) THEN f.used ELSE list_concat(f.used, o.lineage) END, NOT list_has_any(f.used, o.lineage) FROM f JOIN o ON o.i = f.i + 1)
  SELECT task_id, uuid, score FROM f JOIN o USING (i) WHERE ok""")
def lineage_capped_selection(spark, d):
    """Lines as candidates, orders as tasks, suppliers as lineage."""
    c = T(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.round(F.max("l_extendedprice"), 0).alias("score"), F.array_sort(F.collect_set(F.col("l_suppkey"))).alias("lineage"))
    c = c.select(F.col("l_orderkey").cast("string").alias("task_id"), F.concat_ws("-", "l_orderkey", "l_partkey").alias("uuid"), "score", "lineage")
    return dedup.capped_selection(c, "task_id", "score", "uuid", "lineage", 2, 0).select("task_id", "uuid", "score")


@plan("""WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM (SELECT o_orderkey, 'c' || (o_custkey % 200) AS c, 'd' || (dayofyear(o_orderdate)) AS d FROM orders)),
  f AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS used, false AS ok UNION ALL
    SELECT o.i, CASE WHEN list_has_any(f.used, [o.c, o.d]) THEN f.used ELSE list_concat(f.used, [o.c, o.d]) END, NOT list_has_any(f.used, [o.c, o.d]) FROM f JOIN o ON o.i = f.i + 1)
  SELECT o_orderkey, c, d FROM f JOIN o USING (i) WHERE ok""")
def disjunctive_dedup(spark, d):
    """Rows that share either of two keys with an earlier kept row go."""
    o = T(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey") % 200).alias("c"), F.concat(F.lit("d"), F.dayofyear("o_orderdate")).alias("d"))
    return dedup.conflict_free(o.withColumn("keys", F.array("c", "d")), "o_orderkey", "keys").select("o_orderkey", "c", "d")


OUTCOMES = """WITH t AS (SELECT p_partkey FROM part), l AS (SELECT l_partkey AS p_partkey, l_returnflag AS run, max(l_quantity) > 40 AS solved FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY ALL),
  v AS (SELECT r.run, t.p_partkey, l.solved IS NOT NULL AS has, CASE WHEN l.solved THEN 1.0 WHEN l.solved IS NOT NULL OR r.run <> 'N' THEN 0.0 END::DOUBLE AS solved
    FROM t CROSS JOIN (VALUES ('A'), ('R'), ('N')) r(run) LEFT JOIN l ON l.run = r.run AND l.p_partkey = t.p_partkey) """


def _outcomes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as tasks and return flags as runs; N is a run that did not try every task."""
    runs = T(spark, d, "lineitem").where("l_orderkey % 3 = 0").groupBy(F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("run")).agg((F.max("l_quantity") > 40).alias("solved"))
    return runs, stats.outcome_vectors(T(spark, d, "part"), runs, "p_partkey", "run", "solved", ["A", "R"], ["N"])


@plan(OUTCOMES + "SELECT run, p_partkey, solved FROM v")
def outcome_vectors(spark, d):
    return _outcomes(spark, d)[1]


@plan(OUTCOMES + "SELECT run, count(*) FILTER (has) AS coverage, avg(solved) AS score FROM v GROUP BY run")
def run_coverage(spark, d):
    runs, vectors = _outcomes(spark, d)
    return stats.run_coverage(vectors, runs, "p_partkey", "run", "solved")
