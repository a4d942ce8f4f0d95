"""Queries of curation steps: quality gates by name, scores, resumable sets, splits, endpoints."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import coerce, submissions
from millrace.operators import gates, ranking
from millrace.plans.registering import Plans
from millrace.session import table as T

plan = Plans()
QUERIES, ORACLES = plan.queries, plan.oracles


@plan("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, concat_ws(',', CASE WHEN l_returnflag <> 'A' THEN 'not_passed' END, CASE WHEN NOT l_tax > 0 THEN 'reward_not_positive' END, CASE WHEN l_linestatus <> 'F' THEN 'not_submitted' END,
  CASE WHEN NOT l_quantity > 10 THEN 'empty_patch' END, CASE WHEN NOT l_discount >= 0.05 THEN 'reasoning_under_90pct' END, CASE WHEN l_partkey % 7 = 0 THEN 'api_calls_not_positive' END, CASE WHEN l_suppkey % 5 = 0 THEN 'missing_assistant_messages' END) AS reasons,
  CASE WHEN l_returnflag <> 'A' OR NOT l_tax > 0 THEN 'not_passed' WHEN l_linestatus <> 'F' THEN 'not_submitted' WHEN NOT l_quantity > 10 THEN 'empty_patch' WHEN l_discount < 0.05 AND l_linenumber <> 1 THEN 'low_reasoning_coverage'
    WHEN l_partkey % 7 = 0 THEN 'api_calls_zero' END AS dropped, l_returnflag = 'A' AND l_tax > 0 AND l_linestatus = 'F' AND l_quantity > 10 AND l_partkey % 7 <> 0 AND l_discount >= 0.05 AS success FROM lineitem""")
def strict_quality_reasons(spark, d):
    """All reasons, the first in the dropping gate's order, and the strict success predicate, over one row's facts."""
    li = T(spark, d, "lineitem")
    facts = {"passed": F.col("l_returnflag") == "A", "reward": F.col("l_tax"), "status": F.when(F.col("l_linestatus") == "F", "Submitted").otherwise("LimitsExceeded"), "patch_bytes": F.col("l_quantity") - 10, "reasoning": F.col("l_discount"), "calls": F.col("l_partkey") % 7}
    r = gates.strict_quality(**facts, assistants=F.col("l_suppkey") % 5, least_reasoning=0.05)
    dropped = gates.strict_drop_reason(**facts, has_all=F.col("l_linenumber") == 1, least_reasoning=0.05)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.array_join(r, ",").alias("reasons"), dropped.alias("dropped"), gates.strict_success(**facts, least_reasoning=0.05).alias("success"))


@plan("""SELECT l_returnflag, count(*) FILTER (l_returnflag = 'A' AND l_tax > 0 AND l_quantity BETWEEN 1 AND 20 AND l_linestatus = 'F') AS n_compact,
  count(*) FILTER (l_returnflag <> 'A' AND l_quantity BETWEEN 1 AND 20 AND l_linestatus = 'F' AND l_discount >= 0.05 AND (l_suppkey % 3 = 0 OR l_partkey % 5 = 0)) AS n_nonpassing FROM lineitem GROUP BY 1""")
def pass_gates(spark, d):
    p, q, done = F.col("l_returnflag") == "A", F.col("l_quantity"), F.col("l_linestatus") == "F"
    a = gates.compact_pass(p, F.col("l_tax"), q, F.lit(False), done, most_patch=20)
    b = gates.nonpassing_quality(p, q, done, F.col("l_discount"), F.col("l_suppkey") % 3 == 0, F.col("l_partkey") % 5 == 0, most_patch=20, least_reasoning=0.05)
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(a.cast("long")).alias("n_compact"), F.sum(b.cast("long")).alias("n_nonpassing"))


@plan("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN NOT (CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN o_totalprice > 100000 OR o_orderpriority <> '5-LOW' WHEN o_orderkey % 2 = 0 THEN o_totalprice > 100000 WHEN o_orderkey % 3 = 0 THEN o_orderpriority <> '5-LOW' ELSE true END) THEN NULL
  WHEN o_orderpriority = '1-URGENT' THEN 'row_source=strict' WHEN o_orderkey % 3 = 0 AND o_orderpriority <> '5-LOW' THEN 'accepted=true' ELSE 'reward_1_passed' END AS source FROM orders""")
def pass_sources(spark, d):
    """Of the flags that are there any true one is enough."""
    a = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") > 100000)
    b = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority") != "5-LOW")
    row_source = F.when(F.col("o_orderpriority") == "1-URGENT", "Strict-run").otherwise("plain")
    return T(spark, d, "orders").select("o_orderkey", gates.pass_source((F.col("o_orderstatus") == "F").cast("int"), [a, b], [("row_source", row_source)], [("accepted", b)]).alias("source"))


@plan("""SELECT p_partkey, p_size <= 30 AND p_brand <> 'Brand#11' AND p_retailprice >= 1000 AND p_partkey % 4 <> 0 AND p_partkey % 9 <> 0 AS high_quality, p_partkey % 3 = 1 AND p_size <= 20 AND p_partkey % 5 <> 0 AND p_partkey % 6 <= 2 AS easy_small,
  CASE WHEN p_partkey % 8 = 0 THEN 'skipped_excluded_uuid' WHEN p_partkey % 3 = 2 THEN 'skipped_language_filter' WHEN p_size > 40 THEN 'skipped_huge_patch' END AS skipped FROM part""")
def task_gates(spark, d):
    """Parts as tasks: their numbers stand in for languages, levels, issues and confidence."""
    p, k = T(spark, d, "part"), F.col("p_partkey")
    language = F.when(k % 3 == 0, "go").when(k % 3 == 1, "python").otherwise("rust")
    level = F.when(F.col("p_size") <= 20, "easy").when(F.col("p_size") <= 30, "hard").otherwise("unknown")
    issues = F.create_map(F.lit("a"), k % 9 == 0, F.lit("b"), F.lit(False))
    good = gates.high_quality_task(language, level, F.when(F.col("p_brand") != "Brand#11", "A").otherwise("B"), F.lit("complete"), k % 4 == 0, issues, F.col("p_retailprice") / 1000, least=1.0)
    easy = gates.easy_small_diff(language, level, k % 6, F.col("p_size"), F.when(k % 5 == 0, 1), ("python",))
    skipped = gates.quality_filter(excluded_uuid=k % 8 == 0, language_filter=k % 3 == 2, huge_patch=F.col("p_size") > 40)
    return p.select("p_partkey", good.alias("high_quality"), easy.alias("easy_small"), skipped.alias("skipped"))


@plan("""WITH c AS (SELECT o_orderkey, least(o_totalprice / 500000, 1) AS share, o_orderkey % 130 AS calls, o_custkey * 20 AS size, o_orderstatus = 'F' AS verified, o_orderpriority = '5-LOW' AS missing, o_orderkey % 2 = 0 AS strict FROM orders)
  SELECT o_orderkey, round(CASE WHEN strict THEN 35.0 ELSE 20.0 END + 10 * share + least(calls, CASE WHEN strict THEN 80 ELSE 120 END) / 20.0 + CASE WHEN share >= 0.99 THEN 1 ELSE 0 END + CASE WHEN calls BETWEEN 4 AND 120 THEN 1 ELSE 0 END
    + CASE WHEN size BETWEEN 200 AND 20000 THEN 2 WHEN size < 200 THEN -1 ELSE 0 END + CASE WHEN verified THEN CASE WHEN strict THEN 14 ELSE 12 END ELSE 0 END - CASE WHEN missing THEN 3 ELSE 0 END, 9)::DOUBLE AS score,
  concat_ws(',', CASE WHEN strict THEN 'strict_passed_remaining' ELSE 'high_quality_nonpassing' END, CASE WHEN share >= 0.99 THEN 'near_full_reasoning' END, CASE WHEN calls BETWEEN 4 AND 120 THEN 'healthy_api_calls' END, CASE WHEN size BETWEEN 200 AND 20000 THEN 'normal_patch' WHEN size < 200 THEN 'small_patch' END,
    CASE WHEN verified THEN 'natural_patch_verification' END, CASE WHEN verified THEN 'submit_cats_patch' END, CASE WHEN missing THEN 'missing_nonempty_patch_verification' END) AS notes FROM c""")
def candidate_rule_scores(spark, d):
    """The two rule tables for candidates, passed ones and others, over orders as candidates."""
    k, share = F.col("o_orderkey"), F.least(F.col("o_totalprice") / 500000, F.lit(1.0))
    signals = {"natural_patch_verification": F.col("o_orderstatus") == "F", "natural_submit_command_cats_patch": F.col("o_orderstatus") == "F", "missing_nonempty_patch_verification": F.col("o_orderpriority") == "5-LOW"}
    a = gates.candidate_score(share, k % 130, F.col("o_custkey") * 20, signals, F.lit("strict_passed_remaining"))
    b = gates.candidate_score(share, k % 130, F.col("o_custkey") * 20, signals)
    pick = lambda n: F.when(k % 2 == 0, a[n]).otherwise(b[n])
    return T(spark, d, "orders").select("o_orderkey", F.round(pick("score"), 9).alias("score"), F.array_join(pick("notes"), ",").alias("notes"))


#: Submissions and what an audit says of them: (patch, language, commands, reward, submission reasons, audit reasons, category).
GOOD = "diff --git a/src/m.go b/src/m.go\n--- a/src/m.go\n+++ b/src/m.go\n@@ -1 +1 @@\n-a\n+b\n"
END = "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT && cat patch.txt"
AUDITED = (
    (GOOD, "go", ("git diff > patch.txt", "cat patch.txt", END), 1, "", "", "resolved"),
    (GOOD, "python", ("git diff > patch.txt", "head -5 patch.txt", END), 1, "bad_changed_paths", "weak_patch_check_before_submit", "weak_patch_check_before_submit"),
    ("", "go", ("ls",), 0, "empty_submission,missing_diff_header,bad_changed_paths", "verifier_reward_not_1,patch_missing_real_unified_diff_headers,patch_changed_files_empty,missing_submit_command", "missing_submit"),
    ("", "go", (END,), 0, "empty_submission,missing_diff_header,bad_changed_paths", "verifier_reward_not_1,patch_missing_real_unified_diff_headers,patch_changed_files_empty", "empty_patch"),
    (GOOD.replace("src/m.go", "tests/m.go"), "go", ("git diff > patch.txt", END), 1, "bad_changed_paths", "patch_touches_forbidden_paths", "forbidden_path_patch"),
    (GOOD, "go", ("cat > patch.txt <<'E'\nx\nE", END), 1, "", "manual_patch_construction,patch_artifact_assembly", "malformed_or_manual_patch"),
    (GOOD, "go", ("cp other.diff patch.txt", END), 1, "", "patch_artifact_assembly", "malformed_or_manual_patch"),
    (GOOD, "go", ("git diff -- src > patch.txt", "grep x patch.txt", "cat patch.txt", END), 0, "", "verifier_reward_not_1", "unresolved"),
    (GOOD + "# ... existing code ...\n", "", ("git diff > patch.txt", END), 1, "forbidden_snippet:# ... existing code ...,forbidden_snippet:... existing code", "", "resolved"),
    ("diff --git a/patch.txt b/patch.txt\n--- a/patch.txt\n+++ b/patch.txt\n", "go", ("git diff > patch.txt", END), 1, "bad_changed_paths,patch_txt_diff", "patch_touches_forbidden_paths", "forbidden_path_patch"),
)


@plan("SELECT event_id, a.reasons, a.audit, a.category FROM events JOIN (VALUES " + ", ".join(f"({i}, '{x[4]}', '{x[5]}', '{x[6]}')" for i, x in enumerate(AUDITED)) + f") a(k, reasons, audit, category) ON event_id % {len(AUDITED)} = k")
def audited_submissions(spark, d):
    """Events take the cases in turn; what is expected of each is written out."""
    cases = F.array(*(F.struct(F.lit(p).alias("patch"), F.lit(lang).alias("language"), F.array(*map(F.lit, c)).alias("commands"), F.lit(r).alias("reward")) for p, lang, c, r, *_ in AUDITED))
    rows = T(spark, d, "events").select("event_id", F.element_at(cases, (F.col("event_id") % len(AUDITED) + 1).cast("int")).alias("c")).select("event_id", "c.*")
    rows = rows.select("event_id", "patch", F.array_join(submissions.submission_reasons(F.col("patch"), F.col("language")), ",").alias("reasons"), submissions.audit_reasons(F.col("reward"), F.col("patch"), F.col("commands")).alias("audit"))
    category = gates.outcome_category(F.col("audit"), F.octet_length("patch"), F.size(F.regexp_extract_all("patch", F.lit("(?m)^diff --git "), 0)))
    return rows.select("event_id", "reasons", F.array_join("audit", ",").alias("audit"), category.alias("category"))


#: Prompts, the category of the first command after each, and the flags expected.
TASK = "Fix the parser in module lexer.py so that nested quotes are handled, and make sure the failing case in the report is resolved without touching anything else in the code base, please. Keep the public names."
PROMPTS = (
    (TASK, "inspect", ""),
    (TASK + " Continue from here.", "inspect", "continuation_marker"),
    (TASK + " Add unit tests for it.", "edit", "requests_test_edits"),
    (TASK + " Add unit tests for it. Only non-test files count.", "edit", ""),
    ("  ", "submit", "empty_prompt"),
    ("Explain.", "submit", "too_short_for_stateful_compaction,missing_clear_task_intent,insufficient_state_for_non_inspect_start,starts_with_submit"),
    (TASK + " The repository is located at /home/x.", "diff_status", "path_contradiction,starts_with_diff_status"),
    (TASK + " See the retained suffix.", "test", "process_marker"),
    (TASK * 50, "inspect", "very_long_prompt"),
    (TASK + " The lexer was updated.", "inspect", "continuation_marker"),
)


@plan("SELECT event_id, a.flags FROM events JOIN (VALUES " + ", ".join(f"({i}, '{x[2]}')" for i, x in enumerate(PROMPTS)) + f") a(k, flags) ON event_id % {len(PROMPTS)} = k")
def prompt_flag_sets(spark, d):
    cases = F.array(*(F.struct(F.lit(p).alias("prompt"), F.lit(c).alias("first")) for p, c, _ in PROMPTS))
    rows = T(spark, d, "events").select("event_id", F.element_at(cases, (F.col("event_id") % len(PROMPTS) + 1).cast("int")).alias("c"))
    return rows.select("event_id", F.array_join(submissions.prompt_flags(F.col("c.prompt"), F.col("c.first")), ",").alias("flags"))


@plan("""SELECT l_orderkey, l_linenumber % 3 AS sample, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'R' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 3 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def resume_set(spark, d):
    """Per question and sample the last record that went well: a later failure does not undo it."""
    order = [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_extendedprice")]
    rows = T(spark, d, "lineitem").where("l_returnflag <> 'R'").withColumn("sample", F.col("l_linenumber") % 3)
    return ranking.top_per_group(rows, ["l_orderkey", "sample"], order).select("l_orderkey", "sample", "l_partkey", "l_suppkey")


@plan("""WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS k FROM customer) SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND k <= 12 THEN 'pilot' ELSE 'main' END AS wave FROM r""")
def pilot_then_main(spark, d):
    k = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey"))
    return T(spark, d, "customer").withColumn("k", k).select("c_custkey", F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("k") <= 12), "pilot").otherwise("main").alias("wave"))


@plan("""WITH k AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier WHERE s_acctbal > 0) SELECT s_suppkey, i % 3 AS endpoint FROM k""")
def endpoint_by_kept_row(spark, d):
    kept = ranking.numbered(T(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey"), "s_suppkey")
    return kept.select("s_suppkey", F.pmod("position", F.lit(3)).alias("endpoint"))


@plan("""WITH k AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand WHEN p_retailprice > 1200 THEN p_type ELSE p_name END AS key FROM part) SELECT key, min(p_partkey) AS p_partkey FROM k GROUP BY 1""")
def first_key_of_several(spark, d):
    key = coerce.first_present(F.when(F.col("p_size") > 25, F.col("p_brand")), F.when(F.col("p_retailprice") > 1200, F.col("p_type")), F.col("p_name"))
    return T(spark, d, "part").groupBy(key.alias("key")).agg(F.min("p_partkey").alias("p_partkey"))


@plan("""WITH u AS (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT l_linestatus, count(*) FROM lineitem GROUP BY 1) SELECT k, sum(n)::BIGINT AS n FROM u GROUP BY 1""")
def merged_counters(spark, d):
    """Counters of several summaries added up."""
    a = T(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = T(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b).groupBy("k").agg(F.sum("n").alias("n"))


@plan("""SELECT doc_id, sha256(CASE WHEN length(text) <= 600 THEN text ELSE left(text, 200) || chr(10) || '[...]' || chr(10) || right(text, 393) END) AS digest FROM documents WHERE text IS NOT NULL""")
def fitted_requests(spark, d):
    from millrace.operators.stateful import fitted_request

    return fitted_request(T(spark, d, "documents").where("text is not null").select("doc_id", "text"), "text", 600, 200).select("doc_id", F.sha2("text", 256).alias("digest"))


@plan("""SELECT event_id, CASE lower(trim(event_type)) WHEN 'view' THEN 'read' WHEN 'click' THEN 'read' WHEN 'purchase' THEN 'write' ELSE 'unknown' END AS alias FROM events""")
def aliases(spark, d):
    names = F.create_map(*(F.lit(x) for x in ("view", "read", "click", "read", "purchase", "write")))
    return T(spark, d, "events").select("event_id", F.coalesce(F.element_at(names, F.lower(F.trim("event_type"))), F.lit("unknown")).alias("alias"))


@plan("""WITH l AS (SELECT l_orderkey, list(DISTINCT l_partkey ORDER BY l_partkey) AS fail, list(DISTINCT l_suppkey ORDER BY l_suppkey) AS pass FROM lineitem GROUP BY 1)
  SELECT l_orderkey, array_to_string(list_concat(fail, pass[1:5]), ' ') AS selectors FROM l""")
def test_selectors(spark, d):
    """All of one list and the first five of another."""
    ids = lambda c: F.array_sort(F.collect_set(c))
    g = T(spark, d, "lineitem").groupBy("l_orderkey").agg(ids("l_partkey").alias("fail"), ids("l_suppkey").alias("pass"))
    both = F.concat("fail", F.slice("pass", 1, 5))
    return g.select("l_orderkey", F.array_join(F.transform(both, lambda x: x.cast("string")), " ").alias("selectors"))
