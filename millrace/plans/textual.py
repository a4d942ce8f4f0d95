"""Queries for text, command, diff and index functions over documents, pages, part and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import coerce, commands, diffs, submissions, texts
from millrace.operators import dedup, gates, ranking, stats
from millrace.plans.registering import Plans
from millrace.session import table as T
from millrace.streaming import events as E

plan = Plans()
QUERIES, ORACLES = plan.queries, plan.oracles

#: Commands that events take in turn, and the classes expected of them: of the turn, the step, the audit's step, and
#: whether they write a patch file by hand.
EXPECTED = (
    ("pytest -q tests/test_a.py", "test", "test", "test", False),
    ("git diff > patch.txt", "submit", "edit", "diff_status", False),
    ("cat src/a.py", "read", "inspect", "inspect", False),
    ("sed -i 's/a/b/' src/a.py", "write", "edit", "edit", False),
    ("echo done > patch.txt", "manual_patch_artifact", "edit", "other", True),
    ("python3 - <<'EOF'", "write", "probe", "edit", False),
    ("git status", "verify", "diff_status", "diff_status", False),
    ("submit", "submit", "other", "other", False),
    ("python -c 'print(1)'", "other", "probe", "edit", False),
    ("python3 -c 'open(1).write_text(2)'", "other", "edit", "edit", False),
    ("grep -rn foo src | head", "read", "inspect", "inspect", False),
    ("pip install numpy", "other", "setup", "setup", False),
    ("tail -5 patch.txt", "verify", "edit", "inspect", False),
    ("cargo test --all", "test", "test", "test", False),
    ("apply_patch < fix", "write", "edit", "edit", False),
    ("make check", "test", "other", "other", False),
    ("", "other", "no_command", "no_command", False),
    ("rm -rf build", "write", "other", "other", False),
    ("echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT", "other", "submit", "submit", False),
    ("cat > a.py", "read", "edit", "edit", False),
    ("printf 'x' > b.txt", "other", "edit", "edit", False),
    ("git diff | tee patch.txt", "submit", "edit", "edit", False),
    ("git diff | tee -a patch.txt", "verify", "edit", "edit", False),
    ("whoami", "other", "other", "other", False),
    ("cargogo test", "other", "other", "other", False),
    ("ls 2> /dev/null", "write", "inspect", "inspect", False),
    ("cat a.diff >> patch.txt", "manual_patch_artifact", "edit", "inspect", True),
    ("patch -p1 < x.diff", "other", "edit", "other", False),
    ("node - <<X", "write", "probe", "other", False),
    ("go mod tidy", "other", "setup", "setup", False),
    ("sed -n '1,5p' a.c", "read", "inspect", "inspect", False),
)
COMMANDS = tuple(x[0] for x in EXPECTED)
EXPECTED_SQL = ", ".join("(" + ", ".join([str(i), *("'" + x.replace("'", "''") + "'" for x in row[1:4]), str(row[4]).lower()]) + ")" for i, row in enumerate(EXPECTED))


@plan(f"""SELECT event_id, e.turn, e.step, e.audit, e.by_hand FROM events JOIN (VALUES {EXPECTED_SQL}) e(k, turn, step, audit, by_hand) ON event_id % {len(COMMANDS)} = k""")
def command_classes(spark: SparkSession, d: str) -> DataFrame:
    cmd = F.element_at(F.array(*map(F.lit, COMMANDS)), (F.col("event_id") % len(COMMANDS) + 1).cast("int"))
    rows = T(spark, d, "events").select("event_id", cmd.alias("cmd"))
    return rows.select("event_id", commands.turn_action(F.col("cmd")).alias("turn"), commands.step_category(F.col("cmd")).alias("step"), commands.step_category(F.col("cmd"), audit=True).alias("audit"), commands.writes_patch_by_hand(F.col("cmd")).alias("by_hand"))


@plan("""SELECT event_type, count(*) AS n, sum((props->>'k')::BIGINT)::BIGINT AS total_k, max((props->>'k')::BIGINT) AS most_k, count(*) FILTER ((props->>'missing') IS NULL) AS n_missing FROM events GROUP BY 1""")
def usage_sums(spark, d):
    """Numbers inside JSON text summed per type."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return T(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total_k"), F.max(k).alias("most_k"), F.sum(F.get_json_object("props", "$.missing").isNull().cast("long")).alias("n_missing"))


@plan("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_windows(spark, d):
    return E.tumbling(T(spark, d, "events")).withColumn("total", F.round("total", 4))


@plan("""WITH w AS (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events) SELECT start, count(*) AS n FROM w GROUP BY 1""")
def sliding_windows(spark, d):
    return E.sliding(T(spark, d, "events"))


@plan("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
  SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, d):
    return E.sessions(T(spark, d, "events"))


@plan("""SELECT doc_id FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1""")
def exact_text_dedup(spark, d):
    docs = T(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedup.first_wins(docs, ["digest"], [F.asc("doc_id")]).select("doc_id")


@plan(f"""SELECT page_id, length(html) - length(replace(html, '`', '')) AS n_ticks, len(regexp_extract_all(html, '{texts.URL}')) AS n_urls, len(regexp_extract_all(html, '<a href')) AS n_links,
  len(regexp_extract_all(html, '{texts.FENCE}')) // 2 AS n_fences, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages""")
def page_counts(spark, d):
    c = texts.counts(F.col("html"))
    ticks = F.length("html") - F.length(F.replace("html", F.lit("`"), F.lit("")))
    return T(spark, d, "pages").select("page_id", ticks.alias("n_ticks"), c["n_urls"].alias("n_urls"), F.regexp_count("html", F.lit("<a href")).alias("n_links"), c["n_fences"].alias("n_fences"), F.regexp_extract("url", "https?://([^/]+)", 1).alias("host"))


@plan("""WITH o AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
  SELECT lang, count(*) AS n, max(n_chars) FILTER (i = floor((n - 1) * 0.5)) AS p50, max(n_chars) FILTER (i = floor((n - 1) * 0.9)) AS p90, max(n_chars) FILTER (i = floor((n - 1) * 0.95)) AS p95 FROM o GROUP BY 1""")
def length_percentiles(spark, d):
    docs = T(spark, d, "documents")
    p = stats.percentile_ranked(docs, "n_chars", ["lang"], {"p50": 0.5, "p90": 0.9, "p95": 0.95}, floor=True)
    return stats.counter(docs, F.col("lang")).join(p, "lang")


@plan("""SELECT d.doc_id, concat_ws(',', CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END, CASE WHEN quality = 0 THEN 'low_quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 100 THEN 'short' END) AS reasons
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def document_gate(spark, d):
    rows = T(spark, d, "documents").select("doc_id", "n_chars").join(T(spark, d, "labels"), "doc_id", "left")
    r = gates.reasons(unlabelled=F.col("quality").isNull(), low_quality=F.col("quality") == 0, toxic=F.col("toxic") == 1, short=F.col("n_chars") < 100)
    return rows.select("doc_id", F.array_join(r, ",").alias("reasons"))


@plan("""SELECT lang, count(*) FILTER (quality = 0) AS "0", count(*) FILTER (quality = 1) AS "1" FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def language_quality_matrix(spark, d):
    return stats.matrix(T(spark, d, "documents").select("doc_id", "lang").join(T(spark, d, "labels"), "doc_id"), "lang", "quality", [0, 1])


@plan("""SELECT count(*) AS n, sum((sha256(text) IN (SELECT sha256(text) FROM benchmark))::INT)::BIGINT AS n_text, sum((split_part(text, ' ', 1) IN (SELECT split_part(text, ' ', 1) FROM benchmark))::INT)::BIGINT AS n_first_word FROM documents""")
def benchmark_overlap(spark, d):
    from millrace.operators.joins import overlap

    return overlap(T(spark, d, "documents"), T(spark, d, "benchmark"), text=F.sha2("text", 256), first_word=F.get(F.split("text", " "), F.lit(0)))


@plan("""SELECT doc_id, coalesce(nullif(source, ''), 'unknown') AS source, n_chars, sha256(coalesce(text, '')) AS text_sha256, replace(left(text, 80), chr(10), ' ') AS preview, round_even(n_chars / 4.0, 0)::BIGINT AS n_tokens FROM documents""")
def index_rows(spark, d):
    docs = T(spark, d, "documents")
    return docs.select("doc_id", coerce.labelled(F.col("source"), "unknown").alias("source"), "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), coerce.safe_tsv(F.left("text", F.lit(80))).alias("preview"), texts.estimated_tokens(F.col("n_chars")).alias("n_tokens"))


@plan("""SELECT doc_id, ('0x' || substr(sha256('seed:' || doc_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS unit FROM documents""")
def stable_keys(spark, d):
    return T(spark, d, "documents").select("doc_id", coerce.stable_unit(F.lit("seed"), F.col("doc_id").cast("string")).alias("unit"))


@plan("""WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS k FROM documents) SELECT doc_id, source, n_chars FROM r WHERE k <= 3""")
def source_cap(spark, d):
    return ranking.top_per_group(T(spark, d, "documents"), ["source"], [F.asc("n_chars"), F.asc("doc_id")], 3).select("doc_id", "source", "n_chars")


@plan("""WITH q AS (SELECT lang, count(*) AS w FROM documents GROUP BY 1), e AS (SELECT lang, w * 60 / sum(w) OVER () AS x FROM q), f AS (SELECT *, floor(x) AS fl, 60 - sum(floor(x)) OVER () AS rest FROM e),
  k AS (SELECT lang, fl + (row_number() OVER (ORDER BY round(x - fl, 9) DESC, lang) <= rest)::INT AS quota FROM f),
  r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('pick' || doc_id)) AS n FROM documents)
  SELECT doc_id, lang FROM r JOIN k USING (lang) WHERE n <= quota""")
def stratified_sample(spark, d):
    """A sample of 60 with quotas by language, drawn by hash."""
    docs = T(spark, d, "documents").select("doc_id", "lang")
    quota = ranking.largest_remainder(stats.counter(docs, F.col("lang"), name="w"), "lang", "w", 60).select("lang", "quota")
    key = F.sha2(F.concat(F.lit("pick"), F.col("doc_id").cast("string")), 256)
    ranked = docs.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(key)))
    return ranked.join(quota, "lang").where("n <= quota").select("doc_id", "lang")


@plan("""SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug, CASE WHEN length(p_name || p_brand) <= 12 THEN p_name || p_brand ELSE left(p_name || p_brand, 6) || '~' || right(p_name || p_brand, 6) END AS short,
  lower(trim(p_type)) IN ('1', 'true', 'yes', 'y', 'passed', 'pass', 'promo') AS odd FROM part""")
def name_forms(spark, d):
    p, both = T(spark, d, "part"), F.concat("p_name", "p_brand")
    return p.select("p_partkey", coerce.slug(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug"), coerce.truncate_middle(both, 12, "~").alias("short"), (coerce.truthy(F.col("p_type")) | (F.lower("p_type") == "promo")).alias("odd"))


DIFF = """'diff --git a/src/' || p_partkey || '.py b/src/' || p_partkey || '.py' || chr(10) || '--- a/src/x.py' || chr(10) || '+++ b/src/x.py' || chr(10) || '@@ -1 +1 @@' || chr(10) || '-' || p_name || chr(10) || '+' || p_brand || chr(10) || '+' || p_type || chr(10)
  || CASE WHEN p_size % 3 = 0 THEN 'diff --git a/tests/test_' || p_size || '.go b/tests/test_' || p_size || '.go' || chr(10) || '+++ b/tests/t.go' || chr(10) || '-gone' || chr(10) ELSE '' END"""


@plan(f"""WITH x AS (SELECT p_partkey, p_size, {DIFF} AS diff FROM part)
  SELECT p_partkey, len(regexp_extract_all(diff, 'diff --git ')) AS n_files, 2 AS n_added, CASE WHEN p_size % 3 = 0 THEN 2 ELSE 1 END AS n_removed, CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END AS net,
  CASE WHEN p_size % 3 = 0 THEN 'go,python' ELSE 'python' END AS languages, 'src/' || p_partkey || '.py' AS source_paths, CASE WHEN p_size % 3 = 0 THEN position('diff --git a/tests' IN diff) - 1 ELSE length(diff) END AS n_kept FROM x""")
def diff_measures(spark, d):
    x = T(spark, d, "part").withColumn("diff", F.expr(DIFF.replace("|| chr(10)", "|| '\\n'")))
    c, test = F.col("diff"), F.array(F.concat(F.lit("tests/test_"), F.col("p_size").cast("string"), F.lit(".go")))
    return x.select("p_partkey", diffs.file_count(c).alias("n_files"), diffs.added(c).alias("n_added"), diffs.removed(c).alias("n_removed"), diffs.net_delta(c).alias("net"), F.array_join(diffs.languages(c), ",").alias("languages"), F.array_join(diffs.source_paths(c), ",").alias("source_paths"), F.length(diffs.without_paths(c, test)).alias("n_kept"))


@plan("""WITH b AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, sha256('<returncode>0</returncode>' || chr(10) || CASE WHEN length(t) < 2000 THEN '<output>' || chr(10) || t || '</output>'
  ELSE '<output_head>' || chr(10) || left(t, 1000) || chr(10) || '</output_head>' || chr(10) || '<elided_chars>' || chr(10) || (length(t) - 2000) || ' characters elided' || chr(10) || '</elided_chars>' || chr(10) || '<output_tail>' || chr(10) || right(t, 1000) || chr(10) || '</output_tail>' END) AS digest FROM b""")
def observations(spark, d):
    return T(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(texts.observation(F.col("text"), 2000), 256).alias("digest"))


@plan("""SELECT doc_id, coalesce((regexp_matches(text, '(?is)(^|[^-]|[^n]-|[^o]n-|[^n]on-)(add|create|modify|update|change|write)\\s+(a\\s+|new\\s+|the\\s+)?(unit\\s+|integration\\s+)?tests?\\b') OR regexp_matches(text, '(?is)(add|create|modify|update|change|write).{0,80}\\btests?/')) AND NOT regexp_matches(text, '(?i)do not (add|create|modify|update|change|write) (a |new |the )?(unit |integration )?tests?') AND NOT regexp_matches(text, '(?i)\\bnon-test (source )?files?\\b'), false) AS asks, len(regexp_extract_all(text, '[0-9]{4,}')) AS n_numbers, length(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) AS n_collapsed FROM documents""")
def prompt_measures(spark, d):
    c = F.regexp_replace(F.regexp_replace("text", "[ \t]+", " "), "\n{3,}", "\n\n")
    return T(spark, d, "documents").select("doc_id", submissions.asks_for_test_edits(F.col("text")).alias("asks"), F.regexp_count("text", F.lit("[0-9]{4,}")).alias("n_numbers"), F.length(c).alias("n_collapsed"))
