"""Gates: predicates that keep every reason, or the first, for turning a row down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.coerce import blank_to_null


def reasons(**failed: Column) -> Column:
    """The names of all conditions that hold, in the order given; null counts as not."""
    return F.array_compact(F.array(*(F.when(c, name) for name, c in failed.items())))


def first_reason(**failed: Column) -> Column:
    """The name of the first condition that holds, or null."""
    out = None
    for name, c in failed.items():
        out = F.when(c, name) if out is None else out.when(c, name)
    return out


def decisions(df: DataFrame, reason: Column, kept: str = "kept") -> DataFrame:
    """Rows per decision: one pass gives all of a gate's counters."""
    return df.groupBy(F.coalesce(reason, F.lit(kept)).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def present(c: Column) -> Column:
    return blank_to_null(c).isNotNull()


#: What the high-quality task gate lets through.
TASK_LANGUAGES = ("c", "cpp", "go", "java", "js", "php", "python", "ruby", "rust", "ts")
TASK_LEVELS = ("easy", "medium", "hard")


def task_quality(code: Column, intent: Column, alignment: Column, issues: Column, strict: bool = True) -> Column:
    """Reasons code, intent, test_alignment, detected_issues; the lenient form lets missing code and intent pass."""
    missing = lambda c: ~F.coalesce(present(c), F.lit(False))
    lack = F.lit(strict)
    return reasons(
        code=(missing(code) & lack) | (F.coalesce(code, F.lit("")) != "A") & ~missing(code),
        intent=(missing(intent) & lack) | (F.coalesce(intent, F.lit("")) != "complete") & ~missing(intent),
        test_alignment=F.coalesce(alignment, F.lit(False)),
        detected_issues=F.coalesce(F.exists(F.map_values(issues), lambda x: x), F.lit(False)),
    )


def high_quality_task(language, level, code, intent, alignment, issues, confidence, least: float = 0.95) -> Column:
    """Whether a task is of a known language and level, has no strict quality reason, and is confident enough."""
    ok = language.isin(*TASK_LANGUAGES) & level.isin(*TASK_LEVELS) & (F.size(task_quality(code, intent, alignment, issues)) == 0) & (confidence >= least)
    return F.coalesce(ok, F.lit(False))


def easy_small_diff(language, level, files, lines, solved, languages: tuple, levels: tuple = ("easy",), most_files: int = 2, most_lines: int = 80) -> Column:
    """Whether a task is wanted by language and level, changes little, and has no strict success yet."""
    return F.coalesce(language.isin(*languages) & level.isin(*levels) & (F.coalesce(solved, F.lit(0)) == 0) & (F.coalesce(files, F.lit(0)) <= most_files) & (F.coalesce(lines, F.lit(0)) <= most_lines), F.lit(False))


def strict_success(passed, reward, status, patch_bytes, calls, reasoning, least_reasoning=0.9) -> Column:
    """Every condition of a strict success; null fails."""
    return F.coalesce(passed & (reward > 0) & (status == "Submitted") & (patch_bytes > 0) & (calls > 0) & (reasoning >= least_reasoning), F.lit(False))


def quality_filter(**needed: Column) -> Column:
    """The first filter that turns a row down, as skipped_<name>, or null. Each keyword says when it does; filters not asked for are left out."""
    return first_reason(**{f"skipped_{name}": c for name, c in needed.items()})


def hard_pass(passed, reward, status, patch_bytes, reasoning, calls, assistants, size, most_patch=100_000, most_bytes=5_000_000, least_reasoning=0.9) -> Column:
    """Every condition of a verified success; null fails."""
    ok = passed & (reward > 0) & (status == "Submitted") & patch_bytes.between(1, most_patch) & (reasoning >= least_reasoning) & (calls > 0) & (assistants > 0) & (size <= most_bytes)
    return F.coalesce(ok, F.lit(False))


def strict_drop_reason(passed, reward, status, patch_bytes, reasoning, has_all, calls, least_reasoning=0.9) -> Column:
    """The first reason to drop, or null; reasoning is not asked where all of it is there."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return first_reason(not_passed=no(passed & (reward > 0)), not_submitted=no(F.trim(status) == "Submitted"), empty_patch=no(patch_bytes > 0), low_reasoning_coverage=no(has_all) & no(reasoning >= least_reasoning), api_calls_zero=no(calls > 0))


def outcome_category(found: Column, patch_bytes, n_changed, result=None, calls=None, stopped=None, missing_result=None, missing_trajectory=None) -> Column:
    """One category of an audited trace, by precedence over its audit reasons `found`: resolved where there are none,
    harness_error, patch_apply_failed, missing_submit, empty_patch, forbidden_path_patch, malformed_or_manual_patch,
    unresolved, else the first reason. result: the result as text, which may tell of a patch that did not apply;
    stopped: whether the agent ended with an exception."""
    no = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    has = lambda *names: F.arrays_overlap(found, F.array(*map(F.lit, names)))
    failed = F.lit(False) if result is None else F.coalesce(result.rlike(r"(?i)patch apply failed|git apply.*fail|apply.*patch.*fail"), F.lit(False))
    return (
        F.when(F.size(found) == 0, "resolved").when(no(missing_trajectory) | no(missing_result) | (no(stopped) & (F.coalesce(F.lit(0) if calls is None else calls, F.lit(0)) == 0)), "harness_error")
        .when(failed, "patch_apply_failed").when(has("missing_submit_command"), "missing_submit").when((F.coalesce(patch_bytes, F.lit(0)) == 0) | (F.coalesce(n_changed, F.lit(0)) == 0), "empty_patch")
        .when(has("patch_touches_forbidden_paths"), "forbidden_path_patch")
        .when(has("manual_patch_construction", "patch_artifact_assembly", "patch_missing_real_unified_diff_headers", "git_apply_check_failed"), "malformed_or_manual_patch")
        .when(has("verifier_reward_not_1"), "unresolved").otherwise(F.get(found, F.lit(0)))
    )


def compact_pass(passed, reward, patch_bytes, empty_patch, has_submit, most_patch=100_000) -> Column:
    """The gate of compacted traces: missing reward counts as 1, a missing submit as there."""
    ok = F.coalesce(passed, F.lit(False)) & (F.coalesce(reward, F.lit(1.0)) > 0) & patch_bytes.between(1, most_patch) & ~F.coalesce(empty_patch, F.lit(False)) & F.coalesce(has_submit, F.lit(True))
    return F.coalesce(ok, F.lit(False))


def nonpassing_quality(passed, patch_bytes, has_submit, reasoning, *natural: Column, most_patch=100_000, least_reasoning=0.9) -> Column:
    """A failed trace worth keeping: bounded patch, a submit, reasoning, and any natural signal."""
    any_signal = F.lit(False)
    for s in natural:
        any_signal = any_signal | F.coalesce(s, F.lit(False))
    ok = ~F.coalesce(passed, F.lit(False)) & patch_bytes.between(1, most_patch) & has_submit & (reasoning >= least_reasoning) & any_signal
    return F.coalesce(ok, F.lit(False))


def strict_quality(passed, reward, status, patch_bytes, reasoning, calls, assistants, least_reasoning=0.9) -> Column:
    """All of the seven reasons that hold; the row is kept with them."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return reasons(not_passed=no(passed), reward_not_positive=no(reward > 0), not_submitted=no(status == "Submitted"), empty_patch=no(patch_bytes > 0), reasoning_under_90pct=no(reasoning >= least_reasoning), api_calls_not_positive=no(calls > 0), missing_assistant_messages=no(assistants > 0))


def pass_source(reward, passed: list[Column], strict: list[tuple[str, Column]], accepted: list[tuple[str, Column]]) -> Column:
    """What certifies a pass, or null where nothing does.

    The reward must be 1 and, of the passed flags that are there, any must be true. Then the first of the strict fields
    that says so, <name>=strict; else the first accepted flag that is true, <name>=true; else reward_1_passed.
    """
    any_there, any_true = F.lit(False), F.lit(False)
    for c in passed:
        any_there, any_true = any_there | c.isNotNull(), any_true | F.coalesce(c, F.lit(False))
    sources = [F.when(F.lower(c.cast("string")).contains("strict"), F.lit(f"{n}=strict")) for n, c in strict] + [F.when(c, F.lit(f"{n}=true")) for n, c in accepted]
    return F.when((reward == 1) & (~any_there | any_true), F.coalesce(*sources, F.lit("reward_1_passed")))


#: Points of a candidate's source group.
GROUP_POINTS = {"recommended_v5_compaction": 60.0, "verification_standard_replacement": 55.0, "strict_passed_remaining": 35.0, "soft_passed_remaining": 32.0, "passed_compaction_remaining": 30.0}


def candidate_score(reasoning, calls, patch_bytes, signals: dict[str, Column], group: Column | None = None, family: Column | None = None, teacher: Column | None = None) -> dict[str, Column]:
    """The score of a candidate and the notes of what counted. With a source group the rules for passed candidates, without it
    those for good candidates that did not pass. signals: natural_patch_verification, natural_patch_create,
    natural_submit_command_cats_patch, natural_visible_diff_evidence, missing_nonempty_patch_verification."""
    passed = group is not None
    share, n, size = F.coalesce(reasoning, F.lit(0.0)), F.coalesce(calls, F.lit(0)), F.coalesce(patch_bytes, F.lit(0))
    sig = lambda k: F.coalesce(signals.get(k, F.lit(False)), F.lit(False))
    base = F.element_at(F.create_map(*(F.lit(x) for pair in GROUP_POINTS.items() for x in pair)), group) if passed else F.lit(20.0)
    base = base + 10.0 * F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) + F.least(n, F.lit(80 if passed else 120)) / F.lit(20.0)
    parts = {
        "near_full_reasoning": (share >= 0.99, 1.0), "healthy_api_calls": (n.between(4, 120), 1.0), "normal_patch": (size.between(200, 20_000), 2.0), "small_patch": (size < 200, -1.0),
        "natural_patch_verification": (sig("natural_patch_verification"), 10.0),
    }
    if not passed:
        parts["natural_patch_create"] = (sig("natural_patch_create"), 4.0)
        parts["visible_diff_evidence"] = (sig("natural_visible_diff_evidence"), 2.0)
    parts["submit_cats_patch"] = (sig("natural_submit_command_cats_patch"), 4.0 if passed else 2.0)
    if passed:
        parts["visible_diff_evidence"] = (sig("natural_visible_diff_evidence"), 2.0)
    parts["missing_nonempty_patch_verification"] = (sig("missing_nonempty_patch_verification"), -3.0)
    if passed and family is not None:
        parts["synthetic_patchtxt_verification"] = (F.coalesce(family == "synthetic_patchtxt_verification_prototype", F.lit(False)), 8.0)
    if passed and teacher is not None:
        low = F.lower(F.coalesce(teacher, F.lit("")))
        parts["mimo_teacher"] = (low.contains("mimo-v2.5"), 0.4)
        parts["deepseek_teacher"] = (low.contains("deepseek") & ~low.contains("mimo-v2.5"), 0.2)
    own = score(parts)
    first = group if passed else F.lit("high_quality_nonpassing")
    return {"score": base + own["score"], "notes": F.concat(F.array(first), own["notes"])}


def score(parts: dict[str, tuple[Column, float]], base: float = 0.0) -> dict[str, Column]:
    """An additive score and the names of the parts that held."""
    total = F.lit(base)
    for c, points in parts.values():
        total = total + F.when(c, points).otherwise(0.0)
    return {"score": total, "notes": reasons(**{n: c for n, (c, _) in parts.items()})}
