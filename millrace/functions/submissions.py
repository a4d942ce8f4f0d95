"""Submitted patches and prompts: which rules they break, by name."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


from millrace.functions.coerce import strip

# Parts of paths and names that a patch may not touch, and source endings by language.
SCRATCH_PARTS = ("/tmp/", "scratch", "repro", "reproduce", "debug")
TEST_PARTS = ("test/", "tests/", "_test.", "test_", ".snap", "fixture", "golden", "testdata/", "_result.", "expected")
SOURCE_ENDINGS = {"go": (".go",), "java": (".java",), "python": (".py",), "c": (".c", ".h"), "cpp": (".cc", ".cpp", ".cxx", ".h", ".hh", ".hpp", ".hxx", ".ipp", ".tpp", ".inl")}
FORBIDDEN_FOLDERS = ("test", "tests", "__tests__", "fixture", "fixtures", "snapshot", "snapshots", "golden", "goldens")
FORBIDDEN_FILES = ("package-lock.json", "yarn.lock", "pnpm-lock.yaml", "Cargo.lock", "poetry.lock", "Pipfile.lock", "composer.lock", "Gemfile.lock", "go.sum", "pyproject.toml", "setup.cfg", "setup.py", "tox.ini", "noxfile.py")
FORBIDDEN_ENDINGS = (".snap", ".snapshot", ".golden", ".min.js")
PATCH_NAMES = tuple(f"{stem}.{end}" for stem in ("patch", "fix", "model") for end in ("txt", "patch", "diff"))
FORBIDDEN_SNIPPETS = ("# ... existing code ...", "... existing code")
# Phrases of prompts, in lower case.
PROCESS_PHRASES = (
    "create a new initial mini-swe task prompt", "compacted successful trajectory", "discarded-prefix", "discarded prefix", "retained suffix", "cut turn", "replacement prompt", "replacement user message",
    "compaction_model_reasoning", "mini_swe_task_prompt", "current_repo_state", "actions_already_taken", "uncertainty_notes", "full discarded prefix", "included discarded prefix", "trajectory editing",
    "this compaction pipeline", "this json conversion", "json repair", "original row id:",
)
CONTINUATION_WORDS = ("continue", "already")
CONTINUATION_PHRASES = (
    "previous attempt", "progress so far", "what has already been done", "current repository state", "implementation includes", "next step", "just verify", "only need to verify", "only needs to verify",
    "generate patch", "generate the patch", "required interface", "interface notes", "recommended workflow", "command execution rules", "finish by issuing", "complete_task_and_submit_final_output",
)
DONE_AUXILIARIES, DONE_VERBS = ("has been", "have been", "was", "were"), ("addressed", "updated", "changed", "modified", "implemented", "added", "removed", "fixed")
INTENT_PARTS = ("fix", "implement", "update", "change", "add", "remove", "ensure", "make", "support", "handle", "debug", "resolve", "issue", "bug", "failing")
STATE_PARTS = ("current", "investigat", "examined", "found", "identified", "file", "test", "failure", "error", "command", "diff", "patch", "implementation", "behavior", "module", "function", "class", "method")
REQUIRED_KEYS = ("actions_already_taken", "compaction_model_reasoning", "current_repo_state", "mini_swe_task_prompt", "original_goal", "uncertainty_notes")
BUILD_CLAIMS = ("src/main.c", "include/config.h", "undefined reference", "main application module", "missing configuration files")
FIRST_CATEGORIES = ("edit", "test", "diff_status", "submit")


def _any(parts: tuple) -> str:
    return "(?:" + "|".join(map(re.escape, parts)) + ")"


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once per row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _holds(text: Column, parts: tuple) -> Column:
    """Whether a text holds any of the parts; plain searches are faster than one pattern of them all."""
    out = F.lit(False)
    for x in parts:
        out = out | text.contains(x)
    return out


def _named(**failed: Column) -> Column:
    return F.array_compact(F.array(*(F.when(c, name) for name, c in failed.items())))


def bad_paths(paths: Column, language: Column) -> Column:
    """Whether paths hold anything but sources: none at all, scratch or test files, endings of another language."""
    endings = F.create_map(*(x for lang, ends in SOURCE_ENDINGS.items() for x in (F.lit(lang), F.array(*map(F.lit, ends)))))
    allowed = F.element_at(endings, F.lower(F.coalesce(language, F.lit(""))))
    ending = lambda p: F.lower(F.regexp_extract(p, r"[^/](\.[^./]*)$", 1))
    bad = lambda p: _holds(F.lower(p), (*SCRATCH_PARTS, *TEST_PARTS)) | (allowed.isNotNull() & ~F.coalesce(F.array_contains(allowed, ending(p)), F.lit(False)))
    return (F.size(paths) == 0) | F.exists(paths, bad)


def submission_reasons(patch: Column, language: Column) -> Column:
    """Everything wrong with a submitted patch: empty_submission, missing_diff_header, bad_changed_paths,
    forbidden_snippet:<snippet>, patch_txt_diff."""
    text = F.coalesce(patch, F.lit(""))
    snippets = {f"forbidden_snippet:{x}": text.contains(x) for x in FORBIDDEN_SNIPPETS}
    git = F.regexp_extract_all(text, F.lit(r"(?m)^diff --git a/(.*?) b/(.*?)$"), 2)
    return _named(empty_submission=strip(text) == "", missing_diff_header=~text.contains("diff --git "), bad_changed_paths=bad_paths(git, language), **snippets, patch_txt_diff=text.rlike(r"(?m)^diff --git a/patch\.txt b/patch\.txt$"))


def forbidden_path(path: Column) -> Column:
    """Whether a patch may not touch a path: test folders, lock and project files, snapshots, patch files."""
    pieces = F.split(path, "/")
    last = F.element_at(pieces, -1)
    ending = F.lit(False)
    for x in FORBIDDEN_ENDINGS:
        ending = ending | last.endswith(x)
    return F.arrays_overlap(pieces, F.array(*map(F.lit, FORBIDDEN_FOLDERS))) | last.isin(*FORBIDDEN_FILES, *PATCH_NAMES) | ending


def has_headers(patch: Column) -> Column:
    """Whether a patch has git's header and both file headers."""
    return F.coalesce(patch.contains("diff --git ") & patch.rlike("(?m)^--- (a/|/dev/null)") & patch.rlike(r"(?m)^\+\+\+ (b/|/dev/null)"), F.lit(False))


# ---- commands of a whole trace

_MARKER = "COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"
_FINAL = re.compile(r"(?:/testbed/)?(?:\./)?patch\.txt\b")
_SOURCE_SCRIPT = re.compile(r">\s*\S*patch\.(?:js|ts|jsx|tsx|py|sh|go|rs|java|php|cc|cpp|c|hpp|hh|h)\b")


def _parts(command: str) -> list[tuple[str, str]]:
    """(first word, text) of the parts of a command between semicolons, ampersands and pipes."""
    return [(m[0], x.strip()) for x in re.split(r"[;&|]", command) if (m := re.match(r"[\w:]+|", x.strip())) is not None]


def _redirects(text: str) -> list[str]:
    return [t for t in re.findall(r">+\s*([^;&|\n>]*)", text)]


def _by_hand(command: str) -> bool:
    low = command.lower()
    if "patch" not in command or (_SOURCE_SCRIPT.search(command) and not re.search(r"diff --git|--- a/|\+\+\+ b/", command)):
        return False
    if "git diff" in command and not re.search(r"\b(?:echo|printf|tee)\b|\bcat\s+(?:<<|>)", command):
        return False
    parts = _parts(low)
    for i, (head, text) in enumerate(parts):
        if head in ("echo", "printf") and any("patch" in t for _, x in parts[i:] for t in _redirects(x)):
            return True
        if head == "cat" and re.match(r"cat\s+(<<|>)", text) and any("patch" in t for t in _redirects(text)):
            return True
        if head == "tee" and "patch" in text.split("\n")[0].partition("tee")[2]:
            return True
    return False


def _writes_final(command: str) -> tuple[bool, bool, bool]:
    """(whether the final patch file is written, whether by redirection, whether empty)."""
    redirected = copied = emptied = False
    for head, text in _parts(command):
        at = lambda t: bool(_FINAL.match(t.strip()))
        into = any(at(t) for t in _redirects(text))
        redirected |= into
        copied |= head in ("cp", "mv") and bool(_FINAL.search(text))
        emptied |= (head in ("touch", "truncate") and bool(_FINAL.search(text))) or (head == ":" and into) or bool(re.match(r"cp\s+/dev/null\s+", text) and _FINAL.search(text))
    return redirected or copied or emptied, redirected, emptied


def _assembled(command: str) -> bool:
    if "patch.txt" not in command:
        return False
    written, redirected, emptied = _writes_final(command)
    return written and (emptied or not ("git diff" in command and redirected and not _by_hand(command)))


def _reads(command: str, heads: tuple) -> bool:
    return any(head in heads and re.search(r"\s[^\n]*patch\.txt\b", text) for head, text in _parts(command))


def _trace_facts(commands) -> tuple[int, int, bool, bool, bool]:
    commands = [c for c in (commands if commands is not None else []) if c is not None]
    submit = max((i for i, c in enumerate(commands) if _MARKER in c), default=-1)
    before = commands[:submit] if submit >= 0 else []
    full = any(_reads(c, ("cat",)) for c in before[-5:])
    weak = any(_reads(c, ("head", "tail", "grep", "wc")) for c in before[-3:])
    return sum(map(_by_hand, commands)), sum(map(_assembled, commands)), submit >= 0, full, weak


def trace_facts(commands: Column) -> Column:
    """struct<manual, assembled, submitted, full_read, weak_check> of a trace's commands, an array.

    manual and assembled count the commands that write a patch by hand, or put the final one together from anything but
    a git diff. full_read: one of the five commands before the last submit shows the whole patch file; weak_check: one
    of the three before it shows a part.
    """

    def run(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_trace_facts(x) for x in batch], columns=["manual", "assembled", "submitted", "full_read", "weak_check"])

    return F.pandas_udf(run, "manual long, assembled long, submitted boolean, full_read boolean, weak_check boolean")(commands)


# ---- prompts

def asks_for_test_edits(text: Column) -> Column:
    """Whether a prompt asks to write tests, and does not say that it must not be done."""
    verbs, kinds = "(?:add|create|modify|update|change|write)", r"(?:unit\s+|integration\s+)?tests?"
    asks = text.rlike(rf"(?is)(?<!non-){verbs}\s+(?:a\s+|new\s+|the\s+)?{kinds}\b") | text.rlike(rf"(?is){verbs}.{{0,80}}\btests?/")
    return F.coalesce(asks & ~text.rlike(rf"(?i)do not {verbs} (?:a |new |the )?{kinds}") & ~text.rlike(r"(?i)\bnon-test (?:source )?files?\b"), F.lit(False))


def speaks_of_process(text: Column) -> Column:
    return _let(F.lower(text), lambda low: _holds(low, PROCESS_PHRASES))


def continues(text: Column) -> Column:
    """Whether a prompt goes on from work already done."""
    return _let(F.lower(text), _continues)


def _continues(low: Column) -> Column:
    done = rf"(?:{_any(DONE_AUXILIARIES)} {_any(DONE_VERBS)}|{_any(DONE_AUXILIARIES[:2])} partially)"
    shapes = (r"changes? (?:made|introduced|include)", r"remaining (?:work|task|issue|step)", r"finish(?:es|ing)? (?:the )?(?:remaining )?(?:work|task)", r"submit (?:the )?(?:final )?(?:answer|output)", r"##\s*boundaries")
    return low.rlike(rf"\b{_any(CONTINUATION_WORDS)}\b") | _holds(low, CONTINUATION_PHRASES) | low.rlike(done) | low.rlike("|".join(shapes))


def contradicts_path(text: Column) -> Column:
    """Whether a prompt says that the work lies elsewhere than where it does."""
    return text.rlike(r"(?i)/testbed\s+(?:does not|doesn't)\s+exist") | text.rlike(r"(?i)repo(?:sitory)?\s+(?:is\s+)?(?:located|checked out)\s+at\s+/(?!testbed\b)")


def has_intent(text: Column) -> Column:
    return _let(F.lower(text), lambda low: _holds(low, INTENT_PARTS))


def prompt_flags(prompt: Column, first_category: Column) -> Column:
    """Flags of a prompt and of the category of the first command after it; an empty prompt has no other flag."""
    return _let(strip(F.coalesce(prompt, F.lit(""))), lambda p: _flags(p, first_category))


def _flags(p: Column, first_category: Column) -> Column:
    stateful = first_category.isin(*FIRST_CATEGORIES) & ~_let(F.lower(p), lambda low: _holds(low, STATE_PARTS))
    flags = _named(
        process_marker=speaks_of_process(p), continuation_marker=continues(p), path_contradiction=contradicts_path(p), requests_test_edits=asks_for_test_edits(p),
        too_short_for_stateful_compaction=F.length(p) < 180, very_long_prompt=F.length(p) > 9000, missing_clear_task_intent=~has_intent(p),
        insufficient_state_for_non_inspect_start=stateful, starts_with_submit=first_category == "submit", starts_with_diff_status=first_category == "diff_status",
    )
    return F.when(p == "", F.array(F.lit("empty_prompt"))).otherwise(flags)


def answer_error(answer: Column) -> Column:
    """The first failed check of a model's JSON answer, null if it passes.

    The answer may stand in a fence or between other words. It must be an object with all required keys, and its prompt
    must be long enough, say what to do, and neither speak of the process, go on from earlier work, contradict the
    place nor ask for tests.
    """
    body = strip(F.coalesce(answer, F.lit("")))
    fenced = F.regexp_replace(F.regexp_replace(body, r"(?is)^```(?:json)?\s*", ""), r"\s*```$", "")
    bare = F.when(body.startswith("```"), fenced).otherwise(body)
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    whole, part = F.try_parse_json(bare), F.try_parse_json(F.nullif(inner, F.lit("")))
    chosen = F.when(whole.isNotNull(), bare).when(part.isNotNull(), inner)
    kind = F.schema_of_variant(F.try_parse_json(chosen))
    missing = F.array_except(F.array(*map(F.lit, REQUIRED_KEYS)), F.coalesce(F.json_object_keys(chosen), F.array().cast("array<string>")))
    text_of = lambda k: F.try_variant_get(F.try_parse_json(chosen), f"$.{k}", "string")
    is_text = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(chosen), f"$.{k}", "variant")) == "STRING", F.lit(False)) & (strip(F.coalesce(text_of(k), F.lit(""))) != "")
    prompt = strip(F.coalesce(text_of("mini_swe_task_prompt"), F.lit("")))
    said = "mini_swe_task_prompt"
    return (
        F.when(body == "", "empty_response")
        .when(chosen.isNull(), F.when(inner == "", "no_json_object_found").otherwise("json_decode_error"))
        .when(~kind.startswith("OBJECT"), "json_root_not_object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing_required_keys:"), F.array_join(missing, ",")))
        .when(~is_text(said), f"empty_{said}").when(speaks_of_process(prompt), f"{said}_contains_compaction_process_marker").when(F.length(prompt) < 250, f"{said}_too_short")
        .when(~has_intent(prompt), f"{said}_missing_task_intent").when(continues(prompt), f"{said}_contains_continuation_marker").when(contradicts_path(prompt), f"{said}_contains_path_contradiction")
        .when(asks_for_test_edits(prompt), f"{said}_requests_test_edits").when(~is_text("compaction_model_reasoning"), "empty_compaction_model_reasoning")
    )


_ANCHORS = (
    re.compile(r"`([^`]{4,120})`"),
    re.compile(r"\b[A-Za-z0-9_./-]+\.(?:py|js|jsx|ts|tsx|go|rs|java|php|c|cc|cpp|cxx|h|hpp|rb|sh|md|json|yaml|yml|toml)\b"),
    re.compile(r"\b[A-Za-z_][A-Za-z0-9_]{5,}\b"),
)


def _anchors(names: list, text: str, most: int = 80) -> list[str]:
    found = [x for name in names for x in re.split(r"[^A-Za-z0-9_.-]+", name or "") if len(x) >= 4]
    for rule in _ANCHORS:
        found += rule.findall(text or "")
    out: dict = {}
    for term in found:
        term = term.strip().strip("'\".,:;()[]{}")
        if 4 <= len(term) <= 120:
            out.setdefault(term.lower(), term)
            if len(out) == most:
                break
    return list(out.values())


def anchor_terms(text: Column, *names: Column, most: int = 80) -> Column:
    """What a text is about, once each whatever the case: parts of the names, then quoted terms, file names and long words, in this order."""

    def run(texts: pd.Series, *rest: pd.Series) -> pd.Series:
        return pd.Series([_anchors(list(own), t, most) for t, *own in zip(texts, *rest, strict=True)])

    return F.pandas_udf(run, "array<string>")(text, *names)


def faithfulness_error(prompt: Column, context: Column, *names: Column) -> Column:
    """Why a prompt does not follow from its context, null if it does: none of its anchor terms, or a stock claim about a build."""
    low = F.lower(F.coalesce(prompt, F.lit("")))
    anchors = anchor_terms(context, *names)
    claims = low.rlike(rf"\b{_any(BUILD_CLAIMS)}\b")
    return (
        F.when(strip(low) == "", "faithfulness_empty_prompt")
        .when((F.size(anchors) > 0) & ~F.exists(anchors, lambda a: low.contains(F.lower(a))), "faithfulness_no_context_anchor_in_prompt")
        .when(claims & ~_holds(F.lower(F.coalesce(context, F.lit(""))), BUILD_CLAIMS), "faithfulness_generic_build_hallucination")
    )


def audit_reasons(reward: Column, patch: Column, commands: Column, missing_result: Column | None = None, missing_trajectory: Column | None = None, applies: Column | None = None) -> Column:
    """Every reason for which an audit turns a trace down, in the audit's order; none accepts it."""
    no = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    text, facts = F.coalesce(patch, F.lit("")), trace_facts(commands)
    files = F.array_distinct(F.filter(F.concat(*(F.regexp_extract_all(text, F.lit(r"(?m)^diff --git a/(.*?) b/(.*?)$"), i) for i in (1, 2))), lambda p: p != "/dev/null"))
    return _named(
        missing_result=no(missing_result), missing_trajectory=no(missing_trajectory), verifier_reward_not_1=F.coalesce(reward.cast("int"), F.lit(0)) != 1,
        patch_missing_real_unified_diff_headers=~has_headers(text), patch_changed_files_empty=F.size(files) == 0, patch_touches_forbidden_paths=F.exists(files, forbidden_path),
        manual_patch_construction=facts["manual"] > 0, patch_artifact_assembly=facts["assembled"] > 0, missing_submit_command=~facts["submitted"],
        weak_patch_check_before_submit=facts["submitted"] & facts["weak_check"] & ~facts["full_read"], git_apply_check_failed=F.lit(False) if applies is None else ~F.coalesce(applies, F.lit(True)),
    )


__all__ = [
    "anchor_terms", "answer_error", "asks_for_test_edits", "audit_reasons", "bad_paths", "continues", "contradicts_path", "faithfulness_error", "forbidden_path", "has_headers", "has_intent", "prompt_flags",
    "speaks_of_process", "submission_reasons", "trace_facts",
]
