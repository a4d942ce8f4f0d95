"""Shell commands, classed by plain word tables, and where a patch file's contents come from.

Classes are expressions over the command's text with its blanks collapsed: a table's words and pairs are looked up
there, and what a line writes to is cut out of it. Where a patch file's contents come from needs the order of the
parts of a command; that is one Arrow-batched function, `patch_facts`.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The words, or pairs of words, that put a turn's command in a class.
READERS = ("cat", "cd", "find", "grep", "head", "ls", "pwd", "rg", "sed -n", "stat", "tail", "tree", "wc", "git status", "git diff", "git show", "git log", "git grep", "git ls-files")
TESTERS = ("pytest", "tox", "nox", "go test", "cargo test", "npm test", "pnpm test", "yarn test", "mvn test", "gradle test", "make test", "make check", "ctest", "phpunit")
WRITERS = ("tee", "mv", "cp", "rm", "touch", "chmod", "git apply")
EDITORS = ("apply_patch", "sed -i", "perl -pi")
SCRIPTED = ("python - <<", "python3 - <<", "node - <<", "ruby - <<")
VIEWERS = ("cat", "sed", "head", "tail", "wc", "grep", "stat", "ls", "test")
STATES = ("git diff", "git status")
PRINTERS = ("cat", "tee", "printf", "echo")
# The same for the categories of steps, where words count only behind white space.
STEP_TESTERS = ("pytest", "tox", "npm test", "pnpm test", "yarn test", "go test", "cargo test", "mvn test", "gradle test", "make test", "ctest", "rspec", "phpunit")
STEP_STATES = ("git diff", "git status", "git show")
STEP_READERS = ("rg", "grep", "find", "ls", "pwd", "sed -n", "cat", "head", "tail", "awk", "tree")
STEP_SETUPS = ("pip install", "npm install", "pnpm install", "yarn install", "go mod", "cargo fetch", "composer install")
STEP_RUNNERS = ("node", "ruby", "php", "perl", "go run", "cargo run")
STEP_PROGRAMS = ("- <<", "<<", "'", '"', "-c")
#: Fixed value: what a command holds that ends a task, in lower case.
MARKER = "complete_task_and_submit_final_output"
PATCH = "patch.txt"


def _any(table: tuple) -> str:
    return "(?:" + "|".join(map(re.escape, table)) + ")"


def _word(text: Column, table: tuple) -> Column:
    """Whether a word or pair of the table stands in the text."""
    return text.rlike(rf"(?<!\w){_any(table)}(?!\w)")


def _behind_blank(text: Column, table: tuple, whole: bool = True) -> Column:
    """The same, where it must follow white space or start the text; not whole: it may go on."""
    return text.rlike(rf"(?<!\S){_any(table)}" + (r"(?!\w)" if whole else ""))


def _flat(command: Column) -> Column:
    return F.regexp_replace(command, r"[^\S\n]+", " ")


def _on_a_line(low: Column, test) -> Column:
    """Whether a line passes a test; only commands that name a patch file have their lines looked at."""
    return F.when(low.contains(PATCH), F.exists(F.split(low, "\n"), test)).otherwise(F.lit(False))


def _into_patch(text: Column, tee: str) -> Column:
    """Whether a redirection, or a tee, in the text names a patch file."""
    return F.exists(F.regexp_extract_all(text, F.lit(rf"(?:>+|{tee} )\s*(\S*)"), 1), lambda t: t.contains(PATCH))


def writes_patch_by_hand(command: Column) -> Column:
    """Whether a line prints or copies something into a patch file."""
    printed = lambda x: F.regexp_extract(x, f"{_any(PRINTERS)}(.*)$", 1)
    return F.coalesce(_on_a_line(_flat(F.lower(command)), lambda x: _into_patch(printed(x), r"\btee")), F.lit(False))


def is_submit(command: Column) -> Column:
    """Whether a command ends the task: by its marker alone."""
    return F.coalesce(F.lower(command).contains(MARKER), F.lit(False))


def turn_action(command: Column) -> Column:
    """manual_patch_artifact, submit, verify, test, write, read or other: the first that holds."""
    low = _flat(F.lower(F.coalesce(command, F.lit(""))))
    diffed = _on_a_line(low, lambda x: _into_patch(F.regexp_extract(x, r"\bgit diff\b(.*)$", 1), r"\|\s*tee"))
    viewed = _on_a_line(low, lambda x: _word(F.regexp_extract(x, r"^(.*)\bpatch\.txt\b", 1), VIEWERS))
    submits = diffed | _word(low, ("submit",)) | low.contains("/submit") | low.contains("submit.py")
    writes = _word(low, WRITERS) | low.rlike(_any(EDITORS)) | low.rlike(_any(SCRIPTED)) | low.rlike(r">\s*/")
    return (
        F.when(low == "", "other").when(writes_patch_by_hand(low), "manual_patch_artifact").when(submits, "submit")
        .when(viewed | _word(low, STATES), "verify").when(_word(low, TESTERS), "test").when(writes, "write").when(_word(low, READERS), "read").otherwise("other")
    )


def step_category(command: Column, audit: bool = False) -> Column:
    """submit, test, edit, diff_status, inspect, probe, setup, other; blank commands are no_command.

    An inline program of an interpreter is a probe unless it writes. The audit counts those of Python as edits
    and knows no probes.
    """
    low = _flat(F.lower(F.trim(F.coalesce(command, F.lit("")))))
    edits = _behind_blank(low, (*EDITORS, "cat >", "tee "), whole=False) | low.rlike(r"(?<!\S)printf .*>")
    runs = low.rlike(rf"(?<!\S)(?:python[0-9.]*|{_any(STEP_RUNNERS)}) {_any(STEP_PROGRAMS)}")
    if audit:
        edits = edits | low.rlike(rf"(?<!\S)python[0-9.]* {_any(('- <<', '-c'))}")
    else:
        saves = low.contains(">") | low.contains("write_text") | low.contains("sed -i") | low.rlike(r"open\(.+['\"]w")
        edits = edits | _behind_blank(low, ("patch",)) | (runs & saves)
    out = F.when(low == "", "no_command").when(low.contains(MARKER), "submit").when(_behind_blank(low, STEP_TESTERS), "test")
    out = out.when(edits, "edit").when(_behind_blank(low, STEP_STATES), "diff_status").when(_behind_blank(low, STEP_READERS), "inspect")
    if not audit:
        out = out.when(runs, "probe")
    return out.when(_behind_blank(low, STEP_SETUPS), "setup").otherwise("other")


# ---- where a patch file comes from

_PATCH = re.compile(r"(?<![\w.-])patch\.txt(?![\w.-])")
_LIKE = re.compile(r"(?<![\w./-])[\w./-]+\.(?:txt|patch|diff)(?![\w./-])")
_DIFF = re.compile(r"\bgit\s+diff\b|(['\"])git\1\s*,\s*(['\"])diff\2")
_REDIRECT = re.compile(r"(>>?)\s*(\S+)")
_SCRIPT = re.compile(r"\bopen\s*\([^)\n]*patch\.txt[^)\n]*['\"]w|patch\.txt[^;\n]*\.open\s*\([^)\n]*['\"]w|\bwritefilesync\s*\([^)\n]*patch\.txt")


class _Part:
    """One simple command of a pipeline: its words, the files it writes and whether it appends."""

    def __init__(self, text: str):
        self.text = text.strip()
        self.words = self.text.split()
        self.head = re.match(r"[\w:]*", self.text)[0]
        found = _REDIRECT.findall(self.text)
        self.writes = [path for _, path in found]
        self.appends = [path for mark, path in found if mark == ">>"]
        self.tee = []
        if self.head == "tee":
            self.tee = [w for w in self.words[1:] if not w.startswith("-")][:1]
            if "-a" in self.words[1:2]:
                self.appends += self.tee


def _is_patch(path: str) -> bool:
    return bool(_PATCH.search(path))


def _is_the_patch(path: str) -> bool:
    path = path.strip().strip("'\"")
    for prefix in ("./", "/testbed/"):
        path = path.removeprefix(prefix)
    return path == PATCH


def _scripted(low: str) -> bool:
    return bool(_SCRIPT.search(low)) or "write_text" in low


def _by_hand(low: str) -> bool:
    """Whether the patch file gets contents that no git diff made."""
    if "diff -u /dev/null" in low or (_scripted(low) and not _DIFF.search(low)):
        return True
    made: set[str] = set()  # files that a git diff earlier in the command wrote
    for statement in re.split(r"[;&\n]", low):
        parts = [_Part(x) for x in statement.split("|")]
        shown = ""
        for i, p in enumerate(parts):
            shown += p.text + " "
            piped = parts[i + 1].tee if i + 1 < len(parts) else []
            into = [x for x in (*p.writes, *piped) if _is_patch(x)]
            sources = [x for x in _LIKE.findall(_REDIRECT.sub(" ", p.text) if into else p.text) if not _is_the_patch(x)]
            known = bool(sources) and made.issuperset(sources)
            if p.head in ("touch", "truncate") and any(map(_is_patch, p.words[1:])):
                return True
            if p.text.startswith((":", "true")) and re.match(r"(:|true)\s*>\s*\S*patch\.txt", p.text):
                return True
            if any(map(_is_patch, p.appends)) and not _DIFF.search(shown):
                return True
            if p.head in ("cat", "cp", "mv"):
                last = into or [w for w in p.words[-1:] if _is_patch(w) and len(p.words) > 1 and (sources or "/dev/null" in p.words)]
                if last and ((sources and not known) or (not sources and "/dev/null" in p.words)):
                    return True
            if p.head in PRINTERS and into and not known and not _DIFF.search(p.text):
                return True
        if _DIFF.search(statement):
            made.update(x.strip("'\"") for p in parts for x in (*p.writes, *p.tee))
    return False


def _facts(command: str | None) -> tuple[bool, bool, bool]:
    low = (command or "").lower()
    if not _PATCH.search(low):
        return False, False, False
    final = low.strip() == f"echo {MARKER} && cat {PATCH}"
    by_hand = not final and _by_hand(low)
    if MARKER in low:
        return by_hand, False, False
    parts = [_Part(x) for x in re.split(r"[;&\n|]", low)]
    piped = [_Part(x) for s in re.split(r"[;&\n]", low) for x in s.split("|")[1:]]
    teed = any(_is_patch(t) for p in piped for t in p.tee)
    views = any(_Part(x).head in ("cat", "grep", "sed", "head", "tail") and _is_patch("|".join(rest[i:])) for s in re.split(r"[;&]", low) for rest in [re.split(r"[|\n]", s)] for i, x in enumerate(rest))
    writes = any(_is_patch(x) for p in parts for x in (*p.writes, *p.tee)) or _scripted(low)
    return by_hand, bool(views or (teed and _DIFF.search(low))), writes


def patch_facts(command: Column) -> Column:
    """struct<by_hand, prepares, writes> of a command.

    by_hand: the patch file gets contents that no git diff of this command made. prepares: the command shows the
    patch file, or tees a git diff into it. writes: it writes the file at all. All false where no patch file is named.
    """

    def run(batch: pd.Series) -> pd.DataFrame:
        seen: dict = {}
        rows = [seen[c] if c in seen else seen.setdefault(c, _facts(c)) for c in batch.where(batch.notna(), None)]
        return pd.DataFrame(rows, columns=["by_hand", "prepares", "writes"])

    return F.pandas_udf(run, "by_hand boolean, prepares boolean, writes boolean")(command)
