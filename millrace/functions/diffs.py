"""Unified diffs as text columns: paths, counts, languages, sections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Languages by file extension, and what marks a path as a test.
LANGUAGES = {
    "py": "python", "js": "js", "jsx": "js", "ts": "ts", "tsx": "ts", "go": "go", "rs": "rust", "java": "java", "php": "php", "rb": "ruby", "cs": "csharp",
    "c": "c", "cc": "cpp", "cpp": "cpp", "cxx": "cpp", "h": "cpp", "hh": "cpp", "hpp": "cpp", "hxx": "cpp", "ipp": "cpp", "tpp": "cpp",
}
TEST_MARKS = ("tests/", "/test", "test_", "_test.", "fixture", "golden")


def paths(diff: Column) -> Column:
    """New paths of the diff's files; where no git headers stand, those after +++."""
    git = F.regexp_extract_all(diff, F.lit(r"(?m)^diff --git a/(.*?) b/(.*?)$"), 2)
    plain = F.regexp_extract_all(diff, F.lit(r"(?m)^--- a/[^\n]*\n\+\+\+ b/([^\t\n]*)"), 1)
    return F.when(F.size(git) > 0, git).otherwise(plain)


def file_count(diff: Column) -> Column:
    return F.size(paths(diff))


def _lines(diff: Column) -> Column:
    return F.filter(F.split(diff, "\n"), lambda x: ~(x.startswith("+++") | x.startswith("---")))


def added(diff: Column) -> Column:
    return F.size(F.filter(_lines(diff), lambda x: x.startswith("+")))


def removed(diff: Column) -> Column:
    return F.size(F.filter(_lines(diff), lambda x: x.startswith("-")))


def net_delta(diff: Column) -> Column:
    return added(diff) - removed(diff)


def changed_lines(diff: Column) -> Column:
    return added(diff) + removed(diff)


def is_test_path(path: Column) -> Column:
    low, out = F.lower(path), F.lit(False)
    for mark in TEST_MARKS:
        out = out | low.contains(mark)
    return out


def source_paths(diff: Column) -> Column:
    """Paths that are no tests."""
    return F.filter(paths(diff), lambda p: ~is_test_path(p))


def languages(diff: Column) -> Column:
    """Sorted languages of the files, by extension; other files have none."""
    table = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    names = F.transform(paths(diff), lambda p: F.element_at(table, F.regexp_extract(p, r"\.([^./]+)$", 1)))
    return F.array_sort(F.array_distinct(F.array_compact(names)))


def sections(diff: Column) -> Column:
    """The diff cut before each git header."""
    return F.filter(F.split(diff, r"(?m)(?=^diff --git )"), lambda s: s != "")


def without_paths(diff: Column, unwanted: Column) -> Column:
    """The diff less the sections either of whose paths is in an array."""
    head = r"^diff --git a/(.*?) b/([^\n]*)"
    keep = lambda s: ~(F.array_contains(unwanted, F.regexp_extract(s, head, 1)) | F.array_contains(unwanted, F.regexp_extract(s, head, 2)))
    return F.array_join(F.filter(sections(diff), keep), "")


def embedded(text: Column) -> Column:
    """The first embedded diff that touches something other than tests, else the first."""
    found = F.filter(sections(text), lambda s: s.startswith("diff --git "))
    good = F.filter(found, lambda s: F.size(source_paths(s)) > 0)
    return F.coalesce(F.get(good, F.lit(0)), F.get(found, F.lit(0)))


def quality_reasons(diff: Column, most_files: int = 2, most_chars: int = 2200) -> Column:
    """Why a diff would be turned down: empty, no_source, too_many_files, too_long."""
    return F.array_compact(F.array(
        F.when(F.coalesce(F.trim(diff), F.lit("")) == "", "empty"),
        F.when(F.size(source_paths(diff)) == 0, "no_source"),
        F.when(file_count(diff) > most_files, "too_many_files"),
        F.when(F.length(diff) > most_chars, "too_long"),
    ))


def _reverse(diff: str | None) -> str | None:
    if diff is None:
        return None
    out, minus, plus, old = [], [], [], ""

    def settle() -> None:
        out.extend("-" + x[1:] for x in plus)
        out.extend("+" + x[1:] for x in minus)
        plus.clear()
        minus.clear()

    for line in diff.split("\n"):
        if line.startswith("--- "):
            settle()
            old = line[4:]
        elif line.startswith("+++ "):
            swap = lambda p, a, b: b + p[2:] if p.startswith(a) else p
            out += ["--- " + swap(line[4:], "b/", "a/"), "+++ " + swap(old, "a/", "b/")]
        elif line.startswith("index ") and ".." in line:
            settle()
            ids, *rest = line[6:].split(" ")
            out.append(" ".join(["index", "..".join(reversed(ids.split("..", 1))), *rest]))
        elif line.startswith("@@ "):
            settle()
            left, right, *rest = line[3:].split(" ", 2)
            out.append("@@ -" + right[1:] + " +" + left[1:] + (" " + rest[0] if rest else ""))
        elif line.startswith("-"):
            minus.append(line)
        elif line.startswith("+"):
            plus.append(line)
        else:
            settle()
            out.append(line)
    settle()
    return "\n".join(out)


def reverse(diff: Column) -> Column:
    """The diff that undoes a diff; blocks of removed and added lines change places."""
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(_reverse, na_action="ignore")

    return F.pandas_udf(run, "string")(diff)
