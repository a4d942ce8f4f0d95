"""Text measures, clean-ups and checks of prompts and model answers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.coerce import strip

# What is counted in prompts.
URL = r"https?://[^\s)]+"
FENCE = r"```"
CHECKBOX = r"(?m)^\s*[-*] \[[ xX]\]"
FILE_HINT = r"\b[A-Za-z0-9_./-]+\.(py|js|ts|go|rs|java|c|cpp|h|rb|php)\b"
SIGNATURE = r"\b(def|func|function|class|interface|fn)\s+[A-Za-z_]\w*"


def counts(text: Column) -> dict[str, Column]:
    """Occurrences of urls, fence pairs, checkboxes, file hints and signatures."""
    n = lambda p: F.regexp_count(text, F.lit(p))
    return {"n_urls": n(URL), "n_fences": F.floor(n(FENCE) / 2).cast("int"), "n_checkboxes": n(CHECKBOX), "n_file_hints": n(FILE_HINT), "n_signatures": n(SIGNATURE)}


def collapse(text: Column) -> Column:
    """Unix line ends, single blanks, no more than one empty line, nothing at the ends."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(out, "[ \t]+", " ")
    return strip(F.regexp_replace(out, "\n{3,}", "\n\n"))


def normalize_unicode(text: Column, form: str = "NFKC") -> Column:
    """A Unicode normal form; Spark has no built-in one."""
    def run(batch: pd.Series) -> pd.Series:
        return batch.str.normalize(form)

    return F.pandas_udf(run, "string")(text)


def problem_key(text: Column) -> Column:
    """The join key of problem statements: normal form, lower case, white space as single blanks."""
    return F.trim(F.regexp_replace(F.lower(normalize_unicode(text)), r"(?U)\s+", " "))


def tidy_prompt(text: Column) -> Column:
    """A prompt without checkbox lines, leading plus signs, urls and the empty parentheses they leave."""
    out = F.regexp_replace(text, r"(?m)^\s*[-*] \[[ xX]\][^\n]*\n?", "")
    out = F.regexp_replace(out, r"(?m)^\+", "")
    out = F.regexp_replace(F.regexp_replace(out, URL, ""), r"\(\s*\)", "")
    return F.trim(out)


def without_section(text: Column, title: str) -> Column:
    """The text without a markdown section of this title, up to the next heading."""
    return F.regexp_replace(text, rf"(?ims)^#+\s*{title}\b.*?(?=^#|\z)", "")


def last_fence(text: Column, language: str = "python") -> Column:
    """The last fenced block of a language, or the whole text."""
    found = F.regexp_extract_all(text, F.lit(rf"(?s)```{language}\s*\n(.*?)```"), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1)).otherwise(text)


def only_fenced_command(text: Column) -> Column:
    """The first fenced shell block if it holds a single line, else null."""
    body = F.trim(F.regexp_extract(text, r"(?s)```(?:bash|sh|shell|console)?\s*\n(.*?)```", 1))
    return F.when((body != "") & ~body.contains("\n"), body)


def task_text(text: Column) -> Column:
    """The text inside the first of the known tags, else after a marker, else all of it."""
    tagged = [F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1) for tag in ("task", "issue", "pr_description", "problem_statement")]
    marked = [F.regexp_extract(text, rf"(?s){mark}\s*(.*)", 1) for mark in ("Task:", "Issue:", "Problem:")]
    return F.trim(F.coalesce(*(F.nullif(F.trim(x), F.lit("")) for x in [*tagged, *marked]), text))


def observation(text: Column, limit: int = 10_000) -> Column:
    """A tool's output in tags; long ones keep head and tail and say how much went."""
    code = F.coalesce(F.nullif(F.regexp_extract(text, r"<returncode>(-?\d+)</returncode>", 1), F.lit("")), F.lit("0"))
    body = F.regexp_extract(text, r"(?s)<output>\n?(.*?)</output>", 1)
    body = F.when(text.contains("<output>"), body).otherwise(text)
    half = limit // 2
    short = F.concat(F.lit("<output>\n"), body, F.lit("</output>"))
    gone = (F.length(body) - limit).cast("string")
    long = F.concat(F.lit("<output_head>\n"), F.left(body, F.lit(half)), F.lit("\n</output_head>\n<elided_chars>\n"), gone, F.lit(" characters elided\n</elided_chars>\n<output_tail>\n"), F.right(body, F.lit(half)), F.lit("\n</output_tail>"))
    return F.concat(F.lit("<returncode>"), code, F.lit("</returncode>\n"), F.when(F.length(body) < limit, short).otherwise(long))


def public_symbols(text: Column) -> Column:
    """Names that definitions introduce, without those that start with an underscore, in order, once each."""
    names = F.regexp_extract_all(text, F.lit(r"\b(?:def|class|func|function|fn|interface)\s+([A-Za-z_]\w*)"), 1)
    return F.array_distinct(F.filter(names, lambda x: ~x.startswith("_")))


def quoted_literals(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"`([^`\n]{2,80})`"), 1))


def estimated_tokens(length: Column, *given: Column, ratio: float = 4.0) -> Column:
    """The first positive given count, else characters over a ratio, rounded half to even."""
    return F.coalesce(*(F.when(c > 0, c.cast("long")) for c in given), F.bround(length / F.lit(ratio)).cast("long"))


def lenient_json(text: Column, schema: str) -> Column:
    """Parsed only where the text starts like an object or a list; bad JSON is null."""
    return F.when(text.rlike(r"^\s*[\[{]"), F.from_json(text, schema))
