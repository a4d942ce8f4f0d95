"""Coercions with the rules that differ between gates: truth, numbers, first present value, blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that count as true, by rule. They differ on purpose; see TRIMMED.
TRUE_WORDS = {
    "signal": ("1", "true", "yes", "y", "passed", "pass"),
    "record": ("1", "true", "yes", "passed"),
    "selection": ("1", "true", "yes", "passed", "submitted"),
    "gate": ("1", "true", "yes", "y"),
    "audit": ("1", "true", "yes", "passed", "pass"),
}
#: Rules that strip white space around the string first.
TRIMMED = {"signal", "selection", "gate", "audit"}

#: White space that Python's strip removes, as a character class; Spark's trim removes spaces only.
SPACE = r"[\s\x1c-\x1f\x85   -     　]"


def strip(col: Column) -> Column:
    """The text without any Unicode white space at its ends."""
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def strip_spaces(col: Column) -> Column:
    """The text without Unicode spaces at its ends; line ends and tabs stay, as in SQL's trim."""
    return F.regexp_replace(col, r"^\p{Zs}+|\p{Zs}+\z", "")


def truthy(col: Column, rule: str = "signal") -> Column:
    """Whether a string means true under a named rule; null means false."""
    text = F.lower(strip(col) if rule in TRIMMED else col)
    return F.coalesce(text.isin(*TRUE_WORDS[rule]), F.lit(False))


def python_truth(col: Column) -> Column:
    """Whether a string is not empty: "false" is true here."""
    return F.coalesce(col != "", F.lit(False))


def number(col: Column, default: float | int | None = None, kind: str = "double") -> Column:
    """A number from text, or the default where there is none."""
    value = strip(col).try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_present(*cols: Column) -> Column:
    """The first value that is neither null nor the empty string."""
    return F.coalesce(*(blank_to_null(c) for c in cols))


def labelled(col: Column, default: str) -> Column:
    """A counter's label: the default where the value is null or blank."""
    return F.coalesce(blank_to_null(strip(col)), F.lit(default))


def half_even(col: Column, digits: int = 0) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(col, digits)


def truncate_middle(col: Column, limit: int, mark: str = "\n...\n") -> Column:
    """The text, or its head and tail around a mark if it is longer than the limit."""
    half = limit // 2
    return F.when(F.length(col) <= limit, col).otherwise(F.concat(F.left(col, F.lit(half)), F.lit(mark), F.right(col, F.lit(limit - half))))


def slug(col: Column) -> Column:
    """Lower case, runs of other characters than letters and digits as one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def stable_unit(*cols: Column, sep: str = ":") -> Column:
    """A repeatable number in [0, 1): the first 8 bytes of a SHA-256 over the joined values."""
    prefix = F.substring(F.sha2(F.concat_ws(sep, *cols), 256), 1, 16)
    return F.conv(prefix, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def stable_id(*cols: Column) -> Column:
    """An id from the SHA-256 of the values, one a line."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(c, F.lit("")) for c in cols)), 256)


def safe_tsv(col: Column) -> Column:
    """Tabs and line ends become spaces."""
    return F.translate(col, "\t\n\r", "   ")
