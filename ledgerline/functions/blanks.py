"""What counts as blank. Six predicates that differ on purpose; see the docstrings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that a completion score takes for missing.
MISSING_WORDS = ("", "nan", "none", "null", "no_secondary_evidence")
#: Texts that mean true.
TRUE_WORDS = ("true", "1", "yes", "y", "registered")


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (trim() takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def existing(c: Column) -> Column:
    """Stripped text, null as ''."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def is_filled(c: Column) -> Column:
    """Neither blank nor a word for missing."""
    return ~F.lower(existing(c)).isin(*MISSING_WORDS)


def is_blank(c: Column) -> Column:
    return existing(c) == ""


def cell_text(c: Column) -> Column:
    """Stripped text; null and 'nan' as ''."""
    t = existing(c)
    return F.when(F.lower(t) == "nan", F.lit("")).otherwise(t)


def truth(c: Column) -> Column:
    """True for the words that mean true, false for everything else."""
    return F.lower(existing(c)).isin(*TRUE_WORDS)


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), strip(c))
