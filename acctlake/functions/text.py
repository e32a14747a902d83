"""Text expressions shared by the dataset layout, the mapping and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shown to report readers.
NO_JOB_NAME = "(no job name)"
NO_PROGRAM = "(none)"


def sanitize(name: Column) -> Column:
    """A name safe for a directory: other characters become ``_``, nothing becomes ``UNKNOWN``."""
    given = F.when(F.coalesce(name, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(name)
    return F.regexp_replace(given, "[^A-Za-z0-9]", "_")


def label(name: Column, when_empty: str) -> Column:
    """The name, or a text to show where it is empty or missing."""
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(when_empty))


def job_label(name: str = "job_name") -> Column:
    return label(F.col(name), NO_JOB_NAME)


def program_label(name: str = "program_name") -> Column:
    return label(F.col(name), NO_PROGRAM)


def glob_match(name: Column, pattern: Column) -> Column:
    """Whether a name matches a user pattern: ``*`` stands for anything.

    ``%`` and ``_`` in a pattern keep their LIKE meaning. The escape character is one that no
    pattern can hold, so a backslash is an ordinary character.
    """
    return F.like(name, F.replace(pattern, F.lit("*"), F.lit("%")), F.lit("\x01"))


def date_parts(date: Column) -> dict[str, Column]:
    """Year and month as directory text, and the two written forms of a day."""
    year = F.year(date)
    # Formatting a date takes many times as long as its number; only other years need it.
    plain = F.when(year.between(1, 9999), F.lpad(year.cast("string"), 4, "0"))
    return {
        "year": F.coalesce(plain, F.date_format(date, "yyyy")),
        "month": F.lpad(F.month(date).cast("string"), 2, "0"),
        "day_text": F.date_format(date, "yyyyMMdd"),
        "iso_text": F.date_format(date, "yyyy-MM-dd"),
    }
