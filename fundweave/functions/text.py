"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns the results depend on.
TAG_PATTERN = r"<[^>]+>"
SENTENCE_END = r"[.!?:;…]$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def short_id(c: Column) -> Column:
    """Last path segment of a URL-like identifier; NULL when that segment is empty."""
    return blank_to_null(F.split_part(F.trim(c), F.lit("/"), F.lit(-1)))


def clean_text(c: Column) -> Column:
    """Markup tags and whitespace runs become one space; NULL when nothing is left."""
    untagged = F.regexp_replace(c, TAG_PATTERN, " ")
    return blank_to_null(F.trim(F.regexp_replace(untagged, r"\s+", " ")))


def trimmed(c: Column) -> Column:
    return blank_to_null(F.trim(c))


def lower_code(c: Column) -> Column:
    return trimmed(F.lower(c))


def upper_code(c: Column) -> Column:
    return trimmed(F.upper(c))


def has_markup(c: Column) -> Column:
    return c.rlike("(?s)" + TAG_PATTERN)


def join_text(title: Column, body: Column) -> Column:
    """One text out of a title and a body, with a full stop between them only where it is missing.

    concat_ws skips NULLs, so a missing side needs no case of its own.
    """
    t, b = trimmed(title), trimmed(body)
    head = F.when(b.isNotNull() & ~t.rlike(SENTENCE_END), F.concat(t, F.lit("."))).otherwise(t)
    return blank_to_null(F.concat_ws(" ", head, b))
