"""Scalar text / parse helpers, all built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ``trim`` only removes spaces; the published rule strips every character
# Python's ``str.strip()`` treats as whitespace. The set is derived from that
# rule (29 code points, including U+001C..U+001F which Java's ``\s`` lacks).
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
_NUMBER = r"(?i)^[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf(inity)?)$"
_ISO_DATE_PREFIX = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading/trailing whitespace (Unicode aware); null stays null."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def norm(c: str | Column) -> Column:
    """strip + lower-case: the key form used for result and type lookups."""
    return F.lower(strip(c))


def safe_timestamp(c: str | Column) -> Column:
    """ISO text -> TIMESTAMP_NTZ; anything unparseable becomes null.

    The prefix guard keeps partial values such as ``'2024'`` (which a plain
    cast would read as 2024-01-01) and time-only text out.
    """
    s = strip(c)
    return F.when(s.rlike(_ISO_DATE_PREFIX), s.try_cast("timestamp_ntz"))


def safe_double(c: str | Column) -> Column:
    """Text -> double, unparseable -> null (never raises under ANSI mode).

    Only plain decimal spellings count: a cast alone would also read type
    suffixes (``41.5d``), hexadecimal floats and ``nan``.
    """
    s = strip(c)
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def contains_regex(c: str | Column, pattern: str) -> Column:
    """Regex containment on the lower-cased column; null text never matches."""
    return F.coalesce(F.lower(col_(c)).rlike(pattern), F.lit(False))


def contains_literal(c: str | Column, term: str) -> Column:
    """Literal substring containment on the lower-cased column."""
    return F.coalesce(F.contains(F.lower(col_(c)), F.lit(term)), F.lit(False))
