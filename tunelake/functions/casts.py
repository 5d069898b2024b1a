"""Null-safe casts.

Casting runs with ANSI semantics in Spark 4, where a bad value raises. The
cleaning stage needs the permissive behaviour (bad value -> NULL), and for
integral targets the truncation of decimal text (``'3.7' -> 3``) that the
non-ANSI cast had.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}

# Decimal text whose integral part an integral cast keeps: "3.7", "-2.", " 12.50 ".
DECIMAL_TEXT = r"^\s*([+-]?\d+)\.\d*\s*$"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


ISO_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def lenient_cast(c: Column | str, dtype: str) -> Column:
    """Cast that yields NULL for bad input; integral targets truncate decimal text.

    The plain cast runs first; only values it rejects are matched against
    the decimal-text pattern (``coalesce`` stops at the first non-NULL), so
    well-formed numbers never reach the regex.
    """
    c = _as_col(c)
    if dtype.lower() in _INTEGRAL:
        return F.coalesce(c.try_cast(dtype), F.regexp_extract(c, DECIMAL_TEXT, 1).try_cast(dtype))
    return c.try_cast(dtype)


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """``to_date`` that gives NULL for partial or malformed dates.

    Pattern-based parsing reports a failure by exception, which is slow when
    many values are bad. So for the ISO pattern, text that is exactly
    ``dddd-dd-dd`` goes through the (exception-free) date cast, and only
    other text that contains every literal separator of the pattern is handed
    to the pattern parser; text without them cannot match the pattern.
    """
    c = _as_col(c)
    separators = sorted({ch for ch in fmt if not ch.isalpha() and ch != "'"})
    parseable = F.lit(True)
    for sep in separators:
        parseable = parseable & c.contains(sep)
    by_pattern = F.when(parseable, F.try_to_date(c, fmt))
    if fmt == "yyyy-MM-dd":
        iso = c.rlike(ISO_DATE_TEXT)
        return F.when(iso, c.try_cast("date")).otherwise(by_pattern)
    return by_pattern
