"""String normalisation helpers (all JVM-side except ``fold_accents``)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.
# Characters kept by the special-character strip: letters, numbers,
# underscore, whitespace, hyphen and parentheses, with Unicode meaning
# (Python's ``[^\w\s\-()]`` on str). The whitespace set is Python's
# ``str.isspace`` set, spelled out so that Java regex and RE2 agree:
#   \t \n \x0B \f \r \x1C-\x1F space U+0085 U+00A0 U+1680 U+2000-U+200A
#   U+2028 U+2029 U+202F U+205F U+3000
# ---------------------------------------------------------------------------
UNICODE_SPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPECIAL_CHARS_PATTERN = r"[^\p{L}\p{N}_" + UNICODE_SPACE_CLASS + r"\-()]"
ASCII_SPACE_RUN = r"\s+"
SONG_KEY_SEPARATOR = " - "
# ---------------------------------------------------------------------------


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze_spaces(c: Column | str) -> Column:
    """Collapse each run of whitespace to one space."""
    return F.regexp_replace(_as_col(c), ASCII_SPACE_RUN, " ")


def normalise_country(c: Column | str) -> Column:
    """``upper(trim(squeeze(c)))``; ``trim`` removes spaces only."""
    return F.upper(F.trim(squeeze_spaces(c)))


def normalise_name(c: Column | str) -> Column:
    """Case- and padding-insensitive name key: ``lower(trim(c))``."""
    return F.lower(F.trim(_as_col(c)))


def remove_literal(c: Column | str, literal: str) -> Column:
    """Remove every occurrence of ``literal`` (not anchored, not a regex)."""
    return F.replace(_as_col(c), F.lit(literal), F.lit(""))


def strip_special(c: Column | str) -> Column:
    """Drop special characters; NULL becomes the empty string."""
    return F.coalesce(F.regexp_replace(_as_col(c), SPECIAL_CHARS_PATTERN, ""), F.lit(""))


def song_key(title: Column | str, artist: Column | str) -> Column:
    """``"<title> - <artist>"``."""
    return F.concat(_as_col(title), F.lit(SONG_KEY_SEPARATOR), _as_col(artist))


def _fold(texts: pa.Array) -> pa.Array:
    """Whole Arrow arrays at a time; the imports travel with the function, so
    executors need pyarrow, not this package."""
    import pyarrow.compute as pc
    return pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFD"), pattern=r"\p{M}+", replacement="")


def fold_accents(c: Column | str) -> Column:
    """Canonical decomposition with combining marks removed (``é -> e``).

    An Arrow UDF over whole columns: Spark SQL has no Unicode normaliser.
    """
    return F.arrow_udf(_fold, T.StringType())(_as_col(c))
