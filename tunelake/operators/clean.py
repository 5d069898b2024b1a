"""Landing -> formatted cleaning (cast projections, null handling, dates).

All steps are narrow transformations: they compile into one scan + project +
filter stage with the not-null filters pushed into the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.functions.casts import lenient_cast, parse_date
from tunelake.functions.text import normalise_country, normalise_name


def project_cast(df: DataFrame, spec: Iterable[S.ColumnSpec], lenient: bool = True) -> DataFrame:
    """Select, rename and type columns as the spec says (PRJ1-PRJ4, PRJ9).

    ``lenient`` casts give NULL for bad values instead of failing the job.
    """
    cols = []
    for s in spec:
        c = df[s.source]  # bracket access copes with names such as "Unnamed: 0"
        if s.dtype is not None:
            c = lenient_cast(c, s.dtype) if lenient else c.cast(s.dtype)
        cols.append(c.alias(s.target))
    return df.select(*cols)


def not_null(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_nulls(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is set (FLT1); pushed to the scan."""
    cols = list(cols)
    return df.filter(not_null(cols)) if cols else df


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``na.fill`` restricted to present columns (FIL1); a column whose type
    does not fit its value is left alone, as ``na.fill`` does."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.na.fill(present) if present else df


def parse_dates(df: DataFrame, cols: Iterable[str], fmt: str = S.DATE_FORMAT) -> DataFrame:
    """Parse text dates; partial or malformed dates become NULL (FN8)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: parse_date(c, fmt) for c in present}) if present else df


def add_date_parts(df: DataFrame, date_col: str = "snapshot_date", prefix: str = "snapshot") -> DataFrame:
    """Year, month and day of month as int columns (FN9)."""
    d = F.col(date_col)
    return df.withColumns({
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_day": F.dayofmonth(d),
    })


def normalise_columns(df: DataFrame, cols: Iterable[str], how: str) -> DataFrame:
    """``how`` is ``trim``, ``lower_trim`` or ``country``."""
    fn = {"trim": lambda c: F.trim(F.col(c)),
          "lower_trim": normalise_name,
          "country": normalise_country}[how]
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: fn(c) for c in present}) if present else df


def format_tracks(raw: DataFrame, spec: list[S.ColumnSpec] = S.TRACKS_SPEC,
                  required: Iterable[str] = ("track_id", "track_name"),
                  lower_names: bool = False,
                  name_cols: Iterable[str] = ("track_name", "artist_name"),
                  fold_names: bool = False) -> DataFrame:
    """JOB1: cast projection, optional name normalisation, required columns.

    ``required=()`` keeps rows with null keys (the notebook variant), and
    ``lower_names=True`` gives the strict variant's lower-cased, trimmed names.
    ``fold_names=True`` also removes accents from the names (UDF1), the
    step the strict variant intends but never applies (off by default).
    """
    df = project_cast(raw, spec)
    name_cols = [c for c in name_cols if c in df.columns]
    if lower_names:
        df = normalise_columns(df, name_cols, "lower_trim")
    if fold_names and name_cols:
        from tunelake.functions.text import fold_accents
        df = df.withColumns({c: fold_accents(c) for c in name_cols})
    return drop_nulls(df, required)


def format_charts(raw: DataFrame, spec: list[S.ColumnSpec] = S.CHARTS_SPEC,
                  fill: Mapping[str, object] | None = S.CHARTS_FILL,
                  date_cols: Iterable[str] = S.CHARTS_DATE_COLUMNS,
                  date_col: str = "snapshot_date",
                  country_col: str | None = "country",
                  required: Iterable[str] = ("track_name",),
                  date_format: str = S.DATE_FORMAT) -> DataFrame:
    """JOB2: cast projection, null fill (before date parsing), date parsing,
    date parts, country normalisation, required columns.

    ``fill=None`` and ``country_col=None`` give the strict variant.
    """
    df = project_cast(raw, spec)
    if fill:
        df = fill_nulls(df, fill)
    df = parse_dates(df, date_cols, date_format)
    if date_col in df.columns:
        df = add_date_parts(df, date_col)
    if country_col:
        df = normalise_columns(df, [country_col], "country")
    return drop_nulls(df, required)


def format_lyrics(raw: DataFrame, spec: list[S.ColumnSpec] = S.LYRICS_TEXT_SPEC,
                  trim_cols: Iterable[str] = ("artist_name", "track_name"),
                  required: Iterable[str] = ("song_id", "track_name")) -> DataFrame:
    """JOB3: cast projection, space trim of names, required columns."""
    df = project_cast(raw, spec)
    df = normalise_columns(df, trim_cols, "trim")
    return drop_nulls(df, required)
