"""Column specs of the three datasets and their zones.

A spec is a list of ``(source_column, target_column, target_type)``; a
``None`` type keeps whatever type the reader produced. Formatters are driven
by these specs, so the same cleaning code runs on any table once a spec maps
its columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class ColumnSpec(NamedTuple):
    source: str
    target: str
    dtype: str | None = None


# ---------------------------------------------------------------------------
# Dataset column names and types that results must keep
# (landing names -> formatted names -> type).
# ---------------------------------------------------------------------------

TRACKS_SPEC = [
    ColumnSpec("track_id", "track_id"),
    ColumnSpec("track_name", "track_name"),
    ColumnSpec("artists", "artist_name"),
    ColumnSpec("album_name", "album_name"),
    ColumnSpec("popularity", "popularity", "int"),
    ColumnSpec("duration_ms", "duration_ms", "bigint"),
    ColumnSpec("explicit", "explicit", "boolean"),
    ColumnSpec("danceability", "danceability", "double"),
    ColumnSpec("energy", "energy", "double"),
    ColumnSpec("key", "key", "int"),
    ColumnSpec("loudness", "loudness", "double"),
    ColumnSpec("mode", "mode", "int"),
    ColumnSpec("speechiness", "speechiness", "double"),
    ColumnSpec("acousticness", "acousticness", "double"),
    ColumnSpec("instrumentalness", "instrumentalness", "double"),
    ColumnSpec("liveness", "liveness", "double"),
    ColumnSpec("valence", "valence", "double"),
    ColumnSpec("tempo", "tempo", "double"),
]

CHARTS_SPEC = [
    ColumnSpec("spotify_id", "spotify_id"),
    ColumnSpec("name", "track_name"),
    ColumnSpec("artists", "artist_name"),
    ColumnSpec("daily_rank", "daily_rank", "int"),
    ColumnSpec("daily_movement", "daily_movement"),
    ColumnSpec("weekly_movement", "weekly_movement"),
    ColumnSpec("country", "country"),
    ColumnSpec("snapshot_date", "snapshot_date"),
    ColumnSpec("popularity", "popularity", "int"),
    ColumnSpec("is_explicit", "is_explicit"),
    ColumnSpec("duration_ms", "duration_ms", "bigint"),
    ColumnSpec("album_name", "album_name"),
    ColumnSpec("album_release_date", "album_release_date"),
    ColumnSpec("danceability", "danceability"),
    ColumnSpec("energy", "energy"),
    ColumnSpec("key", "key"),
    ColumnSpec("loudness", "loudness"),
    ColumnSpec("mode", "mode"),
    ColumnSpec("speechiness", "speechiness"),
    ColumnSpec("acousticness", "acousticness", "double"),
    ColumnSpec("instrumentalness", "instrumentalness", "double"),
    ColumnSpec("liveness", "liveness", "double"),
    ColumnSpec("valence", "valence", "double"),
    ColumnSpec("tempo", "tempo", "double"),
    ColumnSpec("time_signature", "time_signature", "double"),
]

# Null replacements applied to formatted charts before date parsing.
CHARTS_FILL = {
    "daily_rank": 0,
    "popularity": 0,
    "duration_ms": 0,
    "acousticness": 0.0,
    "instrumentalness": 0.0,
    "liveness": 0.0,
    "valence": 0.0,
    "tempo": 0.0,
    "time_signature": 0.0,
}
CHARTS_DATE_COLUMNS = ["snapshot_date", "album_release_date"]
DATE_FORMAT = "yyyy-MM-dd"

# Lyrics, text form (landing index column is literally "Unnamed: 0").
LYRICS_TEXT_SPEC = [
    ColumnSpec("Unnamed: 0", "song_id", "int"),
    ColumnSpec("artist", "artist_name"),
    ColumnSpec("song_name", "track_name"),
    ColumnSpec("lyrics", "song_lyrics"),
]

# Lyrics, URL form.
LYRICS_URL_SPEC = [
    ColumnSpec("song_id", "song_id", "int"),
    ColumnSpec("singer_name", "artist_name"),
    ColumnSpec("song_name", "track_name"),
    ColumnSpec("song_href", "song_url"),
]

AUDIO_FEATURES = [
    "danceability", "energy", "loudness", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
]

# Trusted-zone projections.
TRUSTED_TRACKS_COLUMNS = [s.target for s in TRACKS_SPEC]
TRUSTED_CHARTS_COLUMNS = [
    "spotify_id", "track_name", "artist_name", "daily_rank", "country",
    "snapshot_date", "popularity", "duration_ms", "danceability", "energy",
    "acousticness", "valence", "tempo",
]
TRUSTED_LYRICS_COLUMNS = ["song_id", "artist_name", "track_name", "song_lyrics"]
VISUALISATION_COLUMNS = ["track_name", "artist_name", "daily_rank", "snapshot_date", "country"]

MIN_DURATION_MS = 30000
MIN_TRACKS_PER_ARTIST = 5
TOP_N = 10
TOP_RANKS_PER_COUNTRY = 5
CHART_SLOTS = 15
LYRICS_ARTIST_SUFFIX = " Lyrics"
SPLIT_SEED = 42
SPLIT_FRACTIONS = (0.70, 0.15, 0.15)
# ---------------------------------------------------------------------------


def raw_string_schema(spec: list[ColumnSpec]) -> T.StructType:
    """All-string landing schema for a spec (no inference pass over the data)."""
    return T.StructType([T.StructField(s.source, T.StringType(), True) for s in spec])


# Analysis results read back by the charts (declared, not inferred).
TOP_ARTISTS_SCHEMA = T.StructType([
    T.StructField("artist_name", T.StringType(), True),
    T.StructField("avg_popularity", T.DoubleType(), True),
    T.StructField("track_count", T.LongType(), True),
])
