"""Exploitation sets: classifier input, visualisation export, chart history
and new entries (JOB12-JOB14, WIN5, WIN6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.functions.text import normalise_name, remove_literal, song_key, strip_special
from tunelake.operators.copies import fold, unfold
from tunelake.operators.quality import keep_first


def explicit_prediction(lyrics: DataFrame, tracks: DataFrame,
                        on: Sequence[tuple[str, str]] = (("artist_name", "artist_name"),
                                                         ("song_name", "track_name")),
                        text_col: str = "song_lyrics", label_col: str = "explicit",
                        artist_col: str | None = "artist_name",
                        artist_suffix: str | None = S.LYRICS_ARTIST_SUFFIX,
                        normalise_keys: bool = False) -> DataFrame:
    """JOB12 (JN2 + JN3): join lyrics to tracks and keep ``(text, label)``.

    Every occurrence of ``artist_suffix`` is removed from the lyrics' artist
    column when that column exists. ``normalise_keys=True`` lower-cases and
    trims the string keys on both sides, so a lower-cased track table still
    matches lyrics keys.

    Tracks give the output their label only, so equal (keys, label) are folded
    before the join and the matches unfolded after it: the join grows with the
    tables, and the rows of an m:n match are made by all tasks.
    """
    if artist_col and artist_suffix and artist_col in lyrics.columns:
        lyrics = lyrics.withColumn(artist_col, remove_literal(artist_col, artist_suffix))
    l_keys = [lk for lk, _ in on]
    r_keys = [rk for _, rk in on]
    l = lyrics.select(*[F.col(k).alias(f"__l{i}") for i, k in enumerate(l_keys)], F.col(text_col))
    r = tracks.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(r_keys)], F.col(label_col))
    if normalise_keys:
        l = l.withColumns({f"__l{i}": normalise_name(f"__l{i}") for i, k in enumerate(l_keys)
                           if dict(lyrics.dtypes)[k] == "string"})
        r = r.withColumns({f"__r{i}": normalise_name(f"__r{i}") for i, k in enumerate(r_keys)
                           if dict(tracks.dtypes)[k] == "string"})
    r = fold(r)
    cond = None
    for i in range(len(on)):
        term = l[f"__l{i}"] == r[f"__r{i}"]
        cond = term if cond is None else cond & term
    return unfold(l.join(r, cond, "inner").select(l[text_col], r[label_col], r["__copies"]))


def visualisation_set(df: DataFrame, columns: Sequence[str] = S.VISUALISATION_COLUMNS) -> DataFrame:
    """JOB13 (PRJ6): the chart columns the history view needs."""
    return df.select(*columns)


def chart_history(df: DataFrame, country, start, end, slots: int = S.CHART_SLOTS,
                  country_col: str = "country", date_col: str = "snapshot_date",
                  rank_col: str = "daily_rank", title_col: str = "track_name",
                  artist_col: str = "artist_name") -> DataFrame:
    """JOB14: a dense (date x position) history of one country's top slots.

    Rows of ``country`` with ``start <= date <= end`` and ``rank <= slots``
    (all three pushed into the scan) are cleaned of special characters, keyed
    as ``"<title> - <artist>"`` and scored ``slots + 1 - rank``; duplicates of
    a (date, rank) keep the first by title and artist. Every date present is
    expanded to positions ``1..slots`` and left-joined with them; each slot
    gets its song's first date inside the range and ``is_new`` when that
    date is its own. Empty slots carry ``song_id = ''`` and ``rank_value = 0``.

    The input is bounded by dates x slots after the dedup, so the two small
    sides join without a broadcast hint (AQE broadcasts at run time).
    """
    rows = (df.filter((F.col(country_col) == F.lit(country))
                      & F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
                      & (F.col(rank_col) <= slots))
              .select(F.col(date_col).alias("snapshot_date"),
                      F.col(rank_col).cast("int").alias("position"),
                      strip_special(title_col).alias("track_name"),
                      strip_special(artist_col).alias("artist_name"),
                      F.col(country_col).alias("country")))
    rows = rows.withColumns({
        "song_id": song_key("track_name", "artist_name"),
        "rank_value": (F.lit(slots + 1) - F.col("position")).cast("int"),
    })
    slots_taken = keep_first(rows, ["snapshot_date", "position"], ["track_name", "artist_name"])
    # Every filtered date keeps at least one row through the dedup, so the
    # grid's dates come from the deduplicated rows (one scan feeds both).
    grid = (slots_taken.select("snapshot_date").distinct()
                       .withColumn("position", F.explode(F.sequence(F.lit(1), F.lit(slots)))))
    complete = grid.join(slots_taken, ["snapshot_date", "position"], "left")
    first = F.min("snapshot_date").over(Window.partitionBy("song_id"))
    complete = complete.withColumn(
        "first_appearance", F.when(F.col("song_id").isNotNull(), first))
    complete = complete.withColumn(
        "is_new", F.coalesce(F.col("snapshot_date") == F.col("first_appearance"), F.lit(False)))
    return (complete.na.fill({"song_id": "", "rank_value": 0})
                    .select("snapshot_date", "position", "track_name", "artist_name", "country",
                            "song_id", "rank_value", "first_appearance", "is_new")
                    .orderBy("snapshot_date", "position"))


def new_entries(df: DataFrame, date_col: str = "snapshot_date", song_col: str = "song_id") -> DataFrame:
    """WIN6: songs present in a snapshot but not in the previous snapshot.

    The first snapshot flags nothing. Dates are numbered over the distinct
    dates (one row per calendar day, so that window is bounded by the day
    count, not the data). A song is new on a date when its own previous date
    is not the one before: one ``lag`` per song, which has at most one row a
    day.
    """
    present = (df.filter(F.col(song_col).isNotNull() & (F.col(song_col).cast("string") != ""))
                 .select(F.col(date_col).alias("snapshot_date"), F.col(song_col).alias("song_id"))
                 .distinct())
    in_order = Window.orderBy("snapshot_date")
    dates = (df.filter(F.col(song_col).isNotNull() & (F.col(song_col).cast("string") != ""))
               .select(F.col(date_col).alias("snapshot_date")).distinct()
               .select("snapshot_date", F.lag("snapshot_date").over(in_order).alias("prev_date"),
                       F.row_number().over(in_order).alias("__nth")))
    by_song = Window.partitionBy("song_id").orderBy("__nth")
    return (present.join(dates, "snapshot_date")
                   .withColumn("__last", F.lag("__nth").over(by_song))
                   .filter(F.col("prev_date").isNotNull()
                           & (F.col("__last").isNull() | (F.col("__last") < F.col("__nth") - 1)))
                   .select("snapshot_date", "song_id", "prev_date"))
