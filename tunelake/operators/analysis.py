"""Analyses over formatted/trusted tables (JOB7-JOB11).

Aggregates are declarative ``groupBy().agg()`` calls: Spark runs a partial
aggregate in every map task before the shuffle, so a hot artist or country
is pre-reduced. Top-k results use ``orderBy().limit()``, which plans as
``TakeOrderedAndProject`` (k rows per task, then a k-way merge). Every
ordering carries a tie-break so top-k and dedup results are deterministic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.operators.copies import fold, unfold
from tunelake.session import ensure_checkpoint_dir


def _asc(c: str) -> Column:
    return F.col(c).asc_nulls_first()


def artist_popularity(df: DataFrame, group: str = "artist_name", measure: str = "popularity",
                      id_col: str | None = "track_id", min_count: int = S.MIN_TRACKS_PER_ARTIST,
                      digits: int = 2, avg_name: str = "avg_popularity",
                      count_name: str = "track_count") -> DataFrame:
    """AGG1/FLT3/TOP1: rounded mean and count per group, groups with at least
    ``min_count`` rows, highest mean first."""
    counted = F.count(id_col) if id_col else F.count(F.lit(1))
    return (df.groupBy(group)
              .agg(F.round(F.avg(measure), digits).alias(avg_name), counted.alias(count_name))
              .filter(F.col(count_name) >= min_count)
              .orderBy(F.desc(avg_name), _asc(group)))


def entries_by(df: DataFrame, group: str, distinct_col: str, entries_name: str,
               distinct_name: str, top: int | None = S.TOP_N, approx: bool = False,
               weight_col: str | None = None) -> DataFrame:
    """AGG2/AGG3/TOP2: row count and distinct count per group, largest first.

    ``weight_col`` lets a caller pre-aggregate rows (e.g. per join key,
    before a join) and pass the row counts; entries are then their sum.
    ``approx=True`` swaps the exact distinct count for HyperLogLog, which
    merges map-side even when one group holds most distinct values.
    """
    distinct = F.approx_count_distinct(distinct_col) if approx else F.countDistinct(distinct_col)
    entries = F.sum(weight_col).cast("bigint") if weight_col else F.count(F.lit(1))
    agg = df.groupBy(group).agg(entries.alias(entries_name), distinct.alias(distinct_name))
    ordered = agg.orderBy(F.desc(entries_name), _asc(group))
    return ordered.limit(top) if top else ordered


def pre_aggregate(df: DataFrame, keys: Sequence[str], weight_name: str = "__rows") -> DataFrame:
    """Rows per key combination, as a ``weight`` column for ``entries_by``.

    Use it when ``keys`` are exactly the join keys of a following join: the
    aggregate is then hash-partitioned on the join keys, the sort-merge join
    reuses that partitioning, and it joins and sorts one row per key instead
    of one per fact row (a hot key costs one row). When the grouping after
    the join has few values, joining first is better: the partial aggregate
    after the join already reduces map-side.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(weight_name))


def top_countries_by_entries(df: DataFrame, country_col: str = "country",
                             track_col: str = "track_name", top: int = S.TOP_N,
                             weight_col: str | None = None) -> DataFrame:
    return entries_by(df, country_col, track_col, "chart_entries", "unique_tracks", top,
                      weight_col=weight_col)


def top_artists_global(df: DataFrame, artist_col: str = "artist_name",
                       country_col: str = "country", top: int = S.TOP_N,
                       weight_col: str | None = None) -> DataFrame:
    return entries_by(df, artist_col, country_col, "chart_appearances", "countries_charted", top,
                      weight_col=weight_col)


def top_per_group(df: DataFrame, group: str = "country", order: str = "daily_rank",
                  k: int = S.TOP_RANKS_PER_COUNTRY, ascending: bool = True,
                  columns: Sequence[str] = ("country", "track_name", "artist_name", "daily_rank"),
                  rank_name: str = "rank_in_country", per_snapshot: bool = False,
                  date_col: str = "snapshot_date", min_order_value=None) -> DataFrame:
    """WIN1/FLT4: ``dense_rank`` of ``order`` within each group, ranks <= k.

    Without ``per_snapshot`` the ranking has no date key, so every row whose
    value is among the k best of its group over all dates is kept. NULLs
    sort first when ascending (and a filled rank of 0 wins); pass
    ``min_order_value=1`` to drop such rows first.

    Only the distinct (group, value) pairs are ranked; the rows are then
    joined to the pairs that made the cut, so a group that holds much of the
    table is neither sorted nor gathered in one task. That holds with
    ``per_snapshot`` too: rows whose date could not be read are one group.
    """
    if min_order_value is not None:
        df = df.filter(F.col(order) >= F.lit(min_order_value))
    keys = [group] + ([date_col] if per_snapshot else [])
    o = F.col("__value").asc_nulls_first() if ascending else F.col("__value").desc_nulls_last()
    names = {k: f"__key{i}" for i, k in enumerate(keys)} | {order: "__value"}
    pairs = df.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    best = (pairs.withColumn(rank_name, F.dense_rank().over(Window.partitionBy(*[names[k] for k in keys]).orderBy(o)))
                 .filter(F.col(rank_name) <= k))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return (df.join(best, same)
              .select(*columns, rank_name)
              .orderBy(_asc(group), _asc(rank_name)))


def trends_over_time(df: DataFrame, year_col: str = "snapshot_year", month_col: str = "snapshot_month",
                     distinct_col: str = "track_name") -> DataFrame | None:
    """AGG4 (+FLT7 guard): entries and distinct tracks per (year, month),
    chronological; ``None`` when the date parts are missing."""
    if year_col not in df.columns or month_col not in df.columns:
        return None
    return (df.groupBy(year_col, month_col)
              .agg(F.count(F.lit(1)).alias("chart_entries"),
                   F.countDistinct(distinct_col).alias("unique_tracks"))
              .orderBy(_asc(year_col), _asc(month_col)))


def feature_means(df: DataFrame, columns: Sequence[str] = (*S.AUDIO_FEATURES, "duration_ms"),
                  prefix: str = "avg_") -> DataFrame:
    """AGG5: one row of means (one global partial/final aggregate)."""
    return df.agg(*[F.avg(c).alias(f"{prefix}{c}") for c in columns])


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation that is NULL (not an error) when either side is
    constant or there are no pairs."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _correlation_columns(df_target: Column, features: Sequence[str], nulls: str, prefix: str = "") -> list[Column]:
    if nulls not in ("zero", "skip"):
        raise ValueError("nulls must be 'zero' or 'skip'")
    t = df_target
    cols = []
    for f in features:
        x = F.col(f).cast("double")
        if nulls == "zero":
            a, b = F.coalesce(t, F.lit(0.0)), F.coalesce(x, F.lit(0.0))
        else:
            both = t.isNotNull() & x.isNotNull()
            a, b = F.when(both, t), F.when(both, x)
        cols.append(pearson(a, b).alias(f"{prefix}{f}"))
    return cols


def feature_correlations(df: DataFrame, target: str = "popularity",
                         features: Sequence[str] = S.AUDIO_FEATURES, nulls: str = "skip",
                         name_col: str = "feature",
                         value_col: str = "correlation_with_popularity") -> DataFrame:
    """AGG7 (``nulls="zero"``: a NULL reads as 0.0) and AGG8 (``nulls="skip"``:
    pairs with a NULL are left out), long output ``(feature, correlation)``.

    All features are computed in one aggregate pass, then unpivoted.
    """
    wide = df.agg(*_correlation_columns(F.col(target).cast("double"), features, nulls))
    return wide.unpivot([], list(features), name_col, value_col)


def feature_correlations_both(df: DataFrame, target: str = "popularity",
                              features: Sequence[str] = S.AUDIO_FEATURES,
                              name_col: str = "feature",
                              value_col: str = "correlation_with_popularity",
                              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """AGG7 and AGG8 from a single scan: one aggregate computes both null
    policies; its one-row result is cached and unpivoted twice. Returns
    ``(nulls_as_zero, nulls_skipped, cached_row)``; unpersist ``cached_row``
    once both results are written."""
    t = F.col(target).cast("double")
    wide = df.agg(*_correlation_columns(t, features, "zero", "zero__"),
                  *_correlation_columns(t, features, "skip", "skip__")).cache()

    def long(prefix: str) -> DataFrame:
        renamed = wide.select(*[F.col(f"{prefix}{f}").alias(f) for f in features])
        return renamed.unpivot([], list(features), name_col, value_col)

    return long("zero__"), long("skip__"), wide


def rank_by_abs(df: DataFrame, value_col: str = "correlation_with_popularity",
                name_col: str = "feature", rank_name: str = "abs_rank") -> DataFrame:
    """TOP6/FN13: order a (small, per-feature) result by |value| descending.

    The input has one row per feature, so the unpartitioned window is
    bounded by the feature count, not by data volume.
    """
    w = Window.orderBy(F.abs(F.col(value_col)).desc_nulls_last(), _asc(name_col))
    return df.withColumn(rank_name, F.row_number().over(w)).orderBy(rank_name)


# Row numbers of ``monotonically_increasing_id``: the task above, its rows below.
ROW_BITS = 33


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """TOP1/TOP4/TOP7 as a column: the place of every row in ``order``, from 1.

    The order must be total up to equal rows. No window runs over the whole
    table: rows are dealt by ranges of the order and sorted within them, and a
    row's place is its place there behind the rows of the ranges before, which
    are counted. The rows are written once (``checkpoint``), so the ranges that
    were counted are those that are numbered, also after a lost executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    laid = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__row", F.monotonically_increasing_id()).checkpoint())
    laid = laid.withColumns({"__range": F.shiftright("__row", ROW_BITS),
                             "__row": F.col("__row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))})
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = (laid.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))      # a row per range, not per data
                  .select("__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")))
    return (laid.join(F.broadcast(before), "__range")
                .select(*[laid["`" + c + "`"] for c in df.columns], (F.col("__before") + F.col("__row") + 1).alias(name)))


def top_rows_by(df: DataFrame, feature: str,
                name_cols: Sequence[str] = ("track_name", "artist_name"),
                extra_cols: Sequence[str] = ("popularity",),
                n: int = S.TOP_N) -> DataFrame:
    """TOP3: the n rows with the largest ``feature`` as
    ``(*name_cols, feature, *extra_cols)``; ties are broken by the other
    projected columns so the result is deterministic."""
    cols = [*name_cols, feature, *extra_cols]
    order = [F.col(feature).desc_nulls_last()] + [_asc(c) for c in cols if c != feature]
    return df.orderBy(*order).select(*cols).limit(n)


def count_and_mean_by(df: DataFrame, group: str = "release_year", measure: str = "popularity",
                      count_name: str = "song_count", mean_name: str = "avg_popularity") -> DataFrame | None:
    """AGG6/FLT5: rows and mean per non-null group, in group order."""
    if group not in df.columns:
        return None
    return (df.filter(F.col(group).isNotNull())
              .groupBy(group)
              .agg(F.count(F.lit(1)).alias(count_name), F.avg(measure).alias(mean_name))
              .orderBy(_asc(group)))


def join_on_keys(left: DataFrame, right: DataFrame, left_select: Mapping[str, str],
                 right_columns: Sequence[str], on: Sequence[tuple[str, str]],
                 how: str = "inner") -> DataFrame:
    """JN1: project both sides, then equi-join on ``(left_alias, right_col)``
    pairs. NULL keys never match and string keys are case sensitive.

    No hint: Catalyst/AQE pick broadcast only when a side's measured size is
    under the threshold, else sort-merge, and AQE splits skewed partitions.
    """
    l = left.select(*[F.col(src).alias(dst) for src, dst in left_select.items()])
    r = right.select(*right_columns)
    cond = None
    for lc, rc in on:
        term = l[lc] == r[rc]
        cond = term if cond is None else cond & term
    return l.join(r, cond, how)


def lyrics_tracks_join(lyrics: DataFrame, tracks: DataFrame, folded: bool = False) -> DataFrame:
    """JOB11 join with the music column names.

    Lyrics give the output their keys only, so equal ones are folded before
    the join and the matches unfolded after it: the join grows with the
    tables, and all tasks make the rows of an m:n match, equal ones in a row.
    ``folded`` leaves the unfolding to the writer, which then finds the number
    of copies in ``__copies``.
    """
    keys = fold(lyrics.select("artist_name", "track_name"))
    matches = join_on_keys(
        keys, tracks,
        left_select={"artist_name": "lyrics_artist", "track_name": "lyrics_track", "__copies": "__copies"},
        right_columns=["artist_name", "track_name", "popularity", *S.AUDIO_FEATURES],
        on=[("lyrics_artist", "artist_name"), ("lyrics_track", "track_name")],
    )
    return matches if folded else unfold(matches)


def with_match_count(df: DataFrame, name: str = "matches") -> tuple[DataFrame, Observation]:
    """JN4: count joined rows during the next action instead of a separate job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
