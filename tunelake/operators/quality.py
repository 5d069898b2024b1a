"""Trusted zone: denial constraints and their violation counts.

Duplicate removal is ``row_number() == 1`` over a window. Spark plans it as
a partial ``WindowGroupLimit`` before the shuffle (each map task keeps one
row per key), so a key that holds a third of the table is cut down before it
is moved. Every ordering ends in a full tie-break over the remaining
columns, which makes the survivor deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake import schemas as S
from tunelake.operators.clean import drop_nulls

_RN = "__keep_first_rn"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
               tie_break: bool = True, hashed_keys: bool = False) -> DataFrame:
    """One row per key: the first by ``order`` (WIN2, WIN3, WIN4, WIN7).

    The tie-break orders by all remaining columns; a map column cannot be
    ordered, so it raises. ``hashed_keys`` groups by the SHA-256 of the
    (string) keys, for keys that are long texts.
    """
    order_cols = [F.col(o).asc() if isinstance(o, str) else o for o in order]
    if tie_break:
        used = {k for k in keys if isinstance(k, str)} | {o for o in order if isinstance(o, str)}
        rest = [c for c in df.columns if c not in used]
        maps = [c for c in rest if isinstance(df.schema[c].dataType, T.MapType)]
        if maps:
            raise TypeError(f"map columns {maps} cannot break ties; order by a canonical form of them instead")
        order_cols += [F.col(c).asc() for c in rest]
    if hashed_keys:
        keys = [F.sha2(F.col(k) if isinstance(k, str) else k, 256) for k in keys]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def at_least(df: DataFrame, col: str, minimum) -> DataFrame:
    """Denial constraint ``col >= minimum``; NULLs fail it (FLT2)."""
    return df.filter(F.col(col) >= F.lit(minimum))


def trust_tracks(df: DataFrame,
                 columns: Sequence[str] = S.TRUSTED_TRACKS_COLUMNS,
                 required: Sequence[str] = ("track_id", "track_name", "artist_name", "explicit"),
                 duration_col: str = "duration_ms",
                 min_duration: int = S.MIN_DURATION_MS) -> DataFrame:
    """JOB4: projection, required columns and minimum duration."""
    return at_least(drop_nulls(df.select(*columns), required), duration_col, min_duration)


def unique_chart_slot(df: DataFrame, date_col: str = "snapshot_date", country_col: str = "country",
                      rank_col: str = "daily_rank", title_col: str = "track_name") -> DataFrame:
    """WIN2: one song per (date, country, rank); the first title wins."""
    return keep_first(df, [date_col, country_col, rank_col], [title_col])


def unique_artist_title(df: DataFrame, artist_col: str = "artist_name", country_col: str = "country",
                        title_col: str = "track_name", date_col: str = "snapshot_date",
                        order: Sequence[str] | None = None) -> DataFrame:
    """WIN3: one row per (artist, country, title, date)."""
    keys = [artist_col, country_col, title_col, date_col]
    return keep_first(df, keys, list(order) if order else [title_col])


def trust_charts(df: DataFrame,
                 columns: Sequence[str] = S.TRUSTED_CHARTS_COLUMNS,
                 required: Sequence[str] = ("track_name", "artist_name"),
                 colocate: bool = False) -> DataFrame:
    """JOB5: projection, required columns, WIN2 then WIN3 (order matters).

    ``colocate=True`` hash-partitions on (date, country) first, a subset of
    both window keys, so the two windows share one exchange. That suits
    charts (at most a few hundred rows per date and country); with skewed
    (date, country) groups keep the default, where each window shuffles on
    its own fine-grained key after a partial group limit.
    """
    df = drop_nulls(df.select(*columns), required)
    if colocate:
        df = df.repartition("snapshot_date", "country")
    return unique_artist_title(unique_chart_slot(df))


def trust_lyrics(df: DataFrame,
                 columns: Sequence[str] = S.TRUSTED_LYRICS_COLUMNS,
                 required: Sequence[str] = S.TRUSTED_LYRICS_COLUMNS,
                 id_col: str = "song_id", order_col: str = "artist_name") -> DataFrame:
    """JOB6: projection, required columns, WIN4 (unique id, first by artist)."""
    return keep_first(drop_nulls(df.select(*columns), required), [id_col], [order_col])


@dataclass(frozen=True)
class Unique:
    """One row per key: the first by ``order``, then by all other columns."""
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        return keep_first(df, list(self.keys), list(self.order))


@dataclass(frozen=True)
class Where:
    """Rows for which a SQL condition is true."""
    condition: str

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition)


# What the chart constraints are to a report.
unique_chart_slot.constraint = Unique(("snapshot_date", "country", "daily_rank"), ("track_name",))
unique_artist_title.constraint = Unique(("artist_name", "country", "track_name", "snapshot_date"), ("track_name",))


def violation_report(df: DataFrame,
                     steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Rows in, kept and removed per constraint of a chain (AGG9), in one pass
    over the table.

    A row carries itself while it is alive, and how many rows it stands for
    at each step so far. A ``Where`` ends rows; a ``Unique`` folds the living
    rows of a key to the first one (a minimum, so every task folds before the
    shuffle and no key is gathered) and all others to one that only counts.
    Later steps see survivors alone; the last aggregate sums the counts. Steps
    are ``Unique``, ``Where`` or functions that name one as ``constraint``;
    others raise. NULL keys are keys, as in ``keep_first``.
    """
    rules = [(name, getattr(step, "constraint", step)) for name, step in steps]
    for name, rule in rules:
        if not isinstance(rule, (Unique, Where)):
            raise TypeError(f"{name}: not a Unique or Where constraint")
    row, counts = "__row", ["__n0"]
    current = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), F.lit(1).cast("bigint").alias("__n0"))
    for k, (_, rule) in enumerate(rules, start=1):
        alive = F.col(row).isNotNull()
        if isinstance(rule, Where):
            flat = current.select(*counts, row, f"{row}.*")
            current = flat.select(*counts, F.when(alive & F.expr(rule.condition), F.col(row)).alias(row))
        else:
            first = list(dict.fromkeys([*rule.order, *[c for c in df.columns if c not in rule.keys], *rule.keys]))
            ordered = F.struct(*[F.col(row)[c].alias(c) for c in first])
            key = F.when(alive, F.struct(*[F.col(row)[c].alias(c) for c in rule.keys]))
            folded = (current.groupBy(key.alias("__key"))
                      .agg(F.min(F.when(alive, ordered)).alias("__first"), *[F.sum(c).alias(c) for c in counts]))
            current = folded.select(*counts, F.when(F.col("__first").isNotNull(), F.struct(
                *[F.col("__first")[c].alias(c) for c in df.columns])).alias(row))
        counts.append(f"__n{k}")
        current = current.withColumn(counts[-1], F.col(row).isNotNull().cast("bigint"))
    sums = current.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    rows = [F.struct(F.lit(k).alias("step"), F.lit(name).alias("constraint_name"), F.col(counts[k - 1]).alias("rows_in"),
                     F.col(counts[k]).alias("rows_kept"), (F.col(counts[k - 1]) - F.col(counts[k])).alias("rows_removed"))
            for k, (name, _) in enumerate(rules, start=1)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def observed_chain(df: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
                   ) -> tuple[DataFrame, list[tuple[str, Observation, Observation]]]:
    """Apply constraint steps in order, counting rows before and after each
    one during whatever action runs next (AGG9 per constraint, one pass)."""
    marks = []
    current, before = observe_counts(df, f"{steps[0][0]}_in") if steps else (df, None)
    for name, step in steps:
        current, after = observe_counts(step(current), f"{name}_out")
        marks.append((name, before, after))
        before = after
    return current, marks


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in during whatever action runs next
    (the write), instead of a separate ``count()`` scan."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def removed_rows(before: Observation, after: Observation) -> int:
    return int(before.get["rows"]) - int(after.get["rows"])


def constraint_key_violations(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that still occur more than once (empty when the constraint holds)."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
