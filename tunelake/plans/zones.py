"""Zone jobs: landing -> formatted -> trusted -> analytics / exploitation
(JOB1-JOB16). This is the only module that knows paths and runs actions.

Each table is written once per job; row counts before and after a step are
gathered with ``Observation`` during that write instead of extra scans.
Every write overwrites whole outputs (or, for the partitioned chart table,
only the dates it produced), so a re-run after a failure is idempotent.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.operators import analysis as A
from tunelake.operators import clean as C
from tunelake.operators import exploit as X
from tunelake.operators import ml as M
from tunelake.operators import quality as Q
from tunelake.sources import ledger, manifest, readers, sinks

log = logging.getLogger(__name__)

VARIANTS = ("script", "notebook", "strict")
CHARTS = "top-spotify-songs-by-country"


# Writes that are submitted at a time: each is a job or two of its own, and
# small ones leave most of a cluster idle.
WRITERS = 4


def _together(jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent jobs side by side; the first error is raised once all
    have ended."""
    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


@dataclass
class ZoneReport:
    written: dict[str, str] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def add(self, name: str, path: str, before=None, after=None) -> None:
        self.written[name] = path
        if before is not None and after is not None:
            n_in, n_out = int(before.get["rows"]), int(after.get["rows"])
            self.counts[name] = {"rows_in": n_in, "rows_out": n_out, "rows_removed": n_in - n_out}
            log.info("%s: %d rows in, %d out, %d removed", name, n_in, n_out, n_in - n_out)


def _read_csvs(spark: SparkSession, files: Sequence[ledger.LandingFile], spec: manifest.DatasetSpec,
               source_col: str | None = None) -> DataFrame:
    return readers.read_csv_by_name(spark, [f.path for f in files], manifest.landing_forms(spec.kind),
                                    multi_line=spec.text, source_col=source_col)


def _copied(spark: SparkSession, layout: manifest.ZoneLayout, name: str, but: DataFrame | None = None) -> DataFrame | None:
    """The rows of a dataset's Parquet copy that are in force: all of a copy
    made elsewhere, of our own those with an entry in the ledger, ``but`` those
    of the given files."""
    path = layout.copy(name)
    if not readers.path_exists(spark, path):
        return None
    copy = readers.read_parquet(spark, path)
    if ledger.RUN_COL not in copy.columns:
        return copy
    rows = ledger.in_force(copy, layout.ledger(name))
    if but is not None:
        rows = rows.join(F.broadcast(but.select(F.col("file").alias(ledger.FILE_COL))), ledger.FILE_COL, "left_anti")
    return rows.drop(ledger.FILE_COL, ledger.RUN_COL)


def _read_landing(spark: SparkSession, layout: manifest.ZoneLayout, paths: Sequence[str],
                  spec: manifest.DatasetSpec) -> DataFrame:
    """Every landing row of a dataset: those of its copy and those of the CSVs
    that the ledger does not know (all, where there is none). A CSV whose entry
    is out of date stands for itself."""
    book, copy_path = layout.ledger(spec.name), ledger.plain_path(layout.copy(spec.name))
    new, entries = ledger.changed(spark, book, [p for p in paths if not p.endswith(".parquet")])
    parts = [_read_csvs(spark, new, spec)] if new else []
    copy = _copied(spark, layout, spec.name, but=entries)
    parts += [copy] if copy is not None else []
    parts += [readers.read_parquet(spark, p) for p in paths
              if p.endswith(".parquet") and ledger.plain_path(p.rstrip("/")) != copy_path]
    if not parts:
        raise FileNotFoundError(f"no landing rows of {spec.name}")
    columns = parts[0].columns
    return reduce(DataFrame.unionByName, [p.select(*[p["`" + c + "`"] for c in columns]) for p in parts])


def _format(df: DataFrame, kind: str, variant: str, more: Sequence[S.ColumnSpec] = ()) -> DataFrame:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    if kind == "tracks":
        if variant == "script":
            return C.format_tracks(df)
        return C.format_tracks(df, required=(), lower_names=(variant == "strict"))
    if kind == "charts":
        if variant == "script":
            return C.format_charts(df, [*S.CHARTS_SPEC, *more])
        if variant == "notebook":
            return C.format_charts(df, [*S.CHARTS_SPEC, *more], fill=None, required=())
        return C.format_charts(df, [*S.CHARTS_SPEC, *more], fill=None, country_col=None, required=())
    if kind == "lyrics":
        spec = manifest.landing_spec(kind, df.columns)
        if variant == "script":
            return C.format_lyrics(df, spec)
        out = C.format_lyrics(df, spec, required=())
        return out.withColumnRenamed("track_name", "song_name") if variant == "notebook" else out
    raise ValueError(kind)


def _adopt(spark: SparkSession, layout: manifest.ZoneLayout, name: str) -> None:
    """Give a copy made elsewhere the form of our own, with an entry for itself."""
    path, book, run = layout.copy(name), layout.ledger(name), ledger.new_run()
    if not readers.path_exists(spark, path):
        return
    copy = readers.read_parquet(spark, path)
    if ledger.RUN_COL not in copy.columns:
        marked = copy.withColumns({ledger.FILE_COL: F.lit(ledger.plain_path(path)), ledger.RUN_COL: F.lit(run)})
        sinks.write_parquet(marked, path, partition_by=[ledger.RUN_COL])
    elif not readers.path_exists(spark, book):  # its run was lost before this entry
        run = copy.agg(F.max(F.when(F.col(ledger.FILE_COL) == ledger.plain_path(path), F.col(ledger.RUN_COL)))).first()[0]
    else:
        return
    if run:
        ledger.record(spark.createDataFrame([(ledger.plain_path(path), 0, 0, "", run)], ledger.ENTRY), book)


def landing_to_parquet(spark: SparkSession, layout: manifest.ZoneLayout, update: bool = False) -> ZoneReport:
    """SNK4 as a Spark job: the landing CSVs of every known dataset that are
    not in its ledger, or have changed since, are added to
    ``landing/<dataset>.parquet`` and entered. Rows of earlier files stay, also
    where the CSV has gone; auxiliary files are skipped by the deny-list."""
    report = ZoneReport()
    routed = manifest.dispatch(readers.list_files(spark, posixpath_join(layout.root, "landing"), (".csv",)))
    for spec in manifest.datasets_to_refresh(update):
        _adopt(spark, layout, spec.name)
        new, fresh = ledger.changed(spark, layout.ledger(spec.name), routed.get(spec.name, []))
        if fresh is None:
            continue
        run = ledger.new_run()
        if new:  # rows first, under this run's id; the entries make them count
            rows = _read_csvs(spark, new, spec, source_col=ledger.FILE_COL)
            rows.write.parquet(f"{layout.copy(spec.name)}/{ledger.RUN_COL}={run}")
        ledger.record(fresh.withColumn("run", F.lit(run)), layout.ledger(spec.name))
        report.add(spec.name, layout.copy(spec.name))
        report.counts[spec.name] = {"files": len(new)}
    return report


def _write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write a zone table. Rows of a partitioned one are brought together by
    its column first, else every task would leave a file in every date; a
    rebalance, so that AQE cuts a date that holds much of the table (say all
    rows whose date could not be read) and merges small ones."""
    if partition_by:
        return sinks.write_parquet(df.hint("rebalance", F.col(partition_by)), path, partition_by=[partition_by])
    return sinks.write_parquet(df, path)


def format_zone(spark: SparkSession, layout: manifest.ZoneLayout, variant: str = "script",
                update: bool = False, partition_charts: bool = True) -> ZoneReport:
    """JOB1-JOB3 (+SRC8 dispatch, STR1 manifest filter)."""
    report = ZoneReport()
    routed = manifest.dispatch(readers.list_files(spark, posixpath_join(layout.root, "landing")))

    def run(spec: manifest.DatasetSpec) -> None:
        paths = routed.get(spec.name)
        if not paths:
            log.warning("no landing file for %s", spec.name)
            return
        raw, before = Q.observe_counts(_read_landing(spark, layout, paths, spec), f"{spec.name}_in")
        out, after = Q.observe_counts(_format(raw, spec.kind, variant), f"{spec.name}_out")
        path = layout.formatted(spec.name)
        _write_table(out, path, "snapshot_date" if spec.kind == "charts" and partition_charts else None)
        report.add(spec.name, path, before, after)

    _together([partial(run, spec) for spec in manifest.datasets_to_refresh(update)])
    if not update and report.written:
        sinks.mark_committed(spark, posixpath_join(layout.root, "formatted"))
    return report


def posixpath_join(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts)


def _charts_required(df: DataFrame) -> DataFrame:
    return C.drop_nulls(df.select(*S.TRUSTED_CHARTS_COLUMNS), ("track_name", "artist_name"))


def trusted_zone(spark: SparkSession, layout: manifest.ZoneLayout) -> ZoneReport:
    """JOB4-JOB6. The chart constraints are counted one by one (rows removed
    by the required columns, by the one-song-per-slot rule and by the
    one-row-per-artist-title-date rule), all within the single write."""
    report = ZoneReport()
    jobs = {
        "spotify-tracks-dataset": [("trust_tracks", Q.trust_tracks)],
        "top-spotify-songs-by-country": [("required_columns", _charts_required),
                                         ("unique_chart_slot", Q.unique_chart_slot),
                                         ("unique_artist_title", Q.unique_artist_title)],
        "songs-lyrics": [("trust_lyrics", Q.trust_lyrics)],
    }

    def run(name: str, steps: list) -> None:
        src = layout.formatted(name)
        if not readers.path_exists(spark, src):
            return
        table = readers.rename_if_present(readers.read_parquet(spark, src), {"song_name": "track_name"})
        if name == "songs-lyrics" and "song_lyrics" not in table.columns:
            log.warning("%s holds links, not texts; no trusted table", src)
            return
        out, marks = Q.observed_chain(table, steps)
        _write_table(out, layout.trusted(name), "snapshot_date" if name == CHARTS else None)
        report.add(name, layout.trusted(name), marks[0][1], marks[-1][2])
        if len(marks) > 1:
            for step, before, after in marks:
                report.add(f"{name}:{step}", layout.trusted(name), before, after)

    _together([partial(run, name, steps) for name, steps in jobs.items()])
    if report.written:
        sinks.mark_committed(spark, posixpath_join(layout.root, "trusted"))
    return report


def refresh_charts_zone(spark: SparkSession, layout: manifest.ZoneLayout, variant: str = "script") -> ZoneReport:
    """STR1 on raw files: take in the chart CSVs that are new or have changed,
    and rebuild the formatted and trusted dates that they touch. A file that
    came again in another form replaces its earlier rows, also where these had
    dates of their own. Equal to a full run over all files in force."""
    from tunelake.streaming import refresh
    report = landing_to_parquet(spark, layout, update=True)
    if not readers.path_exists(spark, layout.ledger(CHARTS)):
        return report

    def formatted_rows(taken: DataFrame) -> DataFrame:
        runs = [r[0] for r in taken.select("run").distinct().collect()]  # conversions since the last refresh
        copy = readers.read_parquet(spark, layout.copy(CHARTS)).filter(F.col(ledger.RUN_COL).isin(runs))
        keys = [F.col("file").alias(ledger.FILE_COL), F.col("run").alias(ledger.RUN_COL)]
        marks = [ledger.FILE_COL, ledger.RUN_COL]
        mine = copy.join(F.broadcast(taken.select(*keys)), marks, "left_semi")
        return _format(mine, "charts", variant, more=[S.ColumnSpec(c, c) for c in marks])

    targets = {layout.formatted(CHARTS): lambda df: df, layout.trusted(CHARTS): Q.trust_charts}
    dates = refresh.refresh_versions(spark, layout.ledger(CHARTS), formatted_rows,
                                     posixpath_join(layout.root, "refresh", CHARTS), targets)
    for path in targets:
        report.add(f"{CHARTS}:{path.split('/')[-2]}", path)
    report.counts["dates_rebuilt"] = {"rows_out": dates}
    return report


def bootstrap(spark: SparkSession, layout: manifest.ZoneLayout, variant: str = "script") -> dict[str, ZoneReport]:
    """STR2: the first run of every zone that is not there as a whole. A zone
    counts once its job has ended; tables that a lost first run has left do
    not make one."""
    jobs = {"formatted": lambda: format_zone(spark, layout, variant), "trusted": lambda: trusted_zone(spark, layout)}
    reports: dict[str, ZoneReport] = {}
    for zone, job in jobs.items():
        if reports or not sinks.is_committed(spark, posixpath_join(layout.root, zone)):
            log.info("first run of the %s zone", zone)
            reports[zone] = job()
    return reports


def _zone_table(spark: SparkSession, layout: manifest.ZoneLayout, name: str, zone: str) -> DataFrame | None:
    """A table of the zone, or (logged) of the other one where that is missing
    or not committed."""
    paths = [layout.formatted(name), layout.trusted(name)]
    paths = paths if zone == "formatted" else paths[::-1]
    if not any(readers.path_exists(spark, p) for p in paths):
        return None
    return readers.read_with_fallback(spark, paths, own=[True, True])[0]


def analytics_zone(spark: SparkSession, layout: manifest.ZoneLayout, zone: str = "formatted") -> ZoneReport:
    """JOB7-JOB11: every result as a headed CSV at ``analytics/<name>``, over
    the tables of ``zone`` (``formatted`` or ``trusted``)."""
    if zone not in ("formatted", "trusted"):
        raise ValueError("zone must be formatted or trusted")
    report = ZoneReport()
    tracks = _zone_table(spark, layout, "spotify-tracks-dataset", zone)
    charts = _zone_table(spark, layout, "top-spotify-songs-by-country", zone)
    lyrics = _zone_table(spark, layout, "songs-lyrics", zone)
    results: dict[str, DataFrame | None] = {}
    cached: list[DataFrame] = []
    if tracks is not None:
        results["top_artists"] = A.artist_popularity(tracks)
        by_corr = F.desc_nulls_last("correlation_with_popularity")
        zero, skip, row = A.feature_correlations_both(tracks)   # one scan for both null policies
        cached.append(row)
        results["feature_correlations"] = zero.orderBy(by_corr)
        results["average_audio_features"] = A.feature_means(tracks)
        results["feature_popularity_correlation"] = skip.orderBy(by_corr)
        for feature, name in (("danceability", "most_danceable_songs"), ("energy", "most_energetic_songs"),
                              ("acousticness", "most_acoustic_songs")):
            results[name] = A.top_rows_by(tracks, feature)
        results["songs_by_year"] = A.count_and_mean_by(tracks)
    if charts is not None:
        results["top_countries_by_entries"] = A.top_countries_by_entries(charts)
        results["top_artists_global"] = A.top_artists_global(charts)
        results["top_songs_by_country"] = A.top_per_group(charts)
        dated = charts
        if "snapshot_year" not in charts.columns and "snapshot_date" in charts.columns:
            dated = C.add_date_parts(charts)
        results["chart_trends_over_time"] = A.trends_over_time(dated)
    for name in [n for n, df in results.items() if df is None]:  # FLT7: a guarded analysis whose columns are absent
        log.warning("analysis %s skipped: its columns are absent", name)
        del results[name]
    _together([partial(sinks.write_csv, df, layout.analytics(name)) for name, df in results.items()])
    for name in results:
        report.add(name, layout.analytics(name))
    for df in cached:
        df.unpersist()
    if lyrics is not None and tracks is not None:
        lyrics = readers.rename_if_present(lyrics, {"song_name": "track_name"})
        path = layout.analytics("lyrics_tracks_combined")
        # m x n rows for a key that m lyrics and n tracks share: m equal ones at a time, compressed
        matches = sinks.write_if_rows(A.lyrics_tracks_join(lyrics, tracks, folded=True), path, copies="__copies", compression="lz4")
        report.counts["lyrics_tracks_combined"] = {"rows_out": matches}
        log.info("lyrics_tracks_combined: %d matches", matches)
        if matches:
            report.add("lyrics_tracks_combined", path)
    return report


def exploitable(spark: SparkSession, layout: manifest.ZoneLayout, name: str, kind: str) -> tuple[DataFrame, str]:
    """SRC6: a dataset's table from the first committed zone, and that zone's
    name; a landing copy (raw names, text values) is typed and renamed (PRJ7)
    as the formatter does."""
    zone_of = {layout.trusted(name): "trusted", layout.formatted(name): "formatted", layout.copy(name): "landing"}
    df, path = readers.read_with_fallback(spark, list(zone_of), own=[True, True, False])
    if zone_of[path] == "landing":
        df = _format(_copied(spark, layout, name), kind, "notebook")
    return df, zone_of[path]


def exploitation_zone(spark: SparkSession, layout: manifest.ZoneLayout,
                      normalise_keys: bool = True) -> ZoneReport:
    """JOB12 (SRC6 fallback to landing with renames, JN3, JN2) and JOB13."""
    report = ZoneReport()

    def table(name: str, kind: str) -> DataFrame:
        return exploitable(spark, layout, name, kind)[0]

    lyrics, tracks = table("songs-lyrics", "lyrics"), table("spotify-tracks-dataset", "tracks")
    sets = {"data_visualization": X.visualisation_set(table("top-spotify-songs-by-country", "charts"))}
    if "song_lyrics" in lyrics.columns:
        title = "song_name" if "song_name" in lyrics.columns else "track_name"
        sets["explicit_prediction"] = X.explicit_prediction(
            lyrics, tracks, on=[("artist_name", "artist_name"), (title, "track_name")], normalise_keys=normalise_keys)
    else:
        log.warning("lyrics hold links, not texts; no classifier set")
    _together([partial(sinks.write_parquet, df, layout.exploitation(name)) for name, df in sets.items()])
    for name in sets:
        report.add(name, layout.exploitation(name))
    return report


def chart_history_for(spark: SparkSession, layout: manifest.ZoneLayout, country: str, start, end,
                      slots: int = S.CHART_SLOTS) -> DataFrame:
    """JOB14 over the exploitation table (the caller decides the action)."""
    vis = readers.read_parquet(spark, layout.exploitation("data_visualization"))
    return X.chart_history(vis, country, start, end, slots)


def classifier_report(spark: SparkSession, layout: manifest.ZoneLayout,
                      seed: int = S.SPLIT_SEED) -> dict[str, DataFrame]:
    """JOB15: label projection, split, class counts before/after balancing,
    model fit on the balanced training split, metrics, confusion matrix and
    five sample predictions of the test split."""
    data = M.label_projection(readers.read_parquet(spark, layout.exploitation("explicit_prediction")))
    split = M.stable_split(data, "song_lyrics", seed)
    M.require_classes(split.filter(F.col("split") == "validation"), "label")
    # the counts need no texts: number the rows by a hash of them
    train = split.filter(F.col("split") == "train").select(F.sha2("song_lyrics", 256).alias("text_hash"), "label")
    balanced = M.oversample(train, "label", id_col="text_hash", seed=seed).drop("replica")
    _, preds, metrics = M.train_and_evaluate(data, seed=seed)
    return {
        "class_counts": M.class_counts(data),
        "balanced_counts": M.class_counts(balanced),
        "metrics": metrics,
        "confusion_matrix": M.confusion_matrix(preds),
        "samples": M.sample_rows(preds, 5, id_col="song_lyrics", seed=seed),
    }


def read_back(spark: SparkSession, layout: manifest.ZoneLayout, artists: int = 20,
              countries: int = 15) -> dict[str, DataFrame]:
    """JOB16 read-back of the chart inputs (TOP5, TOP6, SRC3, SRC4): bounded,
    ordered heads of the analytics CSVs, still as DataFrames."""
    out: dict[str, DataFrame] = {}
    top = layout.analytics("top_artists")
    if readers.path_exists(spark, top):
        df = readers.read_text_csv(spark, top, S.TOP_ARTISTS_SCHEMA)
        out["top_artists"] = sinks.preview(df.orderBy(F.desc_nulls_last("avg_popularity"), "artist_name"),
                                           artists)
    entries = layout.analytics("top_countries_by_entries")
    if readers.path_exists(spark, entries):
        df = readers.read_text_csv(spark, entries, infer=True)
        out["top_countries_by_entries"] = sinks.preview(
            df.orderBy(F.desc_nulls_last("chart_entries"), df.columns[0]), countries)
    corr = layout.analytics("feature_correlations")
    if readers.path_exists(spark, corr):
        df = readers.read_text_csv(spark, corr, infer=True)
        out["feature_correlations"] = A.rank_by_abs(df)
    return out


def run_all(spark: SparkSession, layout: manifest.ZoneLayout, variant: str = "script",
            update: bool = False, zone: str = "formatted") -> dict[str, ZoneReport]:
    """JOB16: the whole batch flow over one zone layout; ``zone`` is what the
    analyses read. An update run refreshes the daily chart alone, once there
    has been a first run."""
    if update and not (reports := bootstrap(spark, layout, variant)):
        reports = {"refreshed": refresh_charts_zone(spark, layout, variant)}
    elif not update:
        reports = {"formatted": format_zone(spark, layout, variant), "trusted": trusted_zone(spark, layout)}
    return reports | {
        "analytics": analytics_zone(spark, layout, zone),
        "exploitation": exploitation_zone(spark, layout),
    }


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m tunelake.plans.zones ROOT [--variant V] [--update]``."""
    import argparse
    import json

    from tunelake.session import build_session

    ap = argparse.ArgumentParser(description="Run the zone jobs over one root folder.")
    ap.add_argument("root")
    ap.add_argument("--variant", choices=VARIANTS, default="script")
    ap.add_argument("--update", action="store_true", help="refresh only the daily chart")
    ap.add_argument("--zone", choices=("formatted", "trusted"), default="formatted",
                    help="tables that the analyses read")
    ap.add_argument("--preview", type=int, default=0, metavar="N",
                    help="print the schema and first N rows of the read-back results (SNK5)")
    args = ap.parse_args(argv)
    spark = build_session()
    try:
        layout = manifest.ZoneLayout(args.root)
        reports = run_all(spark, layout, args.variant, args.update, args.zone)
        print(json.dumps({zone: {"written": r.written, "counts": r.counts} for zone, r in reports.items()},
                         indent=2))
        if args.preview:
            for name, df in read_back(spark, layout).items():
                print(f"== {name}")
                df.printSchema()
                df.show(args.preview, truncate=False)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
