"""Query catalogue: every operator run on the shared test tables, each with
an equivalent DuckDB SQL oracle (where SQL can express it).

Every query reads whole tables; none filters rows to make a check cheaper.
Column names are aliased identically on both sides. Floating aggregates are
rounded on both sides (HALF_UP on the shortest decimal text of the double,
which is what Spark's ``round`` does) because summation order differs
between engines in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake import schemas as S
from tunelake.functions.casts import DECIMAL_TEXT
from tunelake.functions.text import SPECIAL_CHARS_PATTERN, fold_accents, normalise_name, strip_special
from tunelake.operators import analysis as A
from tunelake.operators import clean as C
from tunelake.operators import exploit as X
from tunelake.operators import ml as M
from tunelake.operators import quality as Q
from tunelake.plans import roles as R
from tunelake.plans import zones
from tunelake.session import shared_dir
from tunelake.sources import manifest, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

MEAN_DIGITS = 4
CORR_DIGITS = 6
METRIC_DIGITS = 6
HISTORY_COUNTRY = "click"
HISTORY_START = "2024-01-01"
HISTORY_END = "2024-01-30"
PREDICTION_MIN_CHARS = 2000

CORR_FEATURES = ["l_extendedprice", "l_discount", "l_tax"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return R.table(spark, sf, name)


def _round_cols(df: DataFrame, cols, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# SQL twins of Spark's double rounding and of the lenient casts.
def _rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _lenient_int(expr: str, typ: str = "INTEGER") -> str:
    return (f"CASE WHEN regexp_matches({expr}, '{DECIMAL_TEXT}') "
            f"THEN TRY_CAST(regexp_extract({expr}, '{DECIMAL_TEXT}', 1) AS {typ}) "
            f"ELSE TRY_CAST({expr} AS {typ}) END")


def _pearson_sql(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / NULLIF(stddev_pop({x}) * stddev_pop({y}), 0)"


# ---------------------------------------------------------------------------
# Spark forms
# ---------------------------------------------------------------------------

def q_top_artists(spark, sf):
    return A.artist_popularity(_t(spark, sf, "lineitem"), group="l_suppkey", measure="l_quantity",
                               id_col="l_orderkey")


def q_top_artists_cents(spark, sf):
    return A.artist_popularity(_t(spark, sf, "orders"), group="o_custkey", measure="o_totalprice",
                               id_col="o_orderkey")


def _orders_by_nation(spark, sf):
    # Orders are reduced to one row per customer before the join (exactly
    # equivalent: entries are summed back, the distinct key is the join key).
    # The aggregate is hash-partitioned on the join key, so a sort-merge join
    # reuses that partitioning and sorts one row per customer, not per order.
    o = A.pre_aggregate(_t(spark, sf, "orders"), ["o_custkey"])
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)


def q_top_countries_by_entries(spark, sf):
    return A.top_countries_by_entries(_orders_by_nation(spark, sf), "n_name", "o_custkey",
                                      weight_col="__rows")


def q_top_artists_global(spark, sf):
    # Join first: the grouping (brand, supplier) has few values, so the
    # partial aggregate after the join reduces map-side; a pre-aggregate on
    # (part, supplier) would not be partitioned by the join key and would
    # add a shuffle.
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    p = _t(spark, sf, "part").select("p_partkey", "p_brand")
    return A.top_artists_global(li.join(p, li.l_partkey == p.p_partkey), "p_brand", "l_suppkey")


def q_top_songs_by_country(spark, sf):
    return A.top_per_group(_t(spark, sf, "customer"), group="c_nationkey", order="c_acctbal",
                           ascending=False,
                           columns=("c_nationkey", "c_name", "c_mktsegment", "c_acctbal"))


def _orders_dated(spark, sf):
    o = _t(spark, sf, "orders")
    return o.withColumns({"snapshot_year": F.year("o_orderdate"), "snapshot_month": F.month("o_orderdate")})


def q_chart_trends_over_time(spark, sf):
    return A.trends_over_time(_orders_dated(spark, sf), distinct_col="o_custkey")


def q_average_features(spark, sf):
    cols = ["l_quantity", *CORR_FEATURES]
    return _round_cols(A.feature_means(_t(spark, sf, "lineitem"), cols),
                       [f"avg_{c}" for c in cols], MEAN_DIGITS)


def _corr_input(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_quantity", "l_extendedprice",
                     F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"), "l_tax")


def _corr(spark, sf, nulls):
    df = A.feature_correlations(_corr_input(spark, sf), "l_quantity", CORR_FEATURES, nulls=nulls)
    return _round_cols(df, ["correlation_with_popularity"], CORR_DIGITS)


def q_corr_null_as_zero(spark, sf):
    return _corr(spark, sf, "zero")


def q_corr_null_skipped(spark, sf):
    return _corr(spark, sf, "skip")


def q_corr_abs_ranking(spark, sf):
    return A.rank_by_abs(_corr(spark, sf, "skip"))


def _top_by(feature):
    def q(spark, sf):
        return A.top_rows_by(_t(spark, sf, "lineitem"), feature,
                             name_cols=("l_orderkey", "l_linenumber"), extra_cols=("l_quantity",))
    return q


def q_songs_by_year(spark, sf):
    o = _t(spark, sf, "orders").withColumn("release_year", F.year("o_orderdate"))
    df = A.count_and_mean_by(o, "release_year", "o_custkey")
    return _round_cols(df, ["avg_popularity"], MEAN_DIGITS)


def q_lyrics_tracks_join(spark, sf):
    return A.join_on_keys(
        _t(spark, sf, "orders"), _t(spark, sf, "lineitem"),
        left_select={"o_orderkey": "lyrics_orderkey", "o_orderstatus": "lyrics_status",
                     "o_orderpriority": "lyrics_priority"},
        right_columns=["l_orderkey", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        on=[("lyrics_orderkey", "l_orderkey"), ("lyrics_status", "l_linestatus")])


def q_explicit_prediction(spark, sf):
    docs = _t(spark, sf, "documents").withColumnRenamed("text", "song_lyrics")
    out = X.explicit_prediction(docs, _t(spark, sf, "labels"), on=[("doc_id", "doc_id")],
                                text_col="song_lyrics", label_col="toxic", artist_col="source")
    return out.withColumnRenamed("toxic", "explicit")


def q_visualisation_export(spark, sf):
    return X.visualisation_set(R.charts_from_events(_t(spark, sf, "events")))


def q_format_tracks(spark, sf):
    return C.format_tracks(R.raw_tracks_from_part(_t(spark, sf, "part")), spec=R.TRACKS_FROM_PART_SPEC)


def q_format_charts(spark, sf):
    fill = {"daily_rank": 0, "popularity": 0, "duration_ms": 0, "acousticness": 0.0}
    return C.format_charts(R.raw_charts_from_orders(_t(spark, sf, "orders")), spec=R.CHARTS_FROM_ORDERS_SPEC,
                           fill=fill)


def q_format_lyrics(spark, sf):
    return C.format_lyrics(R.raw_lyrics_from_documents(_t(spark, sf, "documents")))


def q_name_normalise(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", normalise_name("text").alias("text_key"))


def q_strip_special(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", strip_special("text").alias("text_clean"))


def q_fold_accents(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", fold_accents("text").alias("text_folded"))


TRUST_LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                          "l_extendedprice"]


def q_trust_min_duration(spark, sf):
    return Q.trust_tracks(_t(spark, sf, "lineitem"), columns=TRUST_LINEITEM_COLUMNS,
                          required=("l_orderkey", "l_partkey", "l_suppkey"),
                          duration_col="l_extendedprice", min_duration=S.MIN_DURATION_MS)


def _event_charts(spark, sf):
    return R.charts_from_events(_t(spark, sf, "events"))


def q_unique_rank(spark, sf):
    return Q.unique_chart_slot(_event_charts(spark, sf))


def q_unique_rank_then_title(spark, sf):
    return Q.unique_artist_title(Q.unique_chart_slot(_event_charts(spark, sf)))


def q_unique_id(spark, sf):
    return Q.keep_first(_t(spark, sf, "documents"), ["text"], ["doc_id"], hashed_keys=True)


def q_violation_report(spark, sf):
    return Q.violation_report(_event_charts(spark, sf), [
        ("unique_chart_slot", Q.unique_chart_slot),
        ("unique_artist_title", Q.unique_artist_title),
    ])


def q_chart_history(spark, sf):
    return X.chart_history(_event_charts(spark, sf), HISTORY_COUNTRY, HISTORY_START, HISTORY_END)


def q_new_entries(spark, sf):
    ev = _t(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    return X.new_entries(ev, "snapshot_date", "user_id")


def q_history_new_entries(spark, sf):
    # The history (dates x slots rows) feeds three branches of the new-entry
    # plan; a reliable checkpoint computes it once and cuts the lineage.
    from tunelake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return X.new_entries(q_chart_history(spark, sf).checkpoint())


def q_class_balance(spark, sf):
    return M.class_counts(_t(spark, sf, "labels"), "toxic")


def q_stable_split(spark, sf):
    # documents of one language lose their id: they are placed by the rest
    docs = _t(spark, sf, "documents").select(
        F.when(F.col("lang") != "de", F.col("doc_id")).alias("doc_id"), "lang", "source", "n_chars")
    return M.stable_split(docs, "doc_id")


def q_oversample(spark, sf):
    # bad rows without an id, ids of one range without a label: all are kept
    labels = _t(spark, sf, "labels").select(
        F.when(F.col("quality") == 1, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("doc_id") >= 10, F.col("toxic")).alias("toxic"), F.col("doc_id").alias("row_id"))
    return M.oversample(labels, "toxic", id_col="doc_id")


def _predictions(spark, sf):
    labels = _t(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = _t(spark, sf, "documents").select("doc_id", "text", "n_chars")
    return (labels.join(docs, "doc_id")
                  .withColumn("prediction",
                              F.when(F.col("n_chars") > PREDICTION_MIN_CHARS, 1).otherwise(0)))


def q_binary_metrics(spark, sf):
    m = M.binary_metrics(_predictions(spark, sf))
    return _round_cols(m, ["accuracy", "precision", "recall", "f1"], METRIC_DIGITS)


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_predictions(spark, sf))


def q_sample_predictions(spark, sf):
    # Pick the five ids on the narrow columns first, then fetch only their
    # texts: whole documents never go through a shuffle. The broadcast side
    # is bounded by the limit (5 rows).
    picked = M.sample_rows(_predictions(spark, sf).select("doc_id", "label", "prediction"), 5,
                           id_col="doc_id")
    texts = _t(spark, sf, "documents").select("doc_id", "text")
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label", "prediction")


def q_text_classifier(spark, sf):
    labels = _t(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    data = labels.join(_t(spark, sf, "documents").select("doc_id", F.col("text").alias("song_lyrics")),
                       "doc_id")
    _, preds, _ = M.train_and_evaluate(data, id_col="doc_id")
    return preds.select("doc_id", "label", "prediction")


def _labelled_texts(spark, sf):
    labels = _t(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return labels.join(_t(spark, sf, "documents").select("doc_id", F.col("text").alias("song_lyrics")), "doc_id")


def q_classifier_scores(spark, sf):
    return M.evaluate_naive_bayes(_labelled_texts(spark, sf), "doc_id")


def q_classifier_report(spark, sf):
    data = _labelled_texts(spark, sf)
    return M.classifier_table(data, M.evaluate_naive_bayes(data, "doc_id"))


DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def q_csv_roundtrip(spark, sf):
    docs = _t(spark, sf, "documents").select(*DOC_COLUMNS)
    path = sinks.write_csv(docs, shared_dir(spark, "csv_roundtrip"))
    return readers.read_text_csv(spark, path, schema=docs.schema)


def q_parquet_roundtrip(spark, sf):
    li = _t(spark, sf, "lineitem")
    path = sinks.write_parquet(li, shared_dir(spark, "parquet_roundtrip"), partition_by=["l_returnflag"])
    return readers.read_parquet(spark, path).select(*li.columns)


def q_chart_top_countries(spark, sf):
    return A.top_countries_by_entries(_event_charts(spark, sf))


def q_chart_top_songs_by_country(spark, sf):
    return A.top_per_group(_event_charts(spark, sf))


def q_chart_top_songs_per_day(spark, sf):
    return A.top_per_group(_event_charts(spark, sf), per_snapshot=True)


TRUSTED_ORDER_CHART_COLUMNS = ["spotify_id", "track_name", "artist_name", "daily_rank", "country",
                               "snapshot_date", "popularity", "duration_ms", "acousticness"]


def q_formatted_then_trusted(spark, sf):
    formatted = q_format_charts(spark, sf)
    return Q.trust_charts(formatted, columns=TRUSTED_ORDER_CHART_COLUMNS)


def q_refresh_charts(spark, sf):
    # one event type has no date: such rows reach silver like others
    from tunelake.streaming.refresh import replay_refresh
    charts = _event_charts(spark, sf).withColumn(
        "snapshot_date", F.when(F.col("country") != HISTORY_COUNTRY, F.col("snapshot_date")))
    return replay_refresh(spark, charts)


# Whole tables as landing files, through the zone jobs: two folders per
# dataset, of different column order, one with an extra column.
def _landing_files(spark, layout, name: str, raw: DataFrame, key: str) -> None:
    first = F.coalesce(F.pmod(F.xxhash64(key), F.lit(2)), F.lit(0)) == 0
    columns = [f"`{c}`" for c in raw.columns]
    sinks.write_csv(raw.filter(first).select(F.lit("x").alias("extra"), *columns[::-1]), layout.landing(f"{name}.csv"))
    sinks.write_csv(raw.filter(~first).select(*columns[2:], *columns[:2]), layout.landing(f"{name}-2.csv"))


def _formatted(spark, name: str, raw: DataFrame, key: str, variant: str = "script") -> DataFrame:
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    _landing_files(spark, layout, name, raw, key)
    zones.format_zone(spark, layout, variant, partition_charts=False)
    return spark.read.parquet(layout.formatted(name))


def q_landing_tracks(spark, sf):
    return _formatted(spark, "spotify-tracks-dataset", R.landing_tracks_from_part(_t(spark, sf, "part")), "track_id")


def q_landing_charts(spark, sf):
    return _formatted(spark, "top-spotify-songs-by-country", R.landing_charts_from_orders(_t(spark, sf, "orders")), "spotify_id")


def q_landing_lyrics_text(spark, sf):
    return _formatted(spark, "songs-lyrics", R.raw_lyrics_from_documents(_t(spark, sf, "documents")), "lyrics")


def q_landing_lyrics_url(spark, sf):
    return _formatted(spark, "songs-lyrics", R.landing_lyric_links_from_documents(_t(spark, sf, "documents")), "song_id",
                      variant="notebook")


# Deliveries of the whole order chart as landing folders: a quarter that was
# converted and has gone, one that came with rows of another and comes again
# without, one with an old time stamp, a new one. Months stand for days.
CHARTS = "top-spotify-songs-by-country"


def _monthly_charts(spark, sf):
    raw, date = R.landing_charts_from_orders(_t(spark, sf, "orders")), F.col("snapshot_date")
    return raw.withColumn("snapshot_date", F.when(F.length(date) == 10, F.concat(F.substring(date, 1, 8), F.lit("01"))).otherwise(date))


def _deliver_charts(spark, sf, layout, take_in) -> None:
    raw = _monthly_charts(spark, sf).withColumn("part", F.coalesce(F.pmod(F.xxhash64("spotify_id"), F.lit(4)), F.lit(0)))

    def deliver(part: int, *parts: int) -> str:
        rows = raw.filter(F.col("part").isin(part, *parts)).drop("part")
        return sinks.write_csv(rows, layout.landing(f"{CHARTS}-{part}.csv"))

    first = deliver(0)
    deliver(1, 2)
    take_in()
    readers.delete_path(spark, first)
    deliver(1)
    p, fs = readers.hadoop(spark, deliver(2))
    for status in fs.listStatus(p):
        fs.setTimes(status.getPath(), 1_000_000_000_000, -1)
    deliver(3)


def q_landing_increment(spark, sf):
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    _deliver_charts(spark, sf, layout, lambda: zones.landing_to_parquet(spark, layout, update=True))
    zones.format_zone(spark, layout, update=True, partition_charts=False)
    return readers.read_parquet(spark, layout.formatted(CHARTS))


def q_refresh_raw_charts(spark, sf):
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    _deliver_charts(spark, sf, layout, lambda: zones.refresh_charts_zone(spark, layout))
    zones.refresh_charts_zone(spark, layout)
    return readers.read_parquet(spark, layout.formatted(CHARTS))


def q_bootstrap_charts(spark, sf):
    # no zone yet; a trusted zone whose first run was lost after some tables; both zones whole
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    sinks.write_csv(_monthly_charts(spark, sf), layout.landing(f"{CHARTS}.csv"))
    ran = ["+".join(zones.bootstrap(spark, layout))]
    readers.delete_path(spark, f"{layout.root}/trusted/_SUCCESS")
    sinks.write_parquet(readers.read_parquet(spark, layout.formatted(CHARTS)).limit(0), layout.trusted(CHARTS))
    ran += ["+".join(zones.bootstrap(spark, layout)) for _ in range(2)]
    return readers.read_parquet(spark, layout.trusted(CHARTS)).withColumn("first_runs", F.lit("; ".join(ran)))


def q_fallback_zone(spark, sf):
    # landing alone; landing, formatted, and a trusted table whose write was lost
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    sinks.write_csv(_monthly_charts(spark, sf), layout.landing(f"{CHARTS}.csv"))
    zones.landing_to_parquet(spark, layout, update=True)
    seen = [zones.exploitable(spark, layout, CHARTS, "charts")]
    zones.format_zone(spark, layout, update=True)
    sinks.write_parquet(readers.read_parquet(spark, layout.formatted(CHARTS)).limit(5), layout.trusted(CHARTS))
    readers.delete_path(spark, f"{layout.trusted(CHARTS)}/_SUCCESS")
    seen.append(zones.exploitable(spark, layout, CHARTS, "charts"))
    first, second = (X.visualisation_set(df).withColumn("zone", F.lit(zone)) for df, zone in seen)
    return first.unionByName(second)


# The whole flow (JOB16) over part, orders and documents as the datasets.
def _pipeline(spark, sf):
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    tracks = R.landing_tracks_from_part(_t(spark, sf, "part"))
    # songs and lyrics meet on (artist, title): a brand and a type
    tracks = tracks.withColumn("track_name", F.concat(F.lit('"'), F.col("album_name"), F.lit('"')))
    lyrics = _t(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Unnamed: 0"), F.col("p_brand").alias("artist"),
        F.concat(F.lit(' "'), F.col("p_type"), F.lit('" ')).alias("song_name"), F.lit('one\ntwo "three"').alias("lyrics"))
    _landing_files(spark, layout, "spotify-tracks-dataset", tracks, "track_id")
    _landing_files(spark, layout, "top-spotify-songs-by-country", R.landing_charts_from_orders(_t(spark, sf, "orders")), "spotify_id")
    _landing_files(spark, layout, "songs-lyrics", lyrics, "`Unnamed: 0`")
    zones.format_zone(spark, layout, partition_charts=False)
    return layout, zones.analytics_zone(spark, layout)


def q_pipeline_trends(spark, sf):
    layout, _ = _pipeline(spark, sf)
    return readers.read_text_csv(spark, layout.analytics("chart_trends_over_time"), T.StructType.fromDDL(
        "snapshot_year int, snapshot_month int, chart_entries bigint, unique_tracks bigint"))


def q_pipeline_match_count(spark, sf):
    layout, report = _pipeline(spark, sf)
    written = readers.read_text_csv(spark, layout.analytics("lyrics_tracks_combined")).agg(F.count(F.lit(1)).alias("rows_written"))
    return written.select("rows_written", F.lit(report.counts["lyrics_tracks_combined"]["rows_out"]).cast("bigint").alias("match_count"))


def q_pipeline_top_artists_readback(spark, sf):
    layout, _ = _pipeline(spark, sf)
    return zones.read_back(spark, layout)["top_artists"]


# The flow up to the exploitation zone, over labels and documents as songs and
# lyrics and orders as a chart by month (a folder per date is written).
def _exploitation(spark, sf):
    layout, docs = manifest.ZoneLayout(shared_dir(spark, "zones")), _t(spark, sf, "documents")
    tracks = R.landing_tracks_from_labels(_t(spark, sf, "labels"), docs)
    _landing_files(spark, layout, "spotify-tracks-dataset", tracks, "track_id")
    _landing_files(spark, layout, "songs-lyrics", R.landing_lyrics_from_documents(docs), "`Unnamed: 0`")
    _landing_files(spark, layout, CHARTS, _monthly_charts(spark, sf), "spotify_id")
    zones.format_zone(spark, layout, partition_charts=False)
    return layout, zones.trusted_zone(spark, layout)


def q_pipeline_explicit_set(spark, sf):
    layout, _ = _exploitation(spark, sf)
    zones.exploitation_zone(spark, layout)
    return readers.read_parquet(spark, layout.exploitation("explicit_prediction"))


def q_pipeline_visualisation(spark, sf):
    layout, _ = _exploitation(spark, sf)
    zones.exploitation_zone(spark, layout)
    return readers.read_parquet(spark, layout.exploitation("data_visualization"))


def q_pipeline_trusted_counts(spark, sf):
    # what every constraint of the trusted zone saw and removed, as reported by the writes
    _, report = _exploitation(spark, sf)
    rows = [(step, c["rows_in"], c["rows_out"], c["rows_removed"]) for step, c in sorted(report.counts.items())]
    return spark.createDataFrame(rows, "step string, rows_in bigint, rows_out bigint, rows_removed bigint")


def q_pipeline_trusted_outputs(spark, sf):
    # analyses over the trusted zone: every table there is, with its rows; the
    # tracks have no release year, so that analysis leaves none (FLT7)
    layout, _ = _exploitation(spark, sf)
    report = zones.analytics_zone(spark, layout, zone="trusted")
    counted = [readers.read_text_csv(spark, path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("analysis"), "rows")
               for name, path in sorted(report.written.items())]
    return reduce(DataFrame.unionByName, counted)


def q_pipeline_countries_inferred(spark, sf):
    # SRC4: types found in the written CSV; the order as a column
    layout, _ = _exploitation(spark, sf)
    zones.analytics_zone(spark, layout)
    out = zones.read_back(spark, layout)["top_countries_by_entries"]
    return A.numbered(out, F.desc_nulls_last("chart_entries"), F.asc_nulls_first("country")).select(
        "position", "country", F.col("chart_entries").cast("bigint"), F.col("unique_tracks").cast("bigint"),
        F.lit(", ".join(t for _, t in out.dtypes)).alias("types"))


def q_renamed_lyrics(spark, sf):
    # PRJ7: the notebook form names the title song_name, the trusted table track_name
    layout = manifest.ZoneLayout(shared_dir(spark, "zones"))
    _landing_files(spark, layout, "songs-lyrics", R.raw_lyrics_from_documents(_t(spark, sf, "documents")), "lyrics")
    zones.format_zone(spark, layout, "notebook")
    zones.trusted_zone(spark, layout)
    return readers.read_parquet(spark, layout.trusted("songs-lyrics"))


def q_numbered_artists(spark, sf):
    return A.numbered(q_top_artists_cents(spark, sf), F.desc("avg_popularity"), F.asc_nulls_first("o_custkey"))


def q_numbered_trends(spark, sf):
    return A.numbered(q_chart_trends_over_time(spark, sf), F.asc_nulls_first("snapshot_year"), F.asc_nulls_first("snapshot_month"))


def q_numbered_history(spark, sf):
    # TOP7: the slots of the history in the order of its frames
    history = q_chart_history(spark, sf).withColumnRenamed("position", "slot")
    return A.numbered(history, F.asc("snapshot_date"), F.asc("slot"))


def q_split_class_guard(spark, sf):
    # ML3 on both labels; rarer and rarer classes, down to none
    labels = _t(spark, sf, "labels")
    split = M.stable_split(labels, "doc_id").withColumns({"bad_toxic": F.when((F.col("toxic") == 1) & (F.col("quality") == 0), 1).otherwise(0),
                                                           "neither": F.col("toxic") * 0})
    reports = [M.split_classes(split, label_col=c).withColumnRenamed(c, "label").withColumn("of", F.lit(c))
               for c in ("toxic", "quality", "bad_toxic", "neither")]
    return reduce(DataFrame.unionByName, reports)


def q_preview_documents(spark, sf):
    # SNK5: the head as the console prints it, next to the schema print
    docs = _t(spark, sf, "documents").orderBy(F.asc_nulls_first("doc_id"))
    head = sinks.preview_text(docs, 20).withColumn("part", F.lit("head"))
    schema = sinks.schema_table(docs).select(F.col("place").cast("string").alias("doc_id"), F.col("column_name").alias("text"),
                                             F.col("type").alias("lang"), F.lit("").alias("source"), F.lit("").alias("n_chars"), F.lit("schema").alias("part"))
    return head.unionByName(schema)


def q_join_string_keys(spark, sf):
    # many lyrics and many tracks per (artist, title); the artist carries the
    # suffix that JN3/FN5 removes from the join key
    part = _t(spark, sf, "part")
    lyrics = part.select(F.concat(F.col("p_brand"), F.lit(S.LYRICS_ARTIST_SUFFIX)).alias("artist_name"),
                         F.col("p_name").alias("track_name"), F.col("p_partkey").cast("string").alias("song_lyrics"))
    tracks = part.select(F.upper("p_brand").alias("artist_name"), F.col("p_name").alias("track_name"),
                         (F.col("p_size") > 25).alias("explicit"))
    return X.explicit_prediction(lyrics, tracks, on=[("artist_name", "artist_name"), ("track_name", "track_name")], normalise_keys=True)


def q_argmax_labels(spark, sf):
    # FN16 on two scores, ML1 on labels kept as text
    li = _t(spark, sf, "labels")
    text = li.select("doc_id", F.when(F.col("toxic") == 1, "True").when(F.col("quality") == 1, "false").otherwise("n/a").alias("explicit"),
                     F.col("quality").cast("double").alias("s0"), F.col("toxic").cast("double").alias("s1"))
    scored = text.select("doc_id", M.argmax_prediction("s0", "s1").alias("prediction"))
    return M.label_projection(text, "doc_id", "explicit").join(scored, "doc_id")


def q_trusted_lyrics(spark, sf):
    # JOB6 over documents as lyrics: required columns, one row per id
    docs = _t(spark, sf, "documents").select(
        (F.col("n_chars") % 1000).cast("int").alias("song_id"), F.col("source").alias("artist_name"),
        F.col("lang").alias("track_name"), F.when(F.col("lang") != "es", F.col("text")).alias("song_lyrics"))
    return Q.trust_lyrics(docs)


QUERIES: dict[str, Query] = {
    "top_artists": q_top_artists,
    "top_artists_cents": q_top_artists_cents,
    "top_countries_by_entries": q_top_countries_by_entries,
    "top_artists_global": q_top_artists_global,
    "top_songs_by_country": q_top_songs_by_country,
    "chart_trends_over_time": q_chart_trends_over_time,
    "average_features": q_average_features,
    "corr_null_as_zero": q_corr_null_as_zero,
    "corr_null_skipped": q_corr_null_skipped,
    "corr_abs_ranking": q_corr_abs_ranking,
    "top_by_price": _top_by("l_extendedprice"),
    "top_by_tax": _top_by("l_tax"),
    "top_by_discount": _top_by("l_discount"),
    "songs_by_year": q_songs_by_year,
    "lyrics_tracks_join": q_lyrics_tracks_join,
    "explicit_prediction": q_explicit_prediction,
    "visualisation_export": q_visualisation_export,
    "format_tracks": q_format_tracks,
    "format_charts": q_format_charts,
    "format_lyrics": q_format_lyrics,
    "name_normalise": q_name_normalise,
    "strip_special": q_strip_special,
    "fold_accents": q_fold_accents,
    "trust_min_duration": q_trust_min_duration,
    "unique_rank": q_unique_rank,
    "unique_rank_then_title": q_unique_rank_then_title,
    "unique_id": q_unique_id,
    "violation_report": q_violation_report,
    "chart_history": q_chart_history,
    "new_entries": q_new_entries,
    "history_new_entries": q_history_new_entries,
    "class_balance": q_class_balance,
    "stable_split": q_stable_split,
    "oversample": q_oversample,
    "binary_metrics": q_binary_metrics,
    "confusion_matrix": q_confusion_matrix,
    "sample_predictions": q_sample_predictions,
    "text_classifier": q_text_classifier,
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "refresh_charts": q_refresh_charts,
    "chart_top_countries": q_chart_top_countries,
    "chart_top_songs_by_country": q_chart_top_songs_by_country,
    "chart_top_songs_per_day": q_chart_top_songs_per_day,
    "formatted_then_trusted": q_formatted_then_trusted,
    "landing_tracks": q_landing_tracks,
    "landing_charts": q_landing_charts,
    "landing_lyrics_text": q_landing_lyrics_text,
    "landing_lyrics_url": q_landing_lyrics_url,
    "pipeline_trends": q_pipeline_trends,
    "pipeline_match_count": q_pipeline_match_count,
    "pipeline_top_artists_readback": q_pipeline_top_artists_readback,
    "join_string_keys": q_join_string_keys,
    "argmax_labels": q_argmax_labels,
    "trusted_lyrics": q_trusted_lyrics,
    "classifier_scores": q_classifier_scores,
    "classifier_report": q_classifier_report,
    "landing_increment": q_landing_increment,
    "refresh_raw_charts": q_refresh_raw_charts,
    "bootstrap_charts": q_bootstrap_charts,
    "fallback_zone": q_fallback_zone,
    "pipeline_explicit_set": q_pipeline_explicit_set,
    "pipeline_visualisation": q_pipeline_visualisation,
    "pipeline_trusted_counts": q_pipeline_trusted_counts,
    "pipeline_trusted_outputs": q_pipeline_trusted_outputs,
    "pipeline_countries_inferred": q_pipeline_countries_inferred,
    "renamed_lyrics": q_renamed_lyrics,
    "numbered_artists": q_numbered_artists,
    "numbered_trends": q_numbered_trends,
    "numbered_history": q_numbered_history,
    "split_class_guard": q_split_class_guard,
    "preview_documents": q_preview_documents,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _corr_sql(nulls: str) -> str:
    parts = []
    for f in CORR_FEATURES:
        fx = "CASE WHEN l_discount <> 0 THEN l_discount END" if f == "l_discount" else f
        if nulls == "zero":
            a, b = "COALESCE(l_quantity, 0.0)", f"COALESCE({fx}, 0.0)"
        else:
            both = f"l_quantity IS NOT NULL AND ({fx}) IS NOT NULL"
            a, b = f"CASE WHEN {both} THEN l_quantity END", f"CASE WHEN {both} THEN {fx} END"
        parts.append(f"SELECT '{f}' AS feature, {_rnd(_pearson_sql(a, b), CORR_DIGITS)} "
                     f"AS correlation_with_popularity FROM lineitem")
    return "\nUNION ALL\n".join(parts)


def _top_by_sql(feature: str) -> str:
    return (f"SELECT l_orderkey, l_linenumber, {feature}, l_quantity FROM lineitem "
            f"ORDER BY {feature} DESC NULLS LAST, l_orderkey ASC NULLS FIRST, "
            f"l_linenumber ASC NULLS FIRST, l_quantity ASC NULLS FIRST LIMIT 10")


_EVENT_CHARTS = f"c AS ({R.CHARTS_FROM_EVENTS_SQL})"
_WIN2 = ("QUALIFY row_number() OVER (PARTITION BY snapshot_date, country, daily_rank "
         "ORDER BY track_name ASC NULLS FIRST, spotify_id ASC NULLS FIRST, "
         "artist_name ASC NULLS FIRST, popularity ASC NULLS FIRST) = 1")
_WIN3 = ("QUALIFY row_number() OVER (PARTITION BY artist_name, country, track_name, snapshot_date "
         "ORDER BY track_name ASC NULLS FIRST, spotify_id ASC NULLS FIRST, "
         "daily_rank ASC NULLS FIRST, popularity ASC NULLS FIRST) = 1")
_UNIQUE_RANK_THEN_TITLE = (f"WITH {_EVENT_CHARTS}, s1 AS (SELECT * FROM c {_WIN2}) "
                           f"SELECT * FROM s1 {_WIN3}")

_PREDICTIONS = (f"p AS (SELECT l.doc_id, l.toxic AS label, d.text, d.n_chars, "
                f"CASE WHEN d.n_chars > {PREDICTION_MIN_CHARS} THEN 1 ELSE 0 END AS prediction "
                f"FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")
_CONFUSION = ("cnt AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp, "
              "CAST(count_if(label <> 1 AND prediction = 1) AS BIGINT) AS fp, "
              "CAST(count_if(label = 1 AND prediction <> 1) AS BIGINT) AS fn, "
              "CAST(count_if(label <> 1 AND prediction <> 1) AS BIGINT) AS tn FROM p)")


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"


def _md5_bucket(id_expr: str, buckets: int) -> str:
    return f"(('0x' || substr(md5('{S.SPLIT_SEED}:' || CAST({id_expr} AS VARCHAR)), 1, 8))::BIGINT % {buckets})"


def _typed(spec) -> str:
    """The casts of the last columns of a spec, names kept."""
    duck = {"double": "DOUBLE", "boolean": "BOOLEAN"}
    return ", ".join(f"{_lenient_int(c.source, 'BIGINT' if c.dtype == 'bigint' else 'INTEGER')} AS {c.target}"
                     if c.dtype in ("int", "bigint") else f"TRY_CAST({c.source} AS {duck[c.dtype]}) AS {c.target}" for c in spec)


_FORMATTED_CHARTS_CTES = f"""
        raw AS ({R.RAW_CHARTS_FROM_ORDERS_SQL}),
        p AS (
          SELECT spotify_id, name AS track_name, artists AS artist_name,
                 COALESCE({_lenient_int('daily_rank')}, 0) AS daily_rank,
                 upper(trim(regexp_replace(country, '\\s+', ' ', 'g'))) AS country,
                 CAST(try_strptime(snapshot_date, '%Y-%m-%d') AS DATE) AS snapshot_date,
                 COALESCE({_lenient_int('popularity')}, 0) AS popularity,
                 COALESCE({_lenient_int('duration_ms', 'BIGINT')}, 0) AS duration_ms,
                 CAST(try_strptime(album_release_date, '%Y-%m-%d') AS DATE) AS album_release_date,
                 CASE WHEN isnan(TRY_CAST(acousticness AS DOUBLE)) THEN 0.0
                      ELSE COALESCE(TRY_CAST(acousticness AS DOUBLE), 0.0) END AS acousticness
          FROM raw),
        f AS (
          SELECT *, CAST(year(snapshot_date) AS INTEGER) AS snapshot_year,
                 CAST(month(snapshot_date) AS INTEGER) AS snapshot_month,
                 CAST(day(snapshot_date) AS INTEGER) AS snapshot_day
          FROM p WHERE track_name IS NOT NULL)"""


_CHART_HISTORY = f"""
        WITH rows AS (
          SELECT CAST(ts AS DATE) AS snapshot_date, CAST(user_id AS INTEGER) AS position,
                 COALESCE(regexp_replace(props, '{SPECIAL_CHARS_PATTERN}', '', 'g'), '') AS track_name,
                 COALESCE(regexp_replace(event_type, '{SPECIAL_CHARS_PATTERN}', '', 'g'), '') AS artist_name,
                 event_type AS country
          FROM events
          WHERE event_type = '{HISTORY_COUNTRY}'
            AND CAST(ts AS DATE) BETWEEN DATE '{HISTORY_START}' AND DATE '{HISTORY_END}'
            AND CAST(user_id AS INTEGER) <= {S.CHART_SLOTS}),
        keyed AS (SELECT *, track_name || ' - ' || artist_name AS song_id,
                         CAST({S.CHART_SLOTS + 1} - position AS INTEGER) AS rank_value FROM rows),
        taken AS (SELECT * FROM keyed QUALIFY row_number() OVER (
                    PARTITION BY snapshot_date, position ORDER BY track_name, artist_name, country,
                    song_id, rank_value) = 1),
        grid AS (SELECT d.snapshot_date, CAST(g.position AS INTEGER) AS position
                 FROM (SELECT DISTINCT snapshot_date FROM rows) d,
                      (SELECT unnest(range(1, {S.CHART_SLOTS + 1})) AS position) g),
        complete AS (SELECT g.snapshot_date, g.position, t.track_name, t.artist_name, t.country,
                            t.song_id, t.rank_value
                     FROM grid g LEFT JOIN taken t
                       ON g.snapshot_date = t.snapshot_date AND g.position = t.position),
        firsts AS (SELECT *, CASE WHEN song_id IS NOT NULL
                                  THEN min(snapshot_date) OVER (PARTITION BY song_id) END AS first_appearance
                   FROM complete)
        SELECT snapshot_date, position, track_name, artist_name, country,
               COALESCE(song_id, '') AS song_id, COALESCE(rank_value, 0) AS rank_value, first_appearance,
               COALESCE(snapshot_date = first_appearance, false) AS is_new
        FROM firsts"""


def _new_entries_sql(source: str, date_expr: str, song_expr: str) -> str:
    return f"""
        WITH present AS (SELECT DISTINCT {date_expr} AS snapshot_date, {song_expr} AS song_id
                         FROM {source} src
                         WHERE {song_expr} IS NOT NULL AND CAST({song_expr} AS VARCHAR) <> ''),
        dates AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prev_date
                  FROM (SELECT DISTINCT snapshot_date FROM present)),
        cand AS (SELECT p.snapshot_date, p.song_id, d.prev_date FROM present p
                 JOIN dates d ON p.snapshot_date = d.snapshot_date WHERE d.prev_date IS NOT NULL)
        SELECT snapshot_date, song_id, prev_date FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM present q WHERE q.snapshot_date = c.prev_date
                                                     AND q.song_id = c.song_id)"""


_SCORES_SQL = f"""
docs AS (SELECT l.doc_id, l.toxic AS label, d.text, {_md5_bucket('l.doc_id', M.SPLIT_BUCKETS)} AS place
         FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
words AS (SELECT doc_id, label, place, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+')) AS token FROM docs),
counts AS (SELECT token, CAST(count_if(label = 0) AS BIGINT) AS n0, CAST(count_if(label = 1) AS BIGINT) AS n1
           FROM words WHERE place < 7000 AND label IN (0, 1) GROUP BY token),
totals AS (SELECT sum(n0) AS t0, sum(n1) AS t1, count(*) AS v FROM counts),
settings(k, a, least) AS (VALUES {', '.join(f'({k}, CAST({a} AS DOUBLE), CAST({m} AS DOUBLE))' for k, (a, m) in enumerate(M.NAIVE_BAYES_SETTINGS))}),
weights AS (SELECT * FROM (
    SELECT k, token, least, CAST(round((ln((n1 + a) / (t1 + a * v)) - ln((n0 + a) / (t0 + a * v))) * {M.LOG_UNIT}.0) AS BIGINT) AS weight
    FROM counts, totals, settings) WHERE abs(weight) >= least * {M.LOG_UNIT}),
sums AS (SELECT k, doc_id, CAST(sum(weight) AS BIGINT) AS score FROM words JOIN weights USING (token) WHERE place >= 7000 GROUP BY k, doc_id),
scored AS (SELECT s.k, docs.doc_id, label, place, coalesce(score, 0) AS score
           FROM docs CROSS JOIN settings s LEFT JOIN sums ON docs.doc_id = sums.doc_id AND s.k = sums.k WHERE place >= 7000),
chosen AS (SELECT k FROM scored WHERE place < 8500 GROUP BY k
           ORDER BY coalesce(2.0 * count_if(label = 1 AND score > 0) / nullif(count_if(label = 1) + count_if(score > 0), 0), 0) DESC, k LIMIT 1),
p AS (SELECT doc_id, label, score, CASE WHEN score > 0 THEN 1 ELSE 0 END AS prediction FROM scored JOIN chosen USING (k) WHERE place >= 8500)"""


def _landing_charts_sql(raw: str) -> str:
    return f"""
        WITH raw AS ({raw}),
        p AS (
          SELECT spotify_id, name AS track_name, artists AS artist_name, COALESCE({_lenient_int('daily_rank')}, 0) AS daily_rank,
                 daily_movement, weekly_movement, upper(trim(regexp_replace(country, '\\s+', ' ', 'g'))) AS country,
                 CAST(try_strptime(snapshot_date, '%Y-%m-%d') AS DATE) AS snapshot_date,
                 COALESCE({_lenient_int('popularity')}, 0) AS popularity, is_explicit,
                 COALESCE({_lenient_int('duration_ms', 'BIGINT')}, 0) AS duration_ms, album_name,
                 CAST(try_strptime(album_release_date, '%Y-%m-%d') AS DATE) AS album_release_date,
                 danceability, energy, key, loudness, mode, speechiness,
                 {", ".join(f"COALESCE(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in
                            ("acousticness", "instrumentalness", "liveness", "valence", "tempo", "time_signature"))}
          FROM raw)
        SELECT *, CAST(year(snapshot_date) AS INTEGER) AS snapshot_year, CAST(month(snapshot_date) AS INTEGER) AS snapshot_month,
               CAST(day(snapshot_date) AS INTEGER) AS snapshot_day
        FROM p WHERE track_name IS NOT NULL"""


_MONTHLY_CHARTS_SQL = f"""
SELECT * REPLACE (CASE WHEN length(snapshot_date) = 10 THEN substr(snapshot_date, 1, 8) || '01' ELSE snapshot_date END AS snapshot_date)
FROM ({R.LANDING_CHARTS_SQL})"""


def _first_sql(keys: list[str], order: list[str], columns=S.TRUSTED_CHARTS_COLUMNS) -> str:
    rest = order + [c for c in columns if c not in keys and c not in order]
    return (f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in rest) + ") = 1")


# The zones of the exploitation flow.
_TRUSTED_SQL = f"""
songs AS (SELECT d.doc_id, d.source, d.text, l.quality, l.toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
tracks AS (SELECT * FROM songs WHERE source IS NOT NULL AND quality = 1),
lyrics AS (SELECT * FROM documents WHERE doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL),
charts AS ({_landing_charts_sql(_MONTHLY_CHARTS_SQL)}),
c0 AS (SELECT {', '.join(S.TRUSTED_CHARTS_COLUMNS)} FROM charts),
c1 AS (SELECT * FROM c0 WHERE track_name IS NOT NULL AND artist_name IS NOT NULL),
c2 AS (SELECT * FROM c1 {_first_sql(['snapshot_date', 'country', 'daily_rank'], ['track_name'])}),
c3 AS (SELECT * FROM c2 {_first_sql(['artist_name', 'country', 'track_name', 'snapshot_date'], [])})"""


def _step_sql(step: str, before: str, after: str) -> str:
    n, m = f"(SELECT count(*) FROM {before})", f"(SELECT count(*) FROM {after})"
    return f"SELECT '{step}' AS step, {n} AS rows_in, {m} AS rows_out, {n} - {m} AS rows_removed"


def _split_classes_sql(name: str, expr: str) -> str:
    place = _md5_bucket("doc_id", M.SPLIT_BUCKETS)
    return f"""
        SELECT s.split, CAST(c.label AS INTEGER) AS label, count(d.label) AS rows, min(count(d.label)) OVER (PARTITION BY s.split) > 0 AS complete,
               '{name}' AS of
        FROM (VALUES ('train'), ('validation'), ('test')) s(split) CROSS JOIN (VALUES (0), (1)) c(label)
        LEFT JOIN (SELECT {expr} AS label, CASE WHEN {place} < 7000 THEN 'train' WHEN {place} < 8500 THEN 'validation' ELSE 'test' END AS split
                   FROM labels) d ON d.split = s.split AND d.label = c.label
        GROUP BY s.split, c.label"""


def _console(column: str) -> str:
    text = f"coalesce(CAST({column} AS VARCHAR), 'NULL')"
    return f"CASE WHEN length({text}) > 20 THEN substr({text}, 1, 17) || '...' ELSE {text} END AS {column}"


_ROW_NUMBER = "CAST(row_number() OVER (ORDER BY {}) AS BIGINT) AS position"

ORACLE_SQL: dict[str, str] = {
    "pipeline_explicit_set": f"WITH {_TRUSTED_SQL} SELECT l.text AS song_lyrics, t.toxic = 1 AS explicit FROM lyrics l JOIN tracks t ON l.doc_id = t.doc_id",
    "pipeline_visualisation": f"WITH {_TRUSTED_SQL} SELECT {', '.join(S.VISUALISATION_COLUMNS)} FROM c3",
    "pipeline_trusted_counts": f"WITH {_TRUSTED_SQL} " + " UNION ALL ".join([
        _step_sql("spotify-tracks-dataset", "songs", "tracks"), _step_sql("songs-lyrics", "documents", "lyrics"), _step_sql(CHARTS, "c0", "c3"),
        _step_sql(f"{CHARTS}:required_columns", "c0", "c1"), _step_sql(f"{CHARTS}:unique_chart_slot", "c1", "c2"),
        _step_sql(f"{CHARTS}:unique_artist_title", "c2", "c3")]),
    "pipeline_trusted_outputs": f"""
        WITH {_TRUSTED_SQL},
        artists AS (SELECT source FROM tracks GROUP BY source HAVING count(*) >= {S.MIN_TRACKS_PER_ARTIST})
        SELECT 'top_artists' AS analysis, count(*) AS rows FROM artists
        UNION ALL SELECT unnest(['feature_correlations', 'feature_popularity_correlation']), {len(S.AUDIO_FEATURES)}
        UNION ALL SELECT 'average_audio_features', 1
        UNION ALL SELECT unnest(['most_danceable_songs', 'most_energetic_songs', 'most_acoustic_songs']), least(count(*), {S.TOP_N}) FROM tracks
        UNION ALL SELECT 'top_countries_by_entries', least(count(DISTINCT coalesce(country, '')), {S.TOP_N}) FROM c3
        UNION ALL SELECT 'top_artists_global', least(count(DISTINCT artist_name), {S.TOP_N}) FROM c3
        UNION ALL SELECT 'top_songs_by_country', count(*) FROM (
            SELECT dense_rank() OVER (PARTITION BY country ORDER BY daily_rank ASC NULLS FIRST) AS place FROM c3) WHERE place <= {S.TOP_RANKS_PER_COUNTRY}
        UNION ALL SELECT 'chart_trends_over_time', count(*) FROM (SELECT DISTINCT year(snapshot_date), month(snapshot_date) FROM c3)""",
    "pipeline_countries_inferred": f"""
        WITH {_TRUSTED_SQL}, n AS (SELECT country, count(*) AS chart_entries, count(DISTINCT track_name) AS unique_tracks FROM charts GROUP BY country),
        top AS (SELECT *, {_ROW_NUMBER.format('chart_entries DESC, country ASC NULLS FIRST')} FROM n)
        SELECT *, 'string, int, int' AS types FROM top WHERE position <= {S.TOP_N}""",
    "renamed_lyrics": f"""
        WITH raw AS ({R.RAW_LYRICS_FROM_DOCUMENTS_SQL}),
        p AS (SELECT {_lenient_int('"Unnamed: 0"')} AS song_id, trim(artist) AS artist_name, trim(song_name) AS track_name, lyrics AS song_lyrics FROM raw)
        SELECT * FROM p WHERE song_id IS NOT NULL AND artist_name IS NOT NULL AND track_name IS NOT NULL AND song_lyrics IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY artist_name, track_name, song_lyrics) = 1""",
    "numbered_artists": f"""
        WITH n AS (SELECT o_custkey, {_rnd('avg(o_totalprice)', 2)} AS avg_popularity, count(o_orderkey) AS track_count
                   FROM orders GROUP BY o_custkey HAVING count(o_orderkey) >= {S.MIN_TRACKS_PER_ARTIST})
        SELECT *, {_ROW_NUMBER.format('avg_popularity DESC, o_custkey ASC NULLS FIRST')} FROM n""",
    "numbered_trends": f"""
        WITH n AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS snapshot_year, CAST(month(o_orderdate) AS INTEGER) AS snapshot_month,
                          count(*) AS chart_entries, count(DISTINCT o_custkey) AS unique_tracks FROM orders GROUP BY 1, 2)
        SELECT *, {_ROW_NUMBER.format('snapshot_year ASC NULLS FIRST, snapshot_month ASC NULLS FIRST')} FROM n""",
    "numbered_history": f"""
        SELECT * EXCLUDE (position), position AS slot, {_ROW_NUMBER.format('snapshot_date, h.position')} FROM ({_CHART_HISTORY}) h""",
    "split_class_guard": " UNION ALL ".join(_split_classes_sql(name, expr) for name, expr in [
        ("toxic", "toxic"), ("quality", "quality"), ("bad_toxic", "CASE WHEN toxic = 1 AND quality = 0 THEN 1 ELSE 0 END"), ("neither", "toxic * 0")]),
    "preview_documents": f"""
        SELECT {', '.join(_console(c) for c in DOC_COLUMNS)}, 'head' AS part FROM (SELECT * FROM documents ORDER BY doc_id NULLS FIRST LIMIT 20)
        UNION ALL SELECT * FROM (VALUES ('1', 'doc_id', 'bigint', '', '', 'schema'), ('2', 'text', 'string', '', '', 'schema'),
                  ('3', 'lang', 'string', '', '', 'schema'), ('4', 'source', 'string', '', '', 'schema'), ('5', 'n_chars', 'bigint', '', '', 'schema'))""",
    "top_artists": f"""
        SELECT l_suppkey, {_rnd('avg(l_quantity)', 2)} AS avg_popularity, count(l_orderkey) AS track_count
        FROM lineitem GROUP BY l_suppkey HAVING count(l_orderkey) >= {S.MIN_TRACKS_PER_ARTIST}""",
    "top_artists_cents": f"""
        SELECT o_custkey, {_rnd('avg(o_totalprice)', 2)} AS avg_popularity, count(o_orderkey) AS track_count
        FROM orders GROUP BY o_custkey HAVING count(o_orderkey) >= {S.MIN_TRACKS_PER_ARTIST}""",
    "top_countries_by_entries": """
        SELECT n_name, count(*) AS chart_entries, count(DISTINCT o_custkey) AS unique_tracks
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY chart_entries DESC, n_name ASC LIMIT 10""",
    "top_artists_global": """
        SELECT p_brand, count(*) AS chart_appearances, count(DISTINCT l_suppkey) AS countries_charted
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_brand ORDER BY chart_appearances DESC, p_brand ASC LIMIT 10""",
    "top_songs_by_country": """
        SELECT * FROM (
          SELECT c_nationkey, c_name, c_mktsegment, c_acctbal,
                 CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST)
                      AS INTEGER) AS rank_in_country
          FROM customer) WHERE rank_in_country <= 5""",
    "chart_trends_over_time": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS snapshot_year,
               CAST(month(o_orderdate) AS INTEGER) AS snapshot_month,
               count(*) AS chart_entries, count(DISTINCT o_custkey) AS unique_tracks
        FROM orders GROUP BY 1, 2""",
    "average_features": "SELECT " + ", ".join(
        f"{_rnd(f'avg({c})', MEAN_DIGITS)} AS avg_{c}" for c in ["l_quantity", *CORR_FEATURES]
    ) + " FROM lineitem",
    "corr_null_as_zero": _corr_sql("zero"),
    "corr_null_skipped": _corr_sql("skip"),
    "corr_abs_ranking": f"""
        SELECT feature, correlation_with_popularity,
               CAST(row_number() OVER (ORDER BY abs(correlation_with_popularity) DESC NULLS LAST,
                                       feature ASC) AS INTEGER) AS abs_rank
        FROM ({_corr_sql('skip')})""",
    "top_by_price": _top_by_sql("l_extendedprice"),
    "top_by_tax": _top_by_sql("l_tax"),
    "top_by_discount": _top_by_sql("l_discount"),
    "songs_by_year": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year, count(*) AS song_count,
               {_rnd('avg(o_custkey)', MEAN_DIGITS)} AS avg_popularity
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""",
    "lyrics_tracks_join": """
        SELECT o_orderkey AS lyrics_orderkey, o_orderstatus AS lyrics_status,
               o_orderpriority AS lyrics_priority,
               l_orderkey, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus""",
    "explicit_prediction": """
        SELECT d.text AS song_lyrics, l.toxic AS explicit
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "visualisation_export": f"""
        WITH {_EVENT_CHARTS}
        SELECT track_name, artist_name, daily_rank, snapshot_date, country FROM c""",
    "format_tracks": f"""
        WITH raw AS ({R.RAW_TRACKS_FROM_PART_SQL})
        SELECT track_id, track_name, artists AS artist_name, album_name,
               {_lenient_int('popularity')} AS popularity,
               {_lenient_int('duration_ms', 'BIGINT')} AS duration_ms,
               TRY_CAST(explicit AS BOOLEAN) AS explicit,
               TRY_CAST(danceability AS DOUBLE) AS danceability,
               {_lenient_int('key')} AS key
        FROM raw WHERE track_id IS NOT NULL AND track_name IS NOT NULL""",
    "format_charts": f"WITH {_FORMATTED_CHARTS_CTES} SELECT * FROM f",
    "format_lyrics": f"""
        WITH raw AS ({R.RAW_LYRICS_FROM_DOCUMENTS_SQL}),
        p AS (SELECT {_lenient_int('"Unnamed: 0"')} AS song_id, trim(artist) AS artist_name,
                     trim(song_name) AS track_name, lyrics AS song_lyrics FROM raw)
        SELECT * FROM p WHERE song_id IS NOT NULL AND track_name IS NOT NULL""",
    "name_normalise": "SELECT doc_id, lower(trim(text)) AS text_key FROM documents",
    "strip_special": f"""
        SELECT doc_id, COALESCE(regexp_replace(text, '{SPECIAL_CHARS_PATTERN}', '', 'g'), '') AS text_clean
        FROM documents""",
    "fold_accents": "SELECT doc_id, strip_accents(text) AS text_folded FROM documents",
    "trust_min_duration": f"""
        SELECT {', '.join(TRUST_LINEITEM_COLUMNS)} FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
          AND l_extendedprice >= {S.MIN_DURATION_MS}""",
    "unique_rank": f"WITH {_EVENT_CHARTS} SELECT * FROM c {_WIN2}",
    "unique_rank_then_title": _UNIQUE_RANK_THEN_TITLE,
    "unique_id": """
        SELECT * FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id ASC NULLS FIRST, lang ASC NULLS FIRST,
                                   source ASC NULLS FIRST, n_chars ASC NULLS FIRST) = 1""",
    "violation_report": f"""
        WITH {_EVENT_CHARTS}, s1 AS (SELECT * FROM c {_WIN2}), s2 AS (SELECT * FROM s1 {_WIN3}),
        n AS (SELECT (SELECT count(*) FROM c) AS n0, (SELECT count(*) FROM s1) AS n1,
                     (SELECT count(*) FROM s2) AS n2)
        SELECT CAST(1 AS INTEGER) AS step, 'unique_chart_slot' AS constraint_name,
               n0 AS rows_in, n1 AS rows_kept, n0 - n1 AS rows_removed FROM n
        UNION ALL
        SELECT CAST(2 AS INTEGER), 'unique_artist_title', n1, n2, n1 - n2 FROM n""",
    "chart_history": _CHART_HISTORY,
    "new_entries": _new_entries_sql("events", "CAST(ts AS DATE)", "user_id"),
    "history_new_entries": _new_entries_sql(f"({_CHART_HISTORY})", "snapshot_date", "song_id"),
    "class_balance": "SELECT toxic, count(*) AS count FROM labels GROUP BY toxic",
    "stable_split": f"""
        WITH d AS (SELECT CASE WHEN lang <> 'de' THEN doc_id END AS doc_id, lang, source, n_chars FROM documents),
        k AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), concat_ws(chr(31), 'null', lang, source, n_chars)) AS id FROM d)
        SELECT doc_id, lang, source, n_chars,
               CASE WHEN {_md5_bucket('id', M.SPLIT_BUCKETS)} < 7000 THEN 'train'
                    WHEN {_md5_bucket('id', M.SPLIT_BUCKETS)} < 8500 THEN 'validation'
                    ELSE 'test' END AS split
        FROM k""",
    "oversample": f"""
        WITH l AS (SELECT CASE WHEN quality = 1 THEN doc_id END AS doc_id, CASE WHEN doc_id >= 10 THEN toxic END AS toxic,
                          doc_id AS row_id FROM labels),
        t AS (SELECT *, md5('{S.SPLIT_SEED}:' || coalesce(CAST(doc_id AS VARCHAR),
                                concat_ws(chr(31), 'null', toxic, row_id))) AS k FROM l),
        n AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY k, doc_id NULLS FIRST, row_id) AS idx,
                     count(*) OVER (PARTITION BY toxic) AS class_n FROM t WHERE toxic IS NOT NULL),
        m AS (SELECT *, max(class_n) OVER () AS target FROM n),
        c AS (SELECT doc_id, toxic, row_id, CAST(floor(target / class_n) AS BIGINT)
                     + CASE WHEN idx <= target % class_n THEN 1 ELSE 0 END AS copies FROM m)
        SELECT doc_id, toxic, row_id, CAST(unnest(generate_series(1, copies)) AS INTEGER) AS replica FROM c
        UNION ALL SELECT doc_id, toxic, row_id, 1 FROM t WHERE toxic IS NULL""",
    "binary_metrics": f"""
        WITH {_PREDICTIONS}, {_CONFUSION}
        SELECT {_rnd(_ratio('tp + tn', 'tp + tn + fp + fn'), METRIC_DIGITS)} AS accuracy,
               {_rnd(_ratio('tp', 'tp + fp'), METRIC_DIGITS)} AS precision,
               {_rnd(_ratio('tp', 'tp + fn'), METRIC_DIGITS)} AS recall,
               {_rnd(_ratio('2 * tp', '2 * tp + fp + fn'), METRIC_DIGITS)} AS f1
        FROM cnt""",
    "confusion_matrix": f"""
        WITH {_PREDICTIONS}, {_CONFUSION}
        SELECT 1 AS label, 1 AS prediction, tp AS count FROM cnt UNION ALL
        SELECT 0, 1, fp FROM cnt UNION ALL
        SELECT 1, 0, fn FROM cnt UNION ALL
        SELECT 0, 0, tn FROM cnt""",
    "sample_predictions": f"""
        WITH {_PREDICTIONS}
        SELECT doc_id, text, label, prediction FROM p
        ORDER BY md5('{S.SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), doc_id, text, label, prediction
        LIMIT 5""",
    "csv_roundtrip": f"SELECT {', '.join(DOC_COLUMNS)} FROM documents",
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "refresh_charts": _UNIQUE_RANK_THEN_TITLE.replace(
        _EVENT_CHARTS, f"c AS (SELECT * REPLACE (CASE WHEN country <> '{HISTORY_COUNTRY}' THEN snapshot_date END "
                       f"AS snapshot_date) FROM ({R.CHARTS_FROM_EVENTS_SQL}))"),
    "chart_top_countries": f"""
        WITH {_EVENT_CHARTS}
        SELECT country, count(*) AS chart_entries, count(DISTINCT track_name) AS unique_tracks
        FROM c GROUP BY country ORDER BY chart_entries DESC, country ASC NULLS FIRST LIMIT 10""",
    "chart_top_songs_by_country": f"""
        WITH {_EVENT_CHARTS}
        SELECT * FROM (
          SELECT country, track_name, artist_name, daily_rank,
                 CAST(dense_rank() OVER (PARTITION BY country ORDER BY daily_rank ASC NULLS FIRST)
                      AS INTEGER) AS rank_in_country
          FROM c) WHERE rank_in_country <= 5""",
    "chart_top_songs_per_day": f"""
        WITH {_EVENT_CHARTS}
        SELECT * FROM (
          SELECT country, track_name, artist_name, daily_rank,
                 CAST(dense_rank() OVER (PARTITION BY country, snapshot_date
                                         ORDER BY daily_rank ASC NULLS FIRST) AS INTEGER) AS rank_in_country
          FROM c) WHERE rank_in_country <= 5""",
    "formatted_then_trusted": f"""
        WITH {_FORMATTED_CHARTS_CTES},
        t0 AS (SELECT {', '.join(TRUSTED_ORDER_CHART_COLUMNS)} FROM f
               WHERE track_name IS NOT NULL AND artist_name IS NOT NULL),
        s1 AS (SELECT * FROM t0 QUALIFY row_number() OVER (
                 PARTITION BY snapshot_date, country, daily_rank
                 ORDER BY track_name ASC NULLS FIRST, spotify_id ASC NULLS FIRST, artist_name ASC NULLS FIRST,
                          popularity ASC NULLS FIRST, duration_ms ASC NULLS FIRST,
                          acousticness ASC NULLS FIRST) = 1)
        SELECT * FROM s1 QUALIFY row_number() OVER (
                 PARTITION BY artist_name, country, track_name, snapshot_date
                 ORDER BY track_name ASC NULLS FIRST, spotify_id ASC NULLS FIRST, daily_rank ASC NULLS FIRST,
                          popularity ASC NULLS FIRST, duration_ms ASC NULLS FIRST,
                          acousticness ASC NULLS FIRST) = 1""",
    "landing_tracks": f"""
        WITH raw AS ({R.LANDING_TRACKS_SQL})
        SELECT track_id, track_name, artists AS artist_name, album_name, {_typed(S.TRACKS_SPEC[4:])}
        FROM raw WHERE track_id IS NOT NULL AND track_name IS NOT NULL""",
    "landing_charts": _landing_charts_sql(R.LANDING_CHARTS_SQL),
    "classifier_scores": f"WITH {_SCORES_SQL} SELECT doc_id, label, score, prediction FROM p",
    "classifier_report": f"""
        WITH {_SCORES_SQL}, {_CONFUSION}
        SELECT 'class' AS section, CAST(label AS VARCHAR) AS item, CAST(count(*) AS DOUBLE) AS value FROM docs GROUP BY label
        UNION ALL SELECT 'confusion', '1 as 1', tp FROM cnt UNION ALL SELECT 'confusion', '0 as 1', fp FROM cnt
        UNION ALL SELECT 'confusion', '1 as 0', fn FROM cnt UNION ALL SELECT 'confusion', '0 as 0', tn FROM cnt
        UNION ALL SELECT 'metric', 'accuracy', {_rnd(_ratio('tp + tn', 'tp + tn + fp + fn'), 6)} FROM cnt
        UNION ALL SELECT 'metric', 'precision', {_rnd(_ratio('tp', 'tp + fp'), 6)} FROM cnt
        UNION ALL SELECT 'metric', 'recall', {_rnd(_ratio('tp', 'tp + fn'), 6)} FROM cnt
        UNION ALL SELECT 'metric', 'f1', {_rnd(_ratio('2 * tp', '2 * tp + fp + fn'), 6)} FROM cnt""",
    "landing_increment": _landing_charts_sql(_MONTHLY_CHARTS_SQL),
    "refresh_raw_charts": _landing_charts_sql(_MONTHLY_CHARTS_SQL),
    "bootstrap_charts": f"""
        WITH f AS ({_landing_charts_sql(_MONTHLY_CHARTS_SQL)}),
        t AS (SELECT {', '.join(S.TRUSTED_CHARTS_COLUMNS)} FROM f WHERE track_name IS NOT NULL AND artist_name IS NOT NULL),
        s1 AS (SELECT * FROM t {_first_sql(['snapshot_date', 'country', 'daily_rank'], ['track_name'])})
        SELECT *, 'formatted+trusted; trusted; ' AS first_runs
        FROM s1 {_first_sql(['artist_name', 'country', 'track_name', 'snapshot_date'], [])}""",
    "fallback_zone": f"""
        SELECT track_name, artist_name, daily_rank, snapshot_date, country, 'formatted' AS zone
        FROM ({_landing_charts_sql(_MONTHLY_CHARTS_SQL)})
        UNION ALL
        SELECT name, artists, {_lenient_int('daily_rank')}, CAST(try_strptime(snapshot_date, '%Y-%m-%d') AS DATE),
               upper(trim(regexp_replace(country, '\\s+', ' ', 'g'))), 'landing'
        FROM ({_MONTHLY_CHARTS_SQL})""",
    "landing_lyrics_text": f"""
        WITH raw AS ({R.RAW_LYRICS_FROM_DOCUMENTS_SQL}),
        p AS (SELECT {_lenient_int('"Unnamed: 0"')} AS song_id, trim(artist) AS artist_name,
                     trim(song_name) AS track_name, lyrics AS song_lyrics FROM raw)
        SELECT * FROM p WHERE song_id IS NOT NULL AND track_name IS NOT NULL""",
    "landing_lyrics_url": f"""
        WITH raw AS ({R.RAW_LYRICS_FROM_DOCUMENTS_SQL})
        SELECT {_lenient_int('"Unnamed: 0"')} AS song_id, trim(artist) AS artist_name, trim(song_name) AS song_name,
               'http://x/?q="' || artist || '",' AS song_url FROM raw""",
    "pipeline_trends": f"""
        WITH {_FORMATTED_CHARTS_CTES}
        SELECT snapshot_year, snapshot_month, count(*) AS chart_entries, count(DISTINCT track_name) AS unique_tracks
        FROM f GROUP BY 1, 2""",
    "pipeline_match_count": """
        WITH n AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
        SELECT CAST(sum(n * n) AS BIGINT) AS rows_written, CAST(sum(n * n) AS BIGINT) AS match_count FROM n""",
    "pipeline_top_artists_readback": f"""
        WITH raw AS ({R.RAW_TRACKS_FROM_PART_SQL}), t AS (SELECT artists AS artist_name, {_lenient_int('popularity')} AS popularity FROM raw)
        SELECT artist_name, {_rnd('avg(popularity)', 2)} AS avg_popularity, count(*) AS track_count
        FROM t GROUP BY 1 HAVING count(*) >= {S.MIN_TRACKS_PER_ARTIST} ORDER BY avg_popularity DESC NULLS LAST, artist_name LIMIT 20""",
    "join_string_keys": """
        SELECT CAST(a.p_partkey AS VARCHAR) AS song_lyrics, b.p_size > 25 AS explicit
        FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_name = b.p_name""",
    "argmax_labels": """
        SELECT doc_id, CASE WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 0 END AS label,
               CASE WHEN toxic > quality THEN 1 ELSE 0 END AS prediction FROM labels""",
    "trusted_lyrics": """
        SELECT CAST(n_chars % 1000 AS INTEGER) AS song_id, source AS artist_name, lang AS track_name, text AS song_lyrics
        FROM documents WHERE lang <> 'es' AND text IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY n_chars % 1000 ORDER BY source, lang, text) = 1""",
}
