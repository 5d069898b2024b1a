"""Role adapters: the music tables are not in the shared test data, so the
catalogue lets test tables play their roles (lineitem/part as tracks,
orders/events as charts, documents as lyrics, labels.toxic as explicit).

Each adapter is a projection (no rows are dropped) and has a SQL twin used
by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.schemas import LYRICS_ARTIST_SUFFIX, TRACKS_SPEC, ColumnSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# events as a daily chart: a (date, event type) pair is a (date, country)
# chart, user_id is the chart position, props the title.
def charts_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("spotify_id"),
        F.col("props").alias("track_name"),
        F.col("event_type").alias("artist_name"),
        F.col("user_id").cast("int").alias("daily_rank"),
        F.col("event_type").alias("country"),
        F.to_date("ts").alias("snapshot_date"),
        F.col("value").alias("popularity"),
    )


CHARTS_FROM_EVENTS_SQL = """
SELECT event_id AS spotify_id, props AS track_name, event_type AS artist_name,
       CAST(user_id AS INTEGER) AS daily_rank, event_type AS country,
       CAST(ts AS DATE) AS snapshot_date, value AS popularity
FROM events"""


# part as a raw (all-text) track file, with damaged values: decimal text,
# junk and missing titles.
def raw_tracks_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.when(F.col("p_size") == 50, F.lit(None)).otherwise(F.col("p_name")).alias("track_name"),
        F.col("p_brand").alias("artists"),
        F.col("p_type").alias("album_name"),
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.col("p_size").cast("string"), F.lit(".7")))
         .when(F.col("p_type") == "LARGE", F.lit("x"))
         .otherwise(F.col("p_size").cast("string")).alias("popularity"),
        F.when(F.col("p_type") == "SMALL", F.lit(""))
         .otherwise(F.col("p_partkey").cast("string")).alias("duration_ms"),
        F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("false")).alias("explicit"),
        F.col("p_retailprice").cast("string").alias("danceability"),
        F.when(F.col("p_type") == "MEDIUM", F.lit("n/a"))
         .otherwise(F.col("p_size").cast("string")).alias("key"),
    )


RAW_TRACKS_FROM_PART_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS track_id,
       CASE WHEN p_size = 50 THEN NULL ELSE p_name END AS track_name,
       p_brand AS artists, p_type AS album_name,
       CASE WHEN p_type = 'ECONOMY' THEN CAST(p_size AS VARCHAR) || '.7'
            WHEN p_type = 'LARGE' THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS popularity,
       CASE WHEN p_type = 'SMALL' THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS duration_ms,
       CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS explicit,
       CAST(p_retailprice AS VARCHAR) AS danceability,
       CASE WHEN p_type = 'MEDIUM' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS key
FROM part"""

TRACKS_FROM_PART_SPEC = [
    ColumnSpec("track_id", "track_id"),
    ColumnSpec("track_name", "track_name"),
    ColumnSpec("artists", "artist_name"),
    ColumnSpec("album_name", "album_name"),
    ColumnSpec("popularity", "popularity", "int"),
    ColumnSpec("duration_ms", "duration_ms", "bigint"),
    ColumnSpec("explicit", "explicit", "boolean"),
    ColumnSpec("danceability", "danceability", "double"),
    ColumnSpec("key", "key", "int"),
]


# orders as a raw chart file: padded, mixed-case country text, partial
# dates and missing ranks/popularity.
def raw_charts_from_orders(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("spotify_id"),
        F.when((status == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit(None))
         .otherwise(F.col("o_custkey").cast("string")).alias("name"),
        status.alias("artists"),
        F.when(status == "P", F.lit(None))
         .otherwise(F.substring("o_orderpriority", 1, 1)).alias("daily_rank"),
        F.concat(F.lit(" "), F.replace(F.lower("o_orderpriority"), F.lit("-"), F.lit(" \t ")),
                 F.lit("  ")).alias("country"),
        F.when(status == "F", F.year("o_orderdate").cast("string")).otherwise(iso).alias("snapshot_date"),
        F.when(status == "O", F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("popularity"),
        F.col("o_orderkey").cast("string").alias("duration_ms"),
        iso.alias("album_release_date"),
        F.when(status == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("acousticness"),
    )


RAW_CHARTS_FROM_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS spotify_id,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
            ELSE CAST(o_custkey AS VARCHAR) END AS name,
       o_orderstatus AS artists,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS daily_rank,
       ' ' || replace(lower(o_orderpriority), '-', ' ' || chr(9) || ' ') || '  ' AS country,
       CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS VARCHAR)
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS snapshot_date,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS popularity,
       CAST(o_orderkey AS VARCHAR) AS duration_ms,
       strftime(o_orderdate, '%Y-%m-%d') AS album_release_date,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS acousticness
FROM orders"""

CHARTS_FROM_ORDERS_SPEC = [
    ColumnSpec("spotify_id", "spotify_id"),
    ColumnSpec("name", "track_name"),
    ColumnSpec("artists", "artist_name"),
    ColumnSpec("daily_rank", "daily_rank", "int"),
    ColumnSpec("country", "country"),
    ColumnSpec("snapshot_date", "snapshot_date"),
    ColumnSpec("popularity", "popularity", "int"),
    ColumnSpec("duration_ms", "duration_ms", "bigint"),
    ColumnSpec("album_release_date", "album_release_date"),
    ColumnSpec("acousticness", "acousticness", "double"),
]


# documents as a raw lyrics file (text form); "Unnamed: 0" is the index.
def raw_lyrics_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.when(F.col("lang") == "de", F.lit("n/a"))
         .otherwise(F.col("doc_id").cast("string")).alias("Unnamed: 0"),
        F.concat(F.lit(" "), F.col("source"), F.lit("  ")).alias("artist"),
        F.concat(F.col("lang"), F.lit(" ")).alias("song_name"),
        F.col("text").alias("lyrics"),
    )


RAW_LYRICS_FROM_DOCUMENTS_SQL = """
SELECT CASE WHEN lang = 'de' THEN 'n/a' ELSE CAST(doc_id AS VARCHAR) END AS "Unnamed: 0",
       ' ' || source || '  ' AS artist, lang || ' ' AS song_name, text AS lyrics
FROM documents"""


# part and orders as landing files with all columns of the dataset specs.
def landing_tracks_from_part(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("string")
    base = raw_tracks_from_part(part).withColumn(
        "track_name", F.concat(F.lit('"'), F.col("track_name"), F.lit('", live')))
    names = ["track_id", "track_name", "artists", "album_name", "popularity", "duration_ms", "explicit", "danceability", "key"]
    rest = ["energy", "loudness", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo"]
    raw = part.select(F.col("p_partkey").cast("string").alias("__id"), size.alias("__size"), F.col("p_type").alias("__type"))
    raw = base.join(raw, base["track_id"] == raw["__id"])
    return raw.select(*names, *[F.when(F.col("__type") == "PROMO", F.lit(None)).otherwise(F.col("__size")).alias(c) for c in rest])


LANDING_TRACKS_SQL = f"""
SELECT r.* REPLACE ('"' || track_name || '", live' AS track_name),
       {", ".join(f"CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(p_size AS VARCHAR) END AS {c}" for c in
                  ["energy", "loudness", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo"])}
FROM ({RAW_TRACKS_FROM_PART_SQL}) r JOIN part ON track_id = CAST(p_partkey AS VARCHAR)"""


def landing_charts_from_orders(orders: DataFrame) -> DataFrame:
    raw = raw_charts_from_orders(orders)
    text = {c: F.col("spotify_id") for c in ("daily_movement", "weekly_movement", "is_explicit", "danceability",
                                             "energy", "key", "loudness", "mode", "speechiness")}
    number = {c: F.when(F.col("artists") == "O", F.lit(None)).otherwise(F.col("spotify_id"))
              for c in ("instrumentalness", "liveness", "valence", "tempo", "time_signature")}
    return (raw.withColumn("acousticness", F.col("duration_ms"))
               .withColumn("album_name", F.concat(F.lit('a "b", '), F.col("artists")))
               .withColumns({**text, **number}))


LANDING_CHARTS_SQL = f"""
SELECT * REPLACE (duration_ms AS acousticness), 'a "b", ' || artists AS album_name,
       {", ".join(f"spotify_id AS {c}" for c in ("daily_movement", "weekly_movement", "is_explicit", "danceability",
                                                  "energy", "key", "loudness", "mode", "speechiness"))},
       {", ".join(f"CASE WHEN artists = 'O' THEN NULL ELSE spotify_id END AS {c}" for c in
                  ("instrumentalness", "liveness", "valence", "tempo", "time_signature"))}
FROM ({RAW_CHARTS_FROM_ORDERS_SQL})"""


def landing_lyric_links_from_documents(documents: DataFrame) -> DataFrame:
    return raw_lyrics_from_documents(documents).select(
        F.col("`Unnamed: 0`").alias("song_id"), F.col("artist").alias("singer_name"), "song_name",
        F.concat(F.lit('http://x/?q="'), F.col("artist"), F.lit('",')).alias("song_href"))


# labels and documents as songs and their lyrics: a song per labelled document
# (bad ones are too short to be trusted), under names that only meet once
# suffix, case and spaces are taken care of.
def landing_tracks_from_labels(labels: DataFrame, documents: DataFrame) -> DataFrame:
    names = {c.source for c in TRACKS_SPEC}
    song = labels.join(documents.select("doc_id", "source"), "doc_id").select(
        F.col("doc_id").cast("string").alias("track_id"), F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("track_name"),
        F.upper("source").alias("artists"), F.when(F.col("toxic") == 1, "True").otherwise("False").alias("explicit"),
        F.when(F.col("quality") == 1, "200000").otherwise("20000").alias("duration_ms"))
    return song.select(*song.columns, *[F.lit(None).cast("string").alias(c) for c in sorted(names - set(song.columns))])


def landing_lyrics_from_documents(documents: DataFrame) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    return documents.select(doc.alias("Unnamed: 0"), F.concat(F.col("source"), F.lit(LYRICS_ARTIST_SUFFIX)).alias("artist"),
                            F.concat(F.lit(" DOC "), doc, F.lit(" ")).alias("song_name"), F.col("text").alias("lyrics"))
