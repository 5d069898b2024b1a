"""STR1: refresh of the daily chart, from formatted Parquet deliveries
(``refresh_charts``) or from raw files by way of the landing ledger
(``refresh_versions``).

The reference refreshes by re-downloading the chart and rebuilding it whole.
Here new landing files are picked up by a file-source stream run with
``trigger(availableNow=True)`` (a bounded, restartable batch), and each
micro-batch goes through ``foreachBatch``:

1. the rows are written to a bronze table partitioned by (``batch_id``,
   ``snapshot_date``) with dynamic partition overwrite, so a replayed batch
   replaces exactly its own partitions (idempotent);
2. when the run has taken in all files, the dates that its batches touched
   are rebuilt once: the bronze rows of those dates (found by partition
   pruning, NULL dates included) go through the trusted rebuild, because the
   uniqueness constraints need every row of a date;
3. those date partitions of the silver table are overwritten, and the last
   batch that silver includes is noted beside it. A run that was lost between
   two of these steps is made up for by the next one.

Before each partitioned write a ``rebalance`` hint lets AQE group rows by
date into few files per date while still splitting an oversized date.

Late rows for an old date just rebuild that date; no watermark or state
store is needed, and the result equals a batch run over all files. The
stream's checkpoint and the tables live under the cluster's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.operators import quality as Q
from tunelake.session import shared_dir
from tunelake.sources.ledger import ENTRY, FILE_COL, RUN_COL, entries, in_force
from tunelake.sources.readers import committed, path_exists
from tunelake.sources.sinks import publish, replace_folders

BATCH_COL = "batch_id"


def trusted_rebuild(df: DataFrame) -> DataFrame:
    """The chart constraints (WIN2 then WIN3) over whole dates."""
    return Q.unique_artist_title(Q.unique_chart_slot(df))


def refresh_charts(spark: SparkSession, landing: str, bronze: str, silver: str, checkpoint: str,
                   schema: T.StructType, rebuild: Callable[[DataFrame], DataFrame] = trusted_rebuild,
                   date_col: str = "snapshot_date", max_files_per_trigger: int | None = None) -> None:
    """Process every landing file not yet seen, then stop."""
    data_cols = [f.name for f in schema.fields]
    bronze_schema = T.StructType(schema.fields + [T.StructField(BATCH_COL, T.LongType(), True)])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing)

    def process(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
              .hint("rebalance", date_col)
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(BATCH_COL, date_col).parquet(bronze))

    query = (stream.writeStream.foreachBatch(process)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    if not path_exists(spark, bronze):
        return
    rows = spark.read.schema(bronze_schema).parquet(bronze)
    done = _included(spark, silver)
    new = rows.filter(F.col(BATCH_COL) > done)
    last = new.agg(F.max(BATCH_COL)).first()[0]
    if last is None:
        return
    # a row per date, however many rows the scan behind it has: without the hint
    # its estimated size decides, and the whole table is shuffled by date
    touched = F.broadcast(new.select(F.col(date_col).alias("__date")).distinct())
    affected = rows.join(touched, F.col(date_col).eqNullSafe(F.col("__date")), "left_semi").select(*data_cols)
    (rebuild(affected).hint("rebalance", date_col)
                      .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                      .partitionBy(date_col).parquet(silver))
    spark.range(1).select(F.lit(last).cast("bigint").alias(BATCH_COL)).write.mode("overwrite").json(_mark(silver))


def _mark(silver: str) -> str:
    return silver.rstrip("/") + "_included"


def _included(spark: SparkSession, silver: str) -> int:
    """The last batch that silver includes; -1 before the first."""
    if not path_exists(spark, _mark(silver)):
        return -1
    row = spark.read.schema(f"{BATCH_COL} bigint").json(_mark(silver)).first()
    return -1 if row is None else row[0]


def read_silver(spark: SparkSession, silver: str, schema: T.StructType) -> DataFrame:
    """The refreshed table (empty until a first batch has arrived)."""
    if not path_exists(spark, silver):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(silver).select(*[f.name for f in schema.fields])


def replay_refresh(spark: SparkSession, charts: DataFrame, deliveries: int = 4,
                   date_col: str = "snapshot_date", key_col: str = "spotify_id") -> DataFrame:
    """Land ``charts`` in ``deliveries``, each with rows of every date (late
    rows for all), as many files as the table has partitions, run the refresh
    after each delivery pair, and return the silver table."""
    root = shared_dir(spark, "refresh")
    landing, bronze, silver = f"{root}/landing", f"{root}/bronze", f"{root}/silver"
    part = F.pmod(F.xxhash64(key_col), F.lit(deliveries))
    # one write deals out all deliveries; their folders are the stream's files
    charts.withColumn("__part", part).write.mode("overwrite").partitionBy("__part").parquet(f"{root}/parts")
    for k in range(deliveries):
        here = f"{root}/parts/__part={k}"
        if path_exists(spark, here):
            spark.read.schema(charts.schema).parquet(here).write.mode("append").parquet(landing)
        if k % 2 or k == deliveries - 1:
            if path_exists(spark, landing):
                refresh_charts(spark, landing, bronze, silver, f"{root}/_checkpoint", charts.schema, date_col=date_col)
    return read_silver(spark, silver, charts.schema)


def refresh_versions(spark: SparkSession, book: str, read_rows: Callable[[DataFrame], DataFrame], state: str,
                     targets: dict[str, Callable[[DataFrame], DataFrame]], date_col: str = "snapshot_date") -> int:
    """Bring tables partitioned by date up to a ledger of files; returns the
    number of dates rebuilt.

    A stream reads the entries appended to the ledger ``book`` since the last
    run (``trigger(availableNow=True)``); ``read_rows`` gives the typed rows of
    a batch of entries, with their file and run, which go to a bronze table
    under ``state`` by (run, date), so that a replayed batch replaces itself.
    Then the dates of the new rows, and those of the rows that they replace,
    are rebuilt in every target from the bronze rows whose entry is in force; a
    date left without rows goes. The last run included is noted at the end: a
    refresh that was lost before is made up for by the next one.
    """
    bronze, note = f"{state}/bronze", f"{state}/included"

    def process(batch: DataFrame, batch_id: int) -> None:
        (read_rows(batch.select("file", "run")).hint("rebalance", RUN_COL, date_col)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COL, date_col).parquet(bronze))

    query = (spark.readStream.schema(ENTRY).json(book).writeStream.foreachBatch(process)
             .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    done = ""
    if path_exists(spark, note):
        done = spark.read.schema("run string").json(note).agg(F.max("run")).first()[0] or ""
    taken = entries(spark, book)
    new = taken.filter(F.col("run") > done)
    last = new.agg(F.max("run")).first()[0]
    if last is None or not path_exists(spark, bronze):
        return 0
    rows = spark.read.parquet(bronze)
    dates = rows.filter(F.col(RUN_COL) > done).select(date_col)
    again = taken.filter(F.col("run") <= done).join(new.select("file").distinct(), "file", "left_semi")
    if not again.isEmpty():
        keys = F.broadcast(again.select(F.col("file").alias(FILE_COL), F.col("run").alias(RUN_COL)))  # a row per new file
        dates = dates.unionByName(rows.join(keys, [FILE_COL, RUN_COL], "left_semi").select(date_col))
    # The dates to rebuild, a row each, are found once. As a table they are sent
    # to the rows; a plan over the scan would be sized by the scan, and every
    # target would shuffle the whole bronze table by date.
    found = dates.distinct().select(date_col, F.coalesce(F.col(date_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))).collect()
    touched = F.broadcast(spark.createDataFrame([(r[0],) for r in found], T.StructType([T.StructField("__date", rows.schema[date_col].dataType)])))
    affected = in_force(rows.join(touched, F.col(date_col).eqNullSafe(F.col("__date")), "left_semi"), book).drop(FILE_COL, RUN_COL)
    names = [f"{date_col}={r[1]}" for r in found]
    for path, rebuild in targets.items():
        staged = f"{state}/staged/{last}"
        (rebuild(affected).hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col)
         .option("partitionOverwriteMode", "static").parquet(staged))
        replace_folders(spark, staged, path, names)
    publish(spark, note, lambda to: spark.range(1).select(F.lit(last).alias("run")).coalesce(1).write.json(to))
    return len(names)


def bootstrap_if_missing(spark: SparkSession, path: str, load: Callable[[], object]) -> bool:
    """STR2: run ``load`` only when there is no whole table at ``path``; what a
    lost run has left is none."""
    if committed(spark, path):
        return False
    load()
    return True
