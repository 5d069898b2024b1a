"""The landing ledger (SNK4, SRC8): which files were taken in, and as what.

Every converted landing file leaves an entry: file, length, time, digest of its
lines, and the run that converted it. Entries are only ever appended; the last
one of a file is in force. A run writes its rows first, under its own run id,
and its entries last, so rows of a run that was lost on the way are in no
entry and are never read. A file that comes again with other contents gets a
new entry, which takes the place of its earlier rows; one that comes again
unchanged gets none. A folder is one delivery: files that it no longer holds
get an empty entry, and their rows go. A single file that has gone keeps its
rows.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.sources.readers import hadoop, path_exists

ENTRY = "file string, length long, modified long, digest string, run string"

# Columns of a landing copy that say where a row is from.
FILE_COL, RUN_COL = "__file", "__run"


@dataclass(frozen=True)
class LandingFile:
    path: str
    length: int
    modified: int  # ms


def new_run() -> str:
    """An id that sorts after those of earlier runs."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?=/)"


def plain_path(path: str) -> str:
    """A path without its scheme, the same for every way of writing it."""
    return re.sub(r"^//(?=/)", "", re.sub(SCHEME, "", path))


def file_name() -> Column:
    """``plain_path`` of the file that a row is read from."""
    path = F.regexp_replace(F.col("_metadata.file_path"), SCHEME, "")
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^//(?=/)", "")


def data_files(spark: SparkSession, path: str) -> list[LandingFile]:
    """The file itself, or the data files inside a folder; empty ones hold nothing."""
    p, fs = hadoop(spark, path)
    status = fs.getFileStatus(p)
    found = fs.listStatus(p) if status.isDirectory() else [status]
    files = [LandingFile(st.getPath().toString(), st.getLen(), st.getModificationTime())
             for st in found if not st.getPath().getName().startswith(("_", "."))]
    return sorted((f for f in files if f.length), key=lambda f: f.path)


def survey(spark: SparkSession, files: Sequence[LandingFile]) -> DataFrame:
    """file (its plain path), header (its first line), lines and digest (of
    its lines, whatever their order) of every file, from one pass over them."""
    at = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text([f.path for f in files], lineSep="\n").select(
        file_name().alias("file"), "value",
        # rows of a task come in order, and a file's first block is one task's
        F.when(at, F.monotonically_increasing_id()).alias("place"))
    return lines.groupBy("file").agg(
        F.min_by("value", "place").alias("header"), F.count(F.lit(1)).alias("lines"),
        F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("string").alias("digest"))


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries; none where there is no ledger yet."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(ledger)


def current(spark: SparkSession, ledger: str) -> DataFrame:
    """The entry in force of every file: that of its last run."""
    last = F.max(F.struct("run", "length", "modified", "digest")).alias("e")
    return entries(spark, ledger).groupBy("file").agg(last).select("file", "e.length", "e.modified", "e.digest", "e.run")


def _listing(spark: SparkSession, files: Sequence[LandingFile]) -> DataFrame:
    """What the driver has listed, as a table."""
    return spark.createDataFrame([(plain_path(f.path), f.path, f.length, f.modified) for f in files],
                                 "file string, path string, length long, modified long")


def pending(spark: SparkSession, ledger: str, files: Sequence[LandingFile]) -> list[LandingFile]:
    """The files without an entry of the same length and time: those that are
    new or may have changed."""
    if not files or not path_exists(spark, ledger):
        return list(files)
    rows = _listing(spark, files).join(current(spark, ledger), ["file", "length", "modified"], "left_anti")
    return [LandingFile(*r) for r in rows.select("path", "length", "modified").collect()]


def record(rows: DataFrame, ledger: str) -> None:
    """Append entries, all or none: one file, renamed into place by Spark's committer."""
    rows.selectExpr("file", "length", "modified", "digest", "run").coalesce(1).write.mode("append").json(ledger)


def _gone(spark: SparkSession, ledger: str, paths: Sequence[str], files: Sequence[LandingFile]) -> DataFrame | None:
    """Files in force that lie in one of the folders among ``paths`` and are
    not among ``files`` any more."""
    folders = [plain_path(p).rstrip("/") + "/" for p in paths if plain_path(p) not in {plain_path(f.path) for f in files}]
    if not folders or not path_exists(spark, ledger):
        return None
    inside = [F.col("file").startswith(f) for f in folders]
    known = current(spark, ledger).filter(F.col("length") > 0).filter(reduce(Column.__or__, inside)).select("file")
    return known.join(_listing(spark, files), "file", "left_anti")


def changed(spark: SparkSession, ledger: str, paths: Sequence[str]) -> tuple[list[LandingFile], DataFrame | None]:
    """The files at ``paths`` (files or folders) whose lines are not those of
    their entry in force, and the entries (without a run) that taking them in
    needs: theirs, and empty ones for files that a folder no longer holds. No
    entries: nothing has changed. A file that was only touched has not."""
    files = [f for p in paths for f in data_files(spark, p)]
    kind, rows = "file string, length long, modified long, digest string", []
    gone = _gone(spark, ledger, paths, files)
    if gone is not None:
        rows = [(r["file"], 0, 0, "") for r in gone.collect()]  # file names, as many as were listed before
    new = []
    if files := pending(spark, ledger, files):
        found = survey(spark, files).join(_listing(spark, files), "file")
        for r in found.join(current(spark, ledger), ["file", "length", "digest"], "left_anti").collect():  # a row per new file
            new.append(LandingFile(r["path"], r["length"], r["modified"]))
            rows.append((r["file"], r["length"], r["modified"], r["digest"]))
    return new, spark.createDataFrame(rows, kind) if rows else None


def in_force(copy: DataFrame, ledger: str) -> DataFrame:
    """The rows of a landing copy whose file's entry in force is of their run."""
    valid = current(copy.sparkSession, ledger).select(F.col("file").alias(FILE_COL), F.col("run").alias(RUN_COL))
    return copy.join(F.broadcast(valid), [FILE_COL, RUN_COL], "left_semi")  # a row per file: the copy stays where it is
