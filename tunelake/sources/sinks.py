"""Writers (SNK1-SNK6).

A table that is replaced as a whole is written beside the old one and takes
its name when the write is done (``publish``); until then readers see the old
one, and a write that is lost leaves it as it was. Dynamic partition overwrite
replaces only the partitions a run produced. Either way a retried run is
idempotent.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tunelake.operators.copies import cut, deal
from tunelake.sources.readers import CSV_OPTIONS, LINES, delete_path, hadoop, path_exists

# Bytes of equal CSV lines that are written at a time.
BLOCK = 1 << 17


def _beside(path: str, kind: str) -> str:
    parent, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(parent, f".{name}.{kind}-{uuid.uuid4().hex}")


def _left_over(spark: SparkSession, path: str, kind: str) -> list[str]:
    parent, name = posixpath.split(path.rstrip("/"))
    p, fs = hadoop(spark, parent)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith(f".{name}.{kind}-"))


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was lost half-way: a table whose old form was
    moved aside, with nothing in its place, gets it back."""
    for old in _left_over(spark, path, "old"):
        p, fs = hadoop(spark, old)
        if path_exists(spark, path):
            fs.delete(p, True)
        else:
            fs.rename(p, hadoop(spark, path)[0])


def publish(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """``write`` a table to a folder beside ``path`` and put it there when done.

    One writer per table at a time. On file systems whose rename is atomic
    readers see the old table or the new one, but for the moment between two
    renames; where a run is lost in that moment, the next ``settle`` (every
    ``publish`` begins with one) brings the old table back.
    """
    settle(spark, path)
    for lost in _left_over(spark, path, "next"):
        delete_path(spark, lost)
    new, old = _beside(path, "next"), _beside(path, "old")
    write(new)
    target, fs = hadoop(spark, path)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.rename(target, hadoop(spark, old)[0])
    if not fs.rename(hadoop(spark, new)[0], target):
        settle(spark, path)
        raise OSError(f"{new} could not be renamed to {path}")
    delete_path(spark, old)
    return path


def mark_committed(spark: SparkSession, folder: str) -> None:
    """Leave the mark of a finished job in the folder."""
    p, fs = hadoop(spark, posixpath.join(folder, "_SUCCESS"))
    fs.create(p, True).close()


def is_committed(spark: SparkSession, folder: str) -> bool:
    return path_exists(spark, posixpath.join(folder, "_SUCCESS"))


def replace_folders(spark: SparkSession, staged: str, path: str, names: Sequence[str]) -> None:
    """Put the named partition folders of ``staged`` in the place of those of
    ``path``; a name that ``staged`` lacks goes. Each is whole at any time but
    for the moment between two renames; done again, it ends the same."""
    for name in names:
        new, fs = hadoop(spark, posixpath.join(staged, name))
        target = hadoop(spark, posixpath.join(path, name))[0]
        if fs.exists(new):
            fs.mkdirs(target.getParent())
            fs.delete(target, True)
            fs.rename(new, target)
        else:
            fs.delete(target, True)
    delete_path(spark, staged)
    mark_committed(spark, path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None,
                  replace_partitions: str = "static") -> str:
    """SNK1 (optionally partitioned, e.g. charts by ``snapshot_date``).

    A partitioned write first gets a ``rebalance`` hint on the partition
    columns: AQE then writes few files per partition value (not one per task
    and value) and still splits a partition value that is too large for one
    task. ``replace_partitions="static"`` makes an overwrite replace the whole
    table (a full rebuild); ``"dynamic"`` replaces only the partitions this
    write produces (an incremental update).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)

    def write(to: str) -> None:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", replace_partitions)
        writer.parquet(to)

    if mode == "overwrite" and not (partition_by and replace_partitions == "dynamic"):
        return publish(df.sparkSession, path, write)
    write(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    """SNK2: headed CSV; text is quoted and kept byte for byte (no space
    trimming), so it reads back with ``read_text_csv``, compressed or not."""
    def write(to: str) -> None:
        df.write.mode(mode).options(**CSV_OPTIONS).option("header", "true").option("compression", compression).csv(to)

    if mode == "overwrite":
        return publish(df.sparkSession, path, write)
    write(path)
    return path


def write_folded_csv(df: DataFrame, path: str, copies: str = "__copies", compression: str = "none") -> int:
    """``write_csv`` of folded rows (``operators.copies``), every one as often
    as its ``copies`` column says. Returns the number of rows written.

    The line of a row is formatted once and repeated as text. The first row of
    a task, and so of its file, takes the header along. Files in which no row
    goes over several lines carry ``LINES`` in their name. The table has two
    columns or more (CSV has no row for a lone NULL).
    """
    names = [c for c in df.columns if c != copies]
    if len(names) < 2:
        raise ValueError("a folded CSV needs two columns or more")
    line, n = F.col("__line"), F.col(copies)

    def csv_line(row: Column) -> Column:
        return F.to_csv(row, CSV_OPTIONS)

    text = deal(df.select(csv_line(F.struct(*[F.col(f"`{c}`") for c in names])).alias("__line"), copies), copies)
    blocks = cut(text, F.greatest(F.lit(1), F.floor(F.lit(BLOCK) / (F.octet_length(line) + 1))), copies)
    seen = Observation()
    # NUL may begin a comment to the parser, which then skips the row in files and blanks it in lines
    blocks = blocks.observe(seen, F.sum(n).alias("rows"), F.bool_or(line.rlike(r"[\r\n\x00]")).alias("breaks"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.concat(csv_line(F.struct(*[F.lit(c) for c in names])), F.lit("\n"))
    lines = blocks.select(F.concat(F.when(first, header).otherwise(""), line,
                                   F.repeat(F.concat(F.lit("\n"), line), (n - 1).cast("int"))).alias("value"))

    def write(to: str) -> None:
        lines.write.option("compression", compression).option("lineSep", "\n").option("maxRecordsPerFile", 0).text(to)
        suffix = ".csv" if seen.get["breaks"] or any(b in c for c in names for b in "\r\n\0") else LINES + ".csv"
        folder, fs = hadoop(df.sparkSession, to)
        for status in fs.listStatus(folder):
            part = status.getPath()
            stem, text, codec = part.getName().rpartition(".txt")
            if text and not fs.rename(part, hadoop(df.sparkSession, posixpath.join(to, stem + suffix + codec))[0]):
                raise OSError(f"{part} could not be renamed")

    publish(df.sparkSession, path, write)
    return int(seen.get["rows"] or 0)


def write_if_rows(df: DataFrame, path: str | None, fmt: str = "csv", copies: str | None = None, **options) -> int:
    """SNK3/JN4: write when a path is given and count the rows in the same
    pass; an output without rows is removed again. Returns the row count.
    Rows folded under ``copies`` are written (to CSV) as often as that says;
    ``options`` go to the writer."""
    if not path:
        return 0
    if copies:
        n = write_folded_csv(df, path, copies, **options)
    else:
        rows = Observation()
        counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
        (write_csv if fmt == "csv" else write_parquet)(counted, path, **options)
        n = int(rows.get["rows"])
    if not n:
        delete_path(df.sparkSession, path)
    return n


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """SNK5/SNK6: a bounded head of a result, still a DataFrame; callers
    decide whether to show or collect it."""
    return df.limit(n)


def preview_text(df: DataFrame, n: int = 20, truncate: int = 20) -> DataFrame:
    """SNK5: the preview as the console prints it, still a DataFrame: every
    column as text, NULL spelled out, long values cut to ``truncate``
    characters that end in dots. Give an ordered table for a defined head."""
    keep = truncate - 3 if truncate > 3 else truncate

    def cell(name: str) -> Column:
        text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("NULL"))
        cut = F.concat(F.substring(text, 1, keep), F.lit("..." if truncate > 3 else ""))
        return F.when(F.length(text) > truncate, cut).otherwise(text).alias(name)

    return preview(df, n).select(*[cell(c) for c in df.columns])


def schema_table(df: DataFrame) -> DataFrame:
    """SNK5: the schema print as a table: place, name and type of every column
    (a row per column of the table, known without reading it)."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(fields, "place int, column_name string, type string")
