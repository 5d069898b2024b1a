"""Scans (SRC1-SRC6, SRC9).

Landing CSVs are read by header name, as text: a declared schema would bind
columns by position, and inference costs an extra pass over the input. Own
results are read with a declared schema. Inference stays available for
profiling.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

log = logging.getLogger(__name__)

# How CSV text is written and read back unchanged; both directions use it.
CSV_OPTIONS = {"encoding": "utf-8", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}

# In the name of a CSV file: no row goes over several lines.
LINES = ".lines"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             infer: bool = False, **options) -> DataFrame:
    """SRC1/SRC3/SRC4: headed CSV, declared schema unless ``infer``."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_text_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
                  infer: bool = False) -> DataFrame:
    """SRC2: quoted multi-line text, UTF-8, ``"`` escaping ``"``. Files that
    say they have one line per row are read by lines, for the same rows."""
    paths = [path] if isinstance(path, str) else list(path)
    return read_csv(spark, path, schema, infer, multiLine=str(not all(by_lines(spark, p) for p in paths)).lower())


def by_lines(spark: SparkSession, path: str) -> bool:
    """Do all CSV files of a folder have ``LINES`` in their name?"""
    folder, fs = hadoop(spark, path)
    if not fs.exists(folder):
        return False
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    names = [name for name in names if not name.startswith(("_", "."))]
    return bool(names) and all(LINES + ".csv" in name for name in names)


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], forms: Sequence[Sequence[str]],
                     multi_line: bool = False, source_col: str | None = None) -> DataFrame:
    """SRC1/SRC2 of landing files: the columns of one of ``forms`` by header
    name, as text. Further columns and any order are fine, also from file to
    file: files of equal header are read together and the groups are united.

    ``forms`` lists the sets of names the dataset may have; all files must
    have the same one. A file with none of them raises. One job finds the
    first lines of all files, and one more per different header its columns.
    ``source_col`` adds the file's name. Multi-line files are one task each:
    only their parser knows where a row begins.
    """
    from tunelake.sources import ledger
    files = [f for path in paths for f in ledger.data_files(spark, path)]
    if not files:
        raise FileNotFoundError(f"no CSV file in {list(paths)}")
    by_name = {ledger.plain_path(f.path): f.path for f in files}
    groups: dict[str, list[str]] = {}
    for row in ledger.survey(spark, files).select("file", "header").collect():  # one row per file listed above
        groups.setdefault(row["header"].rstrip("\r"), []).append(by_name[row["file"]])
    parts, used = [], set()
    for line in sorted(groups):
        df = read_csv(spark, sorted(groups[line]), multiLine=str(multi_line).lower())
        header = df.columns
        form = next((tuple(f) for f in forms if set(f) <= set(header)), None)
        if form is None:
            missing = min((sorted(set(f) - set(header)) for f in forms), key=len)
            raise ValueError(f"{min(groups[line])}: no column {', '.join(missing)} in the header")
        used.add(form)
        source = [ledger.file_name().alias(source_col)] if source_col else []
        parts.append(df.select(*[df["`" + c + "`"] for c in form], *source))
    if len(used) > 1:
        raise ValueError(f"files of different forms: {sorted(used)}")
    return reduce(DataFrame.unionByName, parts)


def hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = hadoop(spark, path)
    fs.delete(p, True)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC5/SRC9."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for
    local, HDFS and object stores alike)."""
    hadoop_path, fs = hadoop(spark, path)
    return bool(fs.exists(hadoop_path))


def list_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = (".csv", ".parquet")) -> list[str]:
    """Files (or Parquet folders) directly inside ``folder`` whose name ends
    with one of ``suffixes``; empty when the folder does not exist."""
    hadoop_path, fs = hadoop(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    out = []
    for status in fs.listStatus(hadoop_path):
        name = status.getPath().getName()
        if name.endswith(tuple(suffixes)):
            out.append(status.getPath().toString())
    return sorted(out)


def rename_if_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """PRJ7: rename only the columns that exist."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def committed(spark: SparkSession, path: str) -> bool:
    """Is there a whole table? A file is; a folder is when the job that wrote
    it has left its mark, or, for copies made elsewhere, when nothing says
    that a job is still at it or was lost."""
    p, fs = hadoop(spark, path)
    if not fs.exists(p):
        return False
    if not fs.getFileStatus(p).isDirectory():
        return True
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    if "_SUCCESS" in names:
        return True
    return bool(names) and not any(n == "_temporary" or n.startswith(".spark-staging") for n in names)


def read_with_fallback(spark: SparkSession, paths: Sequence[str],
                       renames: Sequence[Mapping[str, str] | None] | None = None,
                       own: Sequence[bool] | None = None) -> tuple[DataFrame, str]:
    """SRC6: read the first zone that is committed and can be read; apply that
    zone's column renames. Returns the frame and the path used, and logs the
    zones passed over. ``own`` says which paths the zone jobs write: those
    count only with the mark of a finished write."""
    renames, own = list(renames or [None] * len(paths)), list(own or [False] * len(paths))
    errors = []
    for path, rename, ours in zip(paths, renames, own):
        if not path_exists(spark, path):
            errors.append(f"{path}: missing")
            continue
        if not (path_exists(spark, path.rstrip("/") + "/_SUCCESS") if ours else committed(spark, path)):
            errors.append(f"{path}: not committed")
            continue
        try:
            df = read_parquet(spark, path)
        except AnalysisException as exc:  # e.g. an empty folder
            errors.append(f"{path}: {exc}")
            continue
        if errors:
            log.warning("reading %s; passed over: %s", path, "; ".join(errors))
        return (rename_if_present(df, rename) if rename else df), path
    raise FileNotFoundError("no readable zone: " + "; ".join(errors))
