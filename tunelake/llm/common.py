"""Helpers shared by the operators: stored intermediates, code shipping,
and joins on an id that may be null."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The top-level column of that exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column of the table has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; it is removed when the
    session ends."""
    path = shared_dir(spark, "llm", label)
    p, fs = hadoop_path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing will read again."""
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def store_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = new_folder(spark, label) + "/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back:
    it is computed once, its lineage ends there, and a lost executor costs
    only a re-read."""
    return store_at(df, label)[0]


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per context and by way
    of the shared folder, so that Python workers can import it wherever the
    driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_tunelake_shipped", False):
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = new_folder(spark, "code") + "/tunelake.zip"
    p, fs = hadoop_path(spark, path)
    out = fs.create(p)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._tunelake_shipped = True


def join_by_id(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` joined to ``right`` on ``key``. Rows of ``left`` whose key is
    null match nothing and take no part in the shuffle, so that many of them
    do not meet in one task."""
    named = left.filter(quoted(key).isNotNull()).join(right.filter(quoted(key).isNotNull()), key, how)
    unnamed = left.filter(quoted(key).isNull())
    if how == "left_semi":
        return named
    if how == "left_anti":
        return named.unionByName(unnamed)
    return named.unionByName(unnamed, allowMissingColumns=True)


def smallest_by_hash(rows: DataFrame, seed: int, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``key`` (all, if there are fewer).

    Rows are counted per bit length of the hash first; only those up to the
    length at which ``n`` are reached are sorted (about twice as many, more
    where keys repeat), so that what reaches the driver does not grow with the
    number of partitions.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40))
    sizes = dict(rows.groupBy(F.length(F.bin(place))).count().collect())  # at most 40 rows
    held = 0
    for bits in sorted(sizes):
        held += sizes[bits]
        if held >= n:
            rows = rows.filter(place < F.lit(1 << bits))
            break
    return rows.orderBy(place, key).limit(n)


def most_frequent(counts: DataFrame, n_col: str, most: int) -> DataFrame:
    """The rows whose count ``n_col`` has more bits than that of any row left
    out, as many as fit ``most``. The driver sees the sizes per bit length only."""
    bits = F.length(F.bin(F.col(n_col)))
    sizes = dict(counts.groupBy(bits.alias("bits")).count().collect())  # at most 63 rows
    held, least = 0, 64
    for k in sorted(sizes, reverse=True):
        held += sizes[k]
        if held > most:
            break
        least = k
    return counts.filter(bits >= least)
