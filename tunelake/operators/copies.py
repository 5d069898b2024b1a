"""Rows that stand for several equal ones (m:n joins of which one side gives
the output nothing but equal values)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies that a row is dealt out with at a time.
RUN = 1 << 12


def fold(df: DataFrame, copies: str = "__copies") -> DataFrame:
    """One row per distinct row, with the number of its copies; NULLs are equal."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))


def cut(df: DataFrame, run: Column, copies: str = "__copies") -> DataFrame:
    """Every row as several of at most ``run`` copies each (an integer of 1 or
    more, which may depend on the row)."""
    columns = [F.col(f"`{c}`") for c in df.columns if c != copies]
    run = run.cast("bigint")
    return (df.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, run)))
              .select(*columns, F.least(F.col(copies) - F.col("__from"), run).alias(copies)))


def deal(df: DataFrame, copies: str = "__copies") -> DataFrame:
    """The rows cut to runs of at most ``RUN`` copies, which are dealt evenly
    to all tasks, so neither a hot key nor a small input leaves the expansion
    to a few of them. The number of tasks is given, as the size of the runs
    says little about the rows they end up as.
    """
    return cut(df, F.lit(RUN), copies).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def unfold(df: DataFrame, copies: str = "__copies") -> DataFrame:
    """Every row as often as its ``copies`` column says, without that column;
    a task holds one run of them at a time."""
    columns = [F.col(f"`{c}`") for c in df.columns if c != copies]
    return (deal(df, copies)
            .select(*columns, F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int"))).alias("__copy"))
            .select(*columns))
