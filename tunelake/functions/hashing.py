"""Stable, engine-independent hashing.

``md5`` of ``"<seed>:<id>"`` is the same in every engine and does not depend
on partitioning, so splits and samples are reproducible across runs and
cluster sizes (unlike ``rand``/``randomSplit``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _seeded_md5(id_col: Column | str, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def null_safe_id(df: DataFrame, id_col: str) -> Column:
    """The id as text; where it is NULL, the row's other columns as text, so
    that rows without an id are spread like others."""
    rest = [F.col(c).cast("string") for c in df.columns
            if c != id_col and not isinstance(df.schema[c].dataType, (T.MapType, T.ArrayType, T.StructType))]
    return F.coalesce(F.col(id_col).cast("string"), F.concat_ws("\x1f", F.lit("null"), *rest))


def stable_bucket(id_col: Column | str, seed: int = 42, buckets: int = 100) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of the seeded md5."""
    head = F.conv(F.substring(_seeded_md5(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def hash_order_key(id_col: Column | str, seed: int = 42) -> Column:
    """Hex string that orders rows pseudo-randomly but reproducibly."""
    return _seeded_md5(id_col, seed)
