"""Histogram sort into shards of nearly equal bytes (DataFrame functions only).

The sort key of a row is the pair of 63-bit hashes (h of the text, g of the
id). Equal texts are therefore neighbours, and a group of copies is cut only
where it alone is larger than the tolerance. Splitters are found by counting:

1. the exact bytes and rows of every interval of the key are counted below
   equally spaced probes (one partial aggregate over narrow rows);
2. intervals holding more than the tolerance get new probes inside, on h
   while it varies and then on g, and only their rows are counted again;
3. when every interval meets the tolerance (or holds a single key), running
   sums over the intervals give each its shard and its first slot.

Then the rows move once, keyed by interval, and are numbered inside it. The
number of intervals depends on shards and tolerance, never on the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import quoted, store

KEY_BITS = 63
FIRST_BITS = 12
STEP_BITS = 6
# Intervals sent to every task; beyond this the join shuffles instead.
BROADCAST_ROWS = 200_000


def _keys(id_col: str, text_col: str) -> dict:
    text = F.coalesce(quoted(text_col), F.lit(""))
    return {
        "h": F.shiftrightunsigned(F.xxhash64(text), 1),
        "g": F.shiftrightunsigned(F.xxhash64(F.lit("id"), quoted(id_col)), 1),
        "size": F.octet_length(text).cast("long") + 8,
    }


def _counted(rows: DataFrame, nh, ng) -> DataFrame:
    """Exact counts of the intervals given by the first nh bits of h and ng of g."""
    return (rows.select("h", "g", "size", nh.cast("int").alias("nh"), ng.cast("int").alias("ng"))
            .withColumn("hc", F.expr("shiftright(h, 63 - nh)"))
            .withColumn("gc", F.expr("shiftright(g, 63 - ng)"))
            .groupBy("nh", "ng", "hc", "gc")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                 F.min("h").alias("h0"), F.max("h").alias("h1"),
                 F.min("g").alias("g0"), F.max("g").alias("g1")))


def intervals(keys: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """Stored table of key intervals: nh, ng, hc, gc (which keys), cell,
    shard, first (slot of the interval's first row in its shard)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    most = max(1, int(total * tolerance / shards))
    vary_h = (F.col("h0") < F.col("h1")) & (F.col("nh") < KEY_BITS)
    vary_g = (F.col("g0") < F.col("g1")) & (F.col("ng") < KEY_BITS)
    heavy = (F.col("bytes") > most) & (vary_h | vary_g)
    level = _counted(keys, F.lit(FIRST_BITS), F.lit(0))
    done = []
    while True:
        level = store(level.withColumn("heavy", heavy), "probes")
        done.append(level.filter(~F.col("heavy")))
        open_ = level.filter("heavy").withColumn("on_h", vary_h)
        forms = open_.select("nh", "ng").distinct().collect()
        if not forms:
            break
        # bounded: the open intervals hold more than `most` bytes each
        parts = []
        for nh, ng in forms:
            here = open_.filter((F.col("nh") == nh) & (F.col("ng") == ng)).select("nh", "ng", "hc", "gc", "on_h")
            parts.append(_located(keys, nh, ng).join(F.broadcast(here), ["hc", "gc"]))
        rows = reduce(DataFrame.unionByName, parts)
        level = _counted(rows,
                         F.expr(f"if(on_h, least({KEY_BITS}, nh + {STEP_BITS}), nh)"),
                         F.expr(f"if(on_h, ng, least({KEY_BITS}, ng + {STEP_BITS}))"))
    cells = (reduce(DataFrame.unionByName, done)
             .withColumn("lo_h", F.expr("shiftleft(hc, 63 - nh)"))
             .withColumn("lo_g", F.expr("shiftleft(gc, 63 - ng)")))
    # one row per interval: bounded by shards and tolerance, so one task may order them
    order = Window.orderBy("lo_h", "lo_g")
    before = F.sum("bytes").over(order) - F.col("bytes") / 2
    cells = (cells.withColumn("cell", F.row_number().over(order))
             .withColumn("shard", F.least(F.lit(shards - 1), F.floor(before * shards / F.lit(max(1, total)))).cast("int")))
    in_shard = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("first", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
    return store(cells.select("nh", "ng", "hc", "gc", "cell", "shard", "first"), "intervals")


def _located(rows: DataFrame, nh: int, ng: int) -> DataFrame:
    return (rows.withColumn("hc", F.shiftright("h", KEY_BITS - nh))
            .withColumn("gc", F.shiftright("g", KEY_BITS - ng)))


def shard_by_bytes(docs: DataFrame, shards: int = 24, *, id_col: str = "doc_id", text_col: str = "text",
                   keep: list | None = None, tolerance: float = 1 / 64) -> DataFrame:
    """``keep`` columns (default: all of ``docs``) plus ``shard`` (0 to
    shards - 1), ``slot`` (0, 1, ... inside the shard, in key order) and
    ``size`` (UTF-8 bytes of the text plus 8).

    Shard sizes differ from total/shards by at most about ``tolerance`` of it,
    or by the largest set of rows equal in text and id. Null text counts as empty. A null id is a value like
    any other. Repeated rows are kept, in one shard. Input columns named
    ``shard``, ``slot`` or ``size`` are replaced. An empty table gives an
    empty result.
    """
    keys = docs.select(*[c.alias(n) for n, c in _keys(id_col, text_col).items()])
    keys = store(keys, "shard-keys")
    cells = intervals(keys, shards, tolerance)
    keep = [quoted(c) for c in docs.columns if c not in ("shard", "slot", "size")] if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("row"), *[c.alias(n) for n, c in _keys(id_col, text_col).items()])
    forms = sorted(cells.select("nh", "ng").distinct().collect())
    small = cells.count() <= BROADCAST_ROWS
    for k, (nh, ng) in enumerate(forms):
        here = (cells.filter((F.col("nh") == nh) & (F.col("ng") == ng))
                .select("hc", "gc", F.struct("cell", "shard", "first").alias(f"at{k}")))
        rows = (_located(rows, nh, ng).join(F.broadcast(here) if small else here, ["hc", "gc"], "left")
                .drop("hc", "gc"))
    at = F.coalesce(*[F.col(f"at{k}") for k in range(len(forms))]) if forms else F.expr(
        "named_struct('cell', 0, 'shard', 0, 'first', 0L)")
    rows = rows.withColumn("at", at)
    in_cell = Window.partitionBy("at.cell").orderBy("h", "g")
    return rows.select("row.*", F.col("at.shard").alias("shard"),
                       (F.col("at.first") + F.row_number().over(in_cell) - 1).alias("slot"), "size")
