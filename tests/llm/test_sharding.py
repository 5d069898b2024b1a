"""Shards: every row once, sizes near equal, slots gapless, copies together."""

import random
import zlib
from collections import defaultdict

import pytest

from tunelake.llm import sharding
from tunelake.llm.queries import op10_histogram_sharding

from .conftest import SF, docs_of


def check(rows, texts, shards, tolerance):
    """rows (doc_id, shard, slot, size) against the input; sizes within a
    tolerance of the mean, or of the largest row."""
    assert sorted((r["doc_id"], r["size"]) for r in rows) == sorted((d, len((t or "").encode()) + 8) for d, t in texts)
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    total = sum(size.values())
    slack = max(r["size"] for r in rows) + total / shards * tolerance
    assert all(abs(size[s] - total / shards) <= slack for s in range(shards)), dict(size)
    return slots


def test_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = op10_histogram_sharding(spark, SF).collect()
    check(rows, texts, 24, 1 / 32)
    crc = {d: zlib.crc32((t or "").encode()) for d, t in texts}
    assert all(r["text_crc32"] == crc[r["doc_id"]] and r["law"] == "bytes" and r["grown_shard"] is None for r in rows)


@pytest.mark.parametrize("small", [200_000, 0])
def test_hot_text_is_cut_and_others_stay_together(spark, monkeypatch, small):
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", small)
    rng = random.Random(1)
    texts = [(i, "the hot text, a third of all") for i in range(1500)]
    texts += [(2000 + i, f"text {i // 3} " + "x" * (i // 3 % 50)) for i in range(3000)]
    rng.shuffle(texts)
    docs = docs_of(spark, texts)
    rows = sharding.shard_by_bytes(docs, 7).select("doc_id", "shard", "slot", "size", "text").collect()
    check(rows, texts, 7, 1 / 32)
    where = defaultdict(set)
    for r in rows:
        where[r["text"]].add(r["shard"])
    hot = where.pop("the hot text, a third of all")
    assert len(hot) > 1 and all(len(v) == 1 for v in where.values())


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (None, "a"), (None, "a"), (3, "same"), (3, "same"), (4, "é" * 200_000), (5, "same")]
    docs = docs_of(spark, texts)
    out = sharding.shard_by_bytes(docs, 3)
    assert sorted(out.columns) == sorted({*docs.columns, "shard", "slot", "size"})
    rows = out.select(*[f"`{c}`" for c in ("doc_id", "shard", "slot", "size")]).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == sorted((d or 0, len((t or "").encode()) + 8) for d, t in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_by_bytes(docs.limit(0), 3).count() == 0


def test_plan_has_no_python(spark):
    plan = op10_histogram_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
