"""SimHash against brute force: fingerprints word by word, links pair by pair."""

import random
import re

import numpy as np
import pytest
import xxhash

from tunelake.llm import simhash
from tunelake.llm.components import components
from tunelake.llm.queries import op8_simhash_dedup

from .conftest import SF, docs_of, union_find


def plain_fingerprint(text, shingle=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def close(values, bits=4):
    return [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= bits]


@pytest.mark.parametrize("text", ["", " \t\n", "one", "Two Words", "ÄÖ a B c d e", "a b c d " * 50, "x\x0by\x0cz w  q r s"])
def test_fingerprint(text):
    assert simhash.simhash64(text.encode(), 4) == plain_fingerprint(text)


def some_values(seed, n=300):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 10)] + [0, (1 << 64) - 1]
    out = set()
    for c in centres:
        for _ in range(10):
            v = c
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_links_connect_what_pairs_connect(spark, bits):
    values = some_values(bits)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    got = simhash.link_fingerprints(spark.createDataFrame(signed, "value long").repartition(3), bits).collect()
    pairs = [tuple(int(np.int64(x).astype(np.uint64)) for x in r) for r in got]
    assert all(a in values and b in values for a, b in pairs)
    assert union_find(values, pairs) == union_find(values, close(values, bits))


def test_large_deals_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(simhash, "PAIR_ROWS", 50)
    values = [0x1234567 ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)] + some_values(5, 100)
    values = sorted(set(values))
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    got = simhash.link_fingerprints(spark.createDataFrame(signed, "value long"), 4).collect()
    pairs = [tuple(int(np.int64(x).astype(np.uint64)) for x in r) for r in got]
    assert union_find(values, pairs) == union_find(values, close(values))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(50)] + [(50, 49), (None, 3), (70, 60)]])
def test_components(spark, edges):
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    whole = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == union_find({n for e in whole for n in e}, whole)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {d: plain_fingerprint(t) for d, t in docs}
    values = sorted(set(prints.values()))
    group = union_find(values, close(values))
    least = {}
    for d, v in prints.items():
        least[group[v]] = min(d, least.get(group[v], d))
    got = {r[0]: (r[1], r[2]) for r in op8_simhash_dedup(spark, SF).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == {d: (f"{v:016x}", least[group[v]]) for d, v in prints.items()}


def test_odd_rows(spark):
    text = "a quick brown fox jumps over the lazy dog again and again"
    long = "lorem ipsum dolor " * 30_000
    rows = [(1, text), (2, text), (2, text), (None, text), (None, None), (5, None), (6, ""), (7, " \n"), (8, long), (9, "other words here entirely"), (9, text)]
    docs = docs_of(spark, rows)
    got = sorted((r[0] if r[0] is not None else -1, r[2]) for r in simhash.simhash_groups(docs).collect())
    assert got == [(-1, None), (-1, None), (1, 1), (2, 1), (2, 1), (5, 5), (6, 5), (7, 5), (8, 8), (9, 1), (9, 9)]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] == text) for r in kept.select("doc_id", "text").collect()) == [
        (-1, False), (-1, True), (1, True), (5, False), (8, False), (9, False)]
    empty = docs.limit(0)
    assert simhash.simhash_groups(empty).count() == 0 and simhash.one_per_group(empty).count() == 0
