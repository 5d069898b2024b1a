"""Packing: every id in one place, sequences within size, little padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunelake.llm import packing
from tunelake.llm.queries import op9_spf_packing, tokenizer_path

from .conftest import SF, docs_of


@pytest.mark.parametrize("histogram", [{}, {7: 1}, {1024: 5}, {100: 1000}, {300: 1000, 700: 999},
                                       dict(Counter(random.Random(1).choices(range(1, 1025), k=5000)))])
def test_patterns_hold_every_piece_once(histogram):
    packs = packing.shortest_pack_first(histogram, 1024)
    held = Counter()
    for pattern, count in packs:
        assert count > 0 and sum(pattern) <= 1024 and list(pattern) == sorted(pattern, reverse=True)
        for n in pattern:
            held[n] += count
    assert held == Counter(histogram)


def plain_shortest_pack_first(lengths, size):
    packs = []
    for n in sorted(lengths, reverse=True):
        fit = [p for p in packs if sum(p) + n <= size]
        if fit:
            min(fit, key=sum).append(n)
        else:
            packs.append([n])
    return Counter(sum(p) for p in packs)


def test_same_as_one_piece_at_a_time():
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(60))]
        packs = packing.shortest_pack_first(Counter(lengths), 64)
        assert sum(c for _, c in packs) == sum(plain_shortest_pack_first(lengths, 64).values())


def check(rows, want, size=1024):
    """rows of the operator against ids per (doc_id, copy)."""
    pieces = defaultdict(list)
    used = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = {d: sorted((a, n, zlib.crc32(np.array(v[a:a + n], "<u4").tobytes()), len(v))
                          for v in copies for a, n in packing.cut(len(v), size)) for d, copies in want.items()}
    assert {d: sorted(v) for d, v in pieces.items()} == expected
    assert sorted(used) == list(range(len(used)))
    for at in used.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= size
    return sum(n for v in used.values() for _, n in v) / max(1, size * len(used))


def test_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d: [library.encode(t or "", add_special_tokens=False).ids + [0]] for d, t in docs}
    assert check(op9_spf_packing(spark, SF).collect(), want) > 0.97


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 3)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, None), (None, "a b"), (2, ""), (2, "x y z"), (2, "x y z"), (3, "word " * 5000)] + [(10 + i, "same text") for i in range(40)]
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    docs = docs_of(spark, rows)
    check(packing.pack_documents(docs, tokenizer_path()).collect(), want)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0
