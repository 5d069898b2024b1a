"""Token bigram scores against a plain dictionary model."""

import math
from collections import Counter, defaultdict

import pytest

from tokenizers import Tokenizer

from tunelake.llm import token_lm
from tunelake.llm.queries import op6_lm_difference, tokenizer_path

from .conftest import SF, docs_of


LIBRARY = Tokenizer.from_file(tokenizer_path())


def pairs(text):
    s = [None, *LIBRARY.encode(text or "", add_special_tokens=False).ids, None]
    return list(zip(s, s[1:]))


class Plain:
    """Witten-Bell interpolation written out."""

    def __init__(self, texts, size):
        self.one, self.two, self.size = Counter(), defaultdict(Counter), size
        for t in texts:
            for a, b in pairs(t):
                self.one[b] += 1
                self.two[a][b] += 1

    def loss(self, text):
        out = 0
        for a, b in pairs(text):
            p = 1 / self.size
            for n in (self.one, self.two[a]):
                total = sum(n.values())
                p = (n[b] + sum(v > 0 for v in n.values()) * p) / (total + sum(v > 0 for v in n.values())) if total else p
            out -= math.log(p)
        return out / len(pairs(text))


def expected(texts, target):
    size = len({b for t in texts for _, b in pairs(t)})
    models = Plain([t for t, w in zip(texts, target) if w], size), Plain(texts, size)
    return [(len(pairs(t)), *(m.loss(t) for m in models)) for t in texts]


@pytest.mark.parametrize("head", [0, 400, 1_000_000])
@pytest.mark.parametrize("some", [True, False])
def test_scores(spark, monkeypatch, head, some):
    monkeypatch.setattr(token_lm, "HEAD_GRAMS", head)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(25).collect()]
    rows = [(d, t[:3000]) for d, t in docs] + [(10 ** 7, None), (10 ** 7 + 1, "")]
    ids = [d for d, _ in rows if some and d % 3 == 0]
    got = {r["doc_id"]: r for r in token_lm.token_scores(
        docs_of(spark, rows), spark.createDataFrame([(d,) for d in ids + [None, -5]], "doc_id long"), tokenizer_path()).collect()}
    assert len(got) == len(rows)
    for (d, _), (n, t, b) in zip(rows, expected([t for _, t in rows], [d in ids for d, _ in rows])):
        assert got[d]["n_tokens"] == n
        assert (got[d]["target_loss"], got[d]["background_loss"], got[d]["score"]) == pytest.approx((t, b, t - b), abs=1e-7)


def test_odd_rows(spark):
    rows = [(1, None), (None, "abc"), (None, "abc"), (2, ""), (3, "abc abc"), (3, "abc abc"), (4, "long text " * 100_000), (3, "other")]
    ids = spark.createDataFrame([(3,), (3,), (None,)], "doc_id long")
    got = token_lm.token_scores(docs_of(spark, rows), ids, tokenizer_path()).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted((d or 0, len(pairs(t))) for d, t in rows)
    assert all(math.isfinite(r["score"]) for r in got)
    assert token_lm.token_scores(docs_of(spark, rows).limit(0), ids, tokenizer_path()).count() == 0


def test_query_sees_word_order(spark, tmp_path):
    """Documents of the target's words in another order: their byte trigrams
    are those of the target but for word borders."""
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ren", "sol", "dim", "vat")]
    like, other = " ".join(words), " ".join(words[::-1])
    rows = [(i, like, 1) for i in range(20)] + [(20 + i, other, 0) for i in range(20)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, q, 0) for d, _, q in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    score = {r["doc_id"]: r["score"] for r in op6_lm_difference(spark, str(tmp_path)).collect()}
    assert min(score[d] for d in range(20, 40)) > max(score[d] for d in range(20)) + 1


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_lookups_in_blocks_of_rows(monkeypatch, most):
    import numpy as np
    import pyarrow as pa

    class Shared:
        value = (np.array([1, 5, 9], np.int32), np.array([1.0, 2.0, 3.0]), np.array([0.5, 0.25, 0.125]))

    monkeypatch.setattr(token_lm, "BLOCK_GRAMS", most)
    monkeypatch.setattr(token_lm.F, "arrow_udf", lambda f, _: f)
    sums = token_lm._head_sums(Shared)
    kind = pa.list_(pa.int32())
    found, times = pa.array([[1, 2], [], [5, 9, 11], [7]], kind), pa.array([[1, 2], [], [3, 1, 1], [4]], kind)
    want = [(3, 1.0, 0.5, [2], [2]), (0, 0.0, 0.0, [], []), (5, 9.0, 0.875, [11], [1]), (4, 0.0, 0.0, [7], [4])]
    for lo, n in ((0, 4), (1, 3), (2, 1), (0, 0)):
        got = [tuple(r.values()) for r in sums(found.slice(lo, n), times.slice(lo, n)).to_pylist()]
        assert got == want[lo:lo + n]
