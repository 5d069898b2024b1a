"""Quality statistics against a plain count, the forest against held-out labels."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tunelake.llm import quality
from tunelake.llm.queries import op5_quality_forest

from .conftest import SF, docs_of


def plain(text):
    text = text or ""
    word = r"[^\x20\x09-\x0D]+"
    words = re.findall(word, text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(word, x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "a a a a", "a b c a b c", "x\ny\nx\n \n \nx", "é é é é ü#|", "w\x0bv\x0cu\rt", "a b   c"])
def test_counts(text):
    assert quality.rule_counts((text or "").encode())[:5] == plain(text)


def test_random_counts():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", "a b c ", "\t"]) for _ in range(rng.randrange(60)))
        assert quality.rule_counts(text.encode())[:5] == plain(text), text


def test_path_lengths_equal_a_walk():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(500, 3))
    forest = quality.IsolationForest.grow(rows, 20, 64, 3)
    scores = forest.score(rows[:50])
    for x, got in zip(rows, scores):
        total = 0
        for at in forest.roots:
            while forest.column[at] >= 0:
                at = forest.child[at] + (x[forest.column[at]] > forest.cut[at])
            total += forest.length[at]
        c = 2 * (np.log(63) + np.euler_gamma) - 2 * 63 / 64
        assert got == pytest.approx(2 ** (-total / 20 / c))
    far = forest.score(np.array([[30.0, -30, 30], [0, 0, 0]]))
    assert far[0] > 0.65 > 0.5 > far[1]


def test_cut():
    assert quality.pick_cut({(1, 400): 90, (0, 600): 10}, 20) == pytest.approx(0.5005)
    assert quality.pick_cut({(1, 400): 90, (0, 400): 10}, 20) == 2.0
    assert quality.pick_cut({(1, 400): 90}, 20) == 2.0 and quality.pick_cut({}, 20) == 2.0


def test_query(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()}
    got = {r["doc_id"]: r for r in op5_quality_forest(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for d, t in docs.items():
        r, want = got[d], plain(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
        if not r["base_failed"] and d in labels:
            assert r["kept"] == (labels[d] == 1)


def test_held_out_labels(spark):
    """Fitted and calibrated on half of the labels, right on the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.quality_verdicts(docs, labels.filter("doc_id % 2 = 0"), fit_rows=150)
    rows = got.filter("not base_failed").join(labels.filter("doc_id % 2 = 1"), "doc_id").select("kept", "quality").collect()
    assert len(rows) > 100 and sum(r.kept == (r.quality == 1) for r in rows) >= 0.99 * len(rows)


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None), (2, ""), (None, good), (3, good), (3, good), (3, "short"), (4, "again and " * 200_000), (5, good)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(3, 1, 0), (3, None, None), (None, 0, 0), (5, 7, 1)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [0, 3, 3, 5]
    for a, b in ((docs.limit(0), labels), (docs, labels.limit(0))):
        assert quality.quality_verdicts(a, b).count() == a.count()
        assert quality.keep_good(a, b).count() == (4 if a is docs else 0)
