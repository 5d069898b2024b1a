"""The classifier chain: held-out accuracy, out-of-fold chaining, odd rows."""

import numpy as np
import pytest

from tunelake.llm import toxicity
from tunelake.llm.queries import op7_toxicity_chain

from .conftest import SF, docs_of

BIG = "/root/testdata/sf0.1"


def test_features():
    got = toxicity.features_of("You IDIOT! idiots, é_a\tx".encode())
    assert {b"you", b"idiot", b"idiots", "é".encode(), b"a", b"x", b"^idi", b"^idio", b"^idiot"} == got
    assert toxicity.features_of(b"") == set()


def test_logistic_finds_the_separating_feature():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (400, 6)).astype(float)
    y = x[:, 2]
    w, b = toxicity.fit_logistic(x, y, 1e-3, 200)
    assert np.argmax(np.abs(w)) == 2 and (((x @ w + b) > 0) == y).all()


def test_later_links_use_earlier_probabilities():
    """The second category equals the first; its own words are missing for
    most rows, so a model without the first probability could not tell."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    present = [np.array([0 if t else 1, rng.integers(2, 20)]) for t in y]
    words = [b"bad", b"good", *(f"w{i}".encode() for i in range(18))]
    chain = toxicity.Chain.fit(["one", "two"], words, present, np.stack([y, y], axis=1), np.arange(300) % 3)
    assert chain.weights[1, len(chain.vocabulary)] > 0 and chain.weights[0, len(chain.vocabulary)] == 0
    p = chain.predict([b"bad w1", b"good w2", b""], 3)
    assert (p[0] > 0.8).all() and (p[1] < 0.2).all()


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_verdicts(docs, labels.filter("doc_id % 2 = 0"))
    rows = got.join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").select("toxic", "label").collect()
    hit = sum(r.toxic and r.label == 1 for r in rows) / sum(r.label == 1 for r in rows)
    wrong = sum(r.toxic and r.label == 0 for r in rows) / sum(r.label == 0 for r in rows)
    assert hit >= 0.85 and wrong <= 0.01


def test_query(spark):
    out = op7_toxicity_chain(spark, SF)
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect()}
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["kept"] != r["toxic"] for r in rows)
    right = [r["toxic"] == (labels[r["doc_id"]] == 1) for r in rows if r["doc_id"] in labels]
    assert sum(right) >= 0.95 * len(right)


def test_odd_rows(spark):
    toxic, clean = "you are an idiot and a clown today", "what a fine day for a long walk"
    rows = [(i, toxic if i % 2 else clean + f" {i}") for i in range(40)]
    rows += [(None, toxic), (None, None), (100, None), (101, ""), (102, clean), (102, toxic), (103, (clean + " ") * 20_000), (103, clean)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (1, 1, None), (2, None, 5)],
                                   "doc_id long, quality int, toxic int")
    kept = toxicity.keep_clean(docs, labels, least_rows=1)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(
        [str(i) for i in range(0, 40, 2)] + ["None", "100", "101", "102", "103", "103"])
    assert toxicity.toxicity_verdicts(docs.limit(0), labels).count() == 0
    assert toxicity.keep_clean(docs, labels.limit(0)).count() == len(rows)
    assert not any(r["toxic"] for r in toxicity.toxicity_verdicts(docs, labels.filter("toxic = 0")).collect())
