from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelake.operators import ml as M

from conftest import rows


def test_label_projection(spark):
    df = spark.createDataFrame([("x", True), ("y", False)], "song_lyrics string, explicit boolean")
    assert rows(M.label_projection(df)) == [("x", 1), ("y", 0)]


def test_stable_split_complete_disjoint_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = M.stable_split(df, "doc_id")
    b = M.stable_split(df.repartition(13), "doc_id")
    assert rows(a) == rows(b)
    counts = Counter(r["split"] for r in a.collect())
    assert sum(counts.values()) == 5000
    assert abs(counts["train"] / 5000 - 0.70) < 0.03 and abs(counts["test"] / 5000 - 0.15) < 0.03


def _brute_oversample(pairs):
    import hashlib
    by = {}
    for doc, lab in pairs:
        by.setdefault(lab, []).append(doc)
    target = max(len(v) for v in by.values())
    out = []
    for lab, docs in by.items():
        key = lambda d: (hashlib.md5(f"42:{d}".encode()).hexdigest(), d)
        ordered = sorted(docs, key=key)
        q, r = divmod(target, len(ordered))
        for i, d in enumerate(ordered, start=1):
            for k in range(1, q + (1 if i <= r else 0) + 1):
                out.append((d, lab, k))
    return sorted(out)


def test_oversample_exact_sizes_and_brute_force(spark):
    pairs = [(i, 1 if i % 7 == 0 else 0) for i in range(400)]
    df = spark.createDataFrame(pairs, "doc_id long, label int")
    out = M.oversample(df, "label", id_col="doc_id", bucket_rows=20)
    got = sorted(tuple(r) for r in out.collect())
    assert got == _brute_oversample(pairs)
    sizes = Counter(lab for _, lab, _ in got)
    assert sizes[0] == sizes[1] == max(Counter(lab for _, lab in pairs).values())


def test_require_classes(spark):
    df = spark.createDataFrame([(0,), (0,)], "label int")
    with pytest.raises(ValueError):
        M.require_classes(df)
    assert M.require_classes(df.union(spark.createDataFrame([(1,)], "label int"))) == {0: 2, 1: 1}


def test_metrics_and_zero_denominators(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (0, 0)], "label int, prediction int")
    m = M.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.6, 0.5, 0.5, 0.5)
    none = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    m0 = M.binary_metrics(none).first()
    assert (m0["precision"], m0["recall"], m0["f1"]) == (0.0, 0.0, 0.0)
    cm = {(r["label"], r["prediction"]): r["count"] for r in M.confusion_matrix(none).collect()}
    assert cm == {(1, 1): 0, (0, 1): 0, (1, 0): 1, (0, 0): 1}


def test_argmax_tie_goes_to_zero(spark):
    df = spark.createDataFrame([(0.1, 0.9), (0.5, 0.5), (0.9, 0.1)], "a double, b double")
    assert [r[0] for r in df.select(M.argmax_prediction("a", "b")).collect()] == [1, 0, 0]


def test_sample_rows_reproducible(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    a = [r[0] for r in M.sample_rows(df, 5).collect()]
    b = [r[0] for r in M.sample_rows(df.repartition(5), 5).collect()]
    assert a == b and len(a) == 5


def test_train_and_evaluate_runs(spark):
    texts = [(i, ("bad word " * 3 if i % 3 == 0 else "nice calm text ") + str(i), 1 if i % 3 == 0 else 0)
             for i in range(120)]
    df = spark.createDataFrame(texts, "doc_id long, song_lyrics string, label int")
    _, preds, metrics = M.train_and_evaluate(df, id_col="doc_id", eval_split="train")
    assert preds.count() > 0
    assert metrics.first()["accuracy"] > 0.9


def test_logistic_model_after_observation(spark, tmp_dir):
    # A logistic model's training summary references the session; after the
    # session served an Observation that reference cannot be serialized, so
    # the stored (summary-free) copy must be used.
    from pyspark.sql import Observation
    obs = Observation("warm")
    spark.range(3).observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    texts = [(i, ("bad word " * 3 if i % 3 == 0 else "nice calm text ") + str(i), 1 if i % 3 == 0 else 0)
             for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id long, song_lyrics string, label int")
    _, preds, metrics = M.train_and_evaluate(df, id_col="doc_id", eval_split="train", model="logistic",
                                             model_dir=f"{tmp_dir}/model")
    assert preds.count() > 0 and metrics.first()["accuracy"] > 0.9


def test_text_classifier_rejects_unknown_model():
    with pytest.raises(ValueError):
        M.text_classifier(model="forest")


def test_null_ids_and_labels_are_kept(spark):
    df = spark.createDataFrame([(None, 0, f"x{i}") for i in range(200)] + [(1, 1, "a"), (None, 1, "b"), (2, None, "c")],
                               "doc_id long, label int, extra string")
    out = M.oversample(df, "label", id_col="doc_id", bucket_rows=30).collect()
    assert Counter(r["label"] for r in out) == {0: 200, 1: 200, None: 1}
    assert len({tuple(r)[:3] for r in out}) == 203
    splits = Counter(r["split"] for r in M.stable_split(df, "doc_id").collect())
    assert set(splits) == {"train", "validation", "test"} and splits["train"] > 100
    many = spark.range(2000).selectExpr("id AS doc_id", "id AS label")
    with pytest.raises(ValueError, match="no class label"):
        M.oversample(many, "label", id_col="doc_id")


def test_tokens_of_any_script(spark):
    from pyspark.ml.feature import RegexTokenizer
    df = spark.createDataFrame([("canción señorita", ), ("Привет, мир!", ), ("日本語 の歌", )], "t string")
    out = RegexTokenizer(inputCol="t", outputCol="w", pattern=M.TOKEN_GAPS).transform(df).collect()
    assert [r["w"] for r in out] == [["canción", "señorita"], ["привет", "мир"], ["日本語", "の歌"]]


def test_classifier_beats_the_majority_guess(spark):
    """Two settings compared on validation; F1 on held-out rows."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", F.col("text").alias("song_lyrics"))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    _, preds, metrics = M.train_and_evaluate(labels.join(docs, "doc_id"), id_col="doc_id")
    positives = preds.filter("label = 1").count() / preds.count()
    assert metrics.first()["f1"] > 2 * positives / (1 + positives) + 0.2     # guessing 1 everywhere


def test_missing_predictions_count_as_not_positive(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, None), (0, 1), (None, 1)], "label int, prediction int")
    m = M.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.5, 0.5, 0.5)


def test_oversample_hot_id_is_exact(spark):
    """One id on a third of the rows, some of them alike, holds the cut of its class."""
    from collections import Counter
    import hashlib
    rows_ = [("hot", k % 3, 1) for k in range(200)] + [(f"a{k}", 0, 1) for k in range(37)] + [(f"b{k}", 0, 0) for k in range(701)]
    df = spark.createDataFrame(rows_, "id string, extra int, label int").repartition(5)
    for seed in range(6):
        got = Counter((r["id"], r["extra"], r["label"]) for r in M.oversample(df, "label", id_col="id", seed=seed, bucket_rows=20).collect())
        key = lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0], r[1])
        ones = sorted((r for r in rows_ if r[2] == 1), key=key)
        want = Counter(r for r in rows_ if r[2] == 0)
        for k, r in enumerate(ones):
            want[r] += 701 // 237 + (k < 701 % 237)
        assert got == want


def test_oversample_expands_a_tiny_class_in_pieces(spark):
    df = spark.createDataFrame([(k, 0) for k in range(500)] + [(1000, 1)], "id long, label int")
    out = M.oversample(df, "label", id_col="id", bucket_rows=40).filter("label = 1")
    assert sorted(r["replica"] for r in out.collect()) == list(range(1, 501))


def test_oversample_numbers_no_class(spark):
    """No window over a class or an id: only over counts, and inside ranges of the rows at the cut."""
    df = spark.createDataFrame([(k % 50, k, int(k % 7 == 0)) for k in range(400)], "id long, extra long, label int")
    plan = M.oversample(df, "label", id_col="id", bucket_rows=30)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def _naive_bayes(train, docs, smoothing, least):
    import math
    import re
    from collections import Counter
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    counts = [Counter(w for t, y in train if y == k for w in words(t)) for k in (0, 1)]
    vocabulary = set(counts[0]) | set(counts[1])
    total = [sum(c.values()) + smoothing * len(vocabulary) for c in counts]
    weight = {w: round(1e6 * (math.log((counts[1][w] + smoothing) / total[1]) - math.log((counts[0][w] + smoothing) / total[0])))
              for w in vocabulary}
    weight = {w: v for w, v in weight.items() if abs(v) >= least * 1e6}
    return [sum(weight.get(w, 0) for w in words(t)) for t in docs]


def test_naive_bayes_equals_plain_counts(spark):
    import random
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "naïve", "x_y", "日本"]
    text = lambda lean: " ".join(rng.choice(vocabulary[lean:lean + 20]) for _ in range(rng.randrange(12)))
    train = [(text(14 * (k % 2)), k % 2) for k in range(80)] + [(None, 1), ("", 0), ("w1 w1", None)]
    docs = [text(14 * (k % 2)) for k in range(40)] + [None, "", "never seen", "w1 " * 5000]
    weights = M.naive_bayes_weights(spark.createDataFrame(train, "song_lyrics string, label int"))
    frame = spark.createDataFrame(list(enumerate(docs)), "id long, song_lyrics string")
    got = {r["id"]: r["scores"] for r in M.naive_bayes_scores(frame, weights, "id").collect()}
    for n, (smoothing, least) in enumerate(M.NAIVE_BAYES_SETTINGS):
        want = _naive_bayes(train, docs, smoothing, least)
        assert all(abs(got[k][n] - s) <= (5000 if k == 43 else 12) for k, s in enumerate(want))


def test_naive_bayes_beats_the_majority_guess(spark):
    from tunelake.plans.catalogue import q_classifier_scores
    preds = q_classifier_scores(spark, "/root/testdata/sf0.01")
    f1 = M.binary_metrics(preds).first()["f1"]
    always = M.binary_metrics(preds.drop("prediction").selectExpr("*", "1 as prediction")).first()["f1"]
    assert f1 > always  # guessing the majority, 0, has an F1 of 0


def test_naive_bayes_without_training_rows(spark):
    none = spark.createDataFrame([], "song_lyrics string, label int")
    frame = spark.createDataFrame([(1, "a b")], "id long, song_lyrics string")
    assert M.naive_bayes_scores(frame, M.naive_bayes_weights(none), "id").first()["scores"] == [0] * len(M.NAIVE_BAYES_SETTINGS)


def test_split_classes_counts_absent_classes_and_ignores_other_labels(spark):
    df = spark.createDataFrame([("train", 0), ("train", 1), ("train", 1), ("train", 7), ("train", None), ("test", 1), (None, 0)],
                               "split string, label int")
    got = {(r["split"], r["label"]): (r["rows"], r["complete"]) for r in M.split_classes(df).collect()}
    assert got == {("train", 0): (1, True), ("train", 1): (2, True), ("validation", 0): (0, False), ("validation", 1): (0, False),
                   ("test", 0): (0, False), ("test", 1): (1, False)}
    assert {r["rows"] for r in M.split_classes(df.filter("false")).collect()} == {0}
