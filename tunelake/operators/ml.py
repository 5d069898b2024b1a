"""Classifier data preparation and evaluation (JOB15).

Splits and samples hash a stable id with md5, so they do not move when the
cluster or the partitioning changes. Oversampling is exact (every class
reaches the majority size) and distributed: prefix sums over counts per hash
tell at which id each class's extra copies end, so rows are not numbered, and
neither a class nor an id is gathered in one task. The text classifiers
balance their classes by weights, which copies no text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.functions.casts import lenient_cast
from tunelake.functions.hashing import hash_order_key, null_safe_id, stable_bucket
from tunelake.session import shared_dir

SPLIT_BUCKETS = 10000


def label_projection(df: DataFrame, text_col: str = "song_lyrics", label_col: str = "explicit",
                     label_name: str = "label") -> DataFrame:
    """ML1: ``(text, label int)``; a label that is text is read as a boolean
    (``True``, ``false``, ``1``, ...), a bad one is NULL."""
    return df.select(F.col(text_col), lenient_cast(label_col, "boolean").cast("int").alias(label_name))


def split_column(id_col: str | Column, seed: int = S.SPLIT_SEED,
                 fractions: Sequence[float] = S.SPLIT_FRACTIONS) -> Column:
    """ML2: ``train``/``validation``/``test`` from the id's md5 bucket."""
    bucket = stable_bucket(id_col, seed, SPLIT_BUCKETS)
    train_end = int(round(fractions[0] * SPLIT_BUCKETS))
    valid_end = int(round((fractions[0] + fractions[1]) * SPLIT_BUCKETS))
    return (F.when(bucket < train_end, F.lit("train"))
             .when(bucket < valid_end, F.lit("validation"))
             .otherwise(F.lit("test")))


def stable_split(df: DataFrame, id_col: str, seed: int = S.SPLIT_SEED,
                 fractions: Sequence[float] = S.SPLIT_FRACTIONS, split_col: str = "split") -> DataFrame:
    """ML2: tag each row with its split; sizes are approximately the fractions.
    A row without an id is placed by its other columns."""
    return df.withColumn(split_col, split_column(null_safe_id(df, id_col), seed, fractions))


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """AGG10."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))


def require_classes(df: DataFrame, label_col: str = "label", classes: Sequence = (0, 1)) -> dict:
    """ML3: raise unless every class occurs. Only the classes are counted, so
    at most one row each is collected."""
    wanted = df.filter(F.col(label_col).isin(*classes))
    found = {r[0]: r[1] for r in class_counts(wanted, label_col).collect()}
    missing = [c for c in classes if found.get(c, 0) == 0]
    if missing:
        raise ValueError(f"split lacks classes {missing}: {found}")
    return found


def split_classes(df: DataFrame, split_col: str = "split", label_col: str = "label",
                  splits: Sequence[str] = ("train", "validation", "test"), classes: Sequence = (0, 1)) -> DataFrame:
    """ML3 as a report: rows of every class in every split, absent ones with 0,
    and whether the split holds all classes. One aggregate with a column per
    (split, class), so no split is gathered; other labels are no class."""
    cells = [(s, c) for s in splits for c in classes]
    wide = df.agg(*[F.count(F.when((F.col(split_col) == s) & (F.col(label_col) == c), 1)).alias(f"n{i}")
                    for i, (s, c) in enumerate(cells)])
    whole = {s: reduce(lambda x, y: x & y, [F.col(f"n{i}") > 0 for i, (t, _) in enumerate(cells) if t == s]) for s in splits}
    rows = [F.struct(F.lit(s).alias(split_col), F.lit(c).alias(label_col), F.col(f"n{i}").alias("rows"),
                     whole[s].alias("complete")) for i, (s, c) in enumerate(cells)]
    return wide.select(F.inline(F.array(*rows)))


MAX_CLASSES = 1000
BUCKET_ROWS = 50_000


def class_sizes(df: DataFrame, label_col: str) -> dict:
    """Rows per class (NULL is no class); more than MAX_CLASSES raise."""
    rows = class_counts(df.filter(F.col(label_col).isNotNull()), label_col).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col} has over {MAX_CLASSES} values; it is no class label")
    return {r[0]: r[1] for r in rows}


def _cuts(keyed: DataFrame, label_col: str, extra: dict, buckets: int) -> dict:
    """Per class the hash key at which its first ``extra`` rows end, and how
    many rows come before that key. Counts per hash range first, then counts
    per key inside the one range that holds the cut."""
    head = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint")
    wanted = {k: n for k, n in extra.items() if n}
    if not wanted:
        return {}
    need = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])[F.col(label_col)]
    counted = (keyed.withColumn("__bucket", F.floor(head * F.lit(buckets) / F.lit(1 << 32)))
               .filter(F.col(label_col).isin(*wanted)))

    def reached(counts: DataFrame, start: Column, by: str) -> DataFrame:
        """The first ``by`` of each class at which the running count reaches the cut."""
        upto = F.sum("__n").over(Window.partitionBy(label_col).orderBy(by)) + start
        return (counts.withColumn("__upto", upto).filter(F.col("__upto") >= need)
                .groupBy(label_col).agg(F.min(F.struct(by, (F.col("__upto") - F.col("__n")).alias("before"))).alias("at")))

    sizes = counted.groupBy(label_col, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    at = {r[0]: (r["at"]["__bucket"], r["at"]["before"]) for r in reached(sizes, F.lit(0), "__bucket").collect()}  # a row per class
    inside = F.create_map(*[F.lit(x) for k, (bucket, _) in at.items() for x in (k, bucket)])[F.col(label_col)]
    before = F.create_map(*[F.lit(x) for k, (_, n) in at.items() for x in (k, n)])[F.col(label_col)]
    keys = counted.filter(F.col("__bucket") == inside).groupBy(label_col, "__key").agg(F.count(F.lit(1)).alias("__n"))
    return {r[0]: (r["at"]["__key"], r["at"]["before"]) for r in reached(keys, before, "__key").collect()}


def _numbered(rows: DataFrame, order: Sequence[str], within: str) -> DataFrame:
    """``rows`` with ``__rn``, their number from 1 within ``within`` by
    ``order``. They are dealt by ranges of the order and numbered from the
    sizes of the ranges before; equal rows go first to one row with a count,
    and are numbered as a run."""
    spark = rows.sparkSession
    folded = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__m"))
    asc = [F.col(c).asc_nulls_first() for c in order]
    path = shared_dir(spark, "numbered")
    folded.repartitionByRange(within, *asc).withColumn("__part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    dealt = spark.read.parquet(path)
    parts = dealt.groupBy(within, "__part").agg(F.sum("__m").alias("__n"))
    offset = F.sum("__n").over(Window.partitionBy(within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(within, "__part", F.coalesce(offset, F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(within, "__part").orderBy(*asc).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn("__before", F.coalesce(F.sum("__m").over(inside), F.lit(0))).join(parts, [within, "__part"])
            .withColumn("__before", F.col("__before") + F.col("__offset")).drop("__part", "__offset"))


def _spread(df: DataFrame, first: Column, last: Column, col: str, most: int) -> DataFrame:
    """A row for every number from ``first`` to ``last`` as ``col``; long
    ranges are cut and dealt out before they are expanded."""
    df = df.withColumns({"__first": first.cast("bigint"), "__last": last.cast("bigint")}).filter("__last >= __first")
    short = df.filter(F.col("__last") - F.col("__first") < most)
    long_ = (df.filter(F.col("__last") - F.col("__first") >= most)
             .withColumn("__first", F.explode(F.sequence("__first", "__last", F.lit(most).cast("bigint"))))
             .withColumn("__last", F.least("__last", F.col("__first") + (most - 1))).repartition("__first"))
    return (short.unionByName(long_).withColumn(col, F.explode(F.sequence("__first", "__last")))
            .drop("__first", "__last"))


def oversample(df: DataFrame, label_col: str = "label", id_col: str | None = None,
               seed: int = S.SPLIT_SEED, replica_col: str = "replica", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """ML4: replicate every class cyclically up to the majority class size.

    Rows of a class are ordered by ``md5(seed:id)`` (then the other columns);
    with ``n`` rows and target ``N`` the first ``N mod n`` rows get
    ``N div n + 1`` copies and the rest ``N div n``, so each class ends with
    exactly ``N`` rows. ``replica`` numbers the copies of a row from 1. Only
    the id at which a class's extra copies end has its rows numbered; all
    others know their copies from their hash. A row without an id is ordered
    by its other columns; a row without a label belongs to no class and is
    kept once.
    """
    id_col = id_col or df.columns[0]
    sizes = class_sizes(df, label_col)
    once = df.withColumn(replica_col, F.lit(1))
    if not sizes:
        return once
    target = max(sizes.values())
    extra = {k: target % n for k, n in sizes.items()}
    keyed = df.filter(F.col(label_col).isNotNull()).withColumn("__key", hash_order_key(null_safe_id(df, id_col), seed))
    cuts = _cuts(keyed, label_col, extra, -(-target // bucket_rows))
    base = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, target // n)])[F.col(label_col)]
    if cuts:
        cut = F.create_map(*[F.lit(x) for k, (key, _) in cuts.items() for x in (k, key)])[F.col(label_col)]
        left = F.create_map(*[F.lit(x) for k, (_, before) in cuts.items() for x in (k, extra[k] - before)])[F.col(label_col)]
    else:
        cut, left = F.lit(None).cast("string"), F.lit(0)
    at_cut = F.coalesce(F.col("__key") == cut, F.lit(False))
    plain = keyed.filter(~at_cut).withColumn("__copies", base + F.coalesce(F.col("__key") < cut, F.lit(False)).cast("int"))
    out = _spread(plain.drop("__key"), F.lit(1), F.col("__copies"), replica_col, bucket_rows)
    if cuts:
        tie = [c for c in df.columns if c != label_col]
        runs = _numbered(keyed.filter(at_cut).drop("__key"), tie, label_col)
        more = F.greatest(F.lit(0), F.least(F.col("__m"), left - F.col("__before")))  # rows of the run with an extra copy
        each = _spread(runs.withColumn("__more", more), F.lit(1), F.col("__m"), "__nth", bucket_rows)
        each = each.withColumn("__copies", base + (F.col("__nth") <= F.col("__more")).cast("int"))
        out = out.unionByName(_spread(each, F.lit(1), F.col("__copies"), replica_col, bucket_rows), allowMissingColumns=True)
    out = out.select(*df.columns, F.col(replica_col).cast("int").alias(replica_col))
    return out.unionByName(once.filter(F.col(label_col).isNull()))


def sample_rows(df: DataFrame, n: int = 5, id_col: str | None = None, seed: int = S.SPLIT_SEED) -> DataFrame:
    """ML5: n rows in a reproducible pseudo-random order (a top-k, not a scan)."""
    id_col = id_col or df.columns[0]
    return df.orderBy(hash_order_key(id_col, seed), *[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


def argmax_prediction(logit0: str | Column, logit1: str | Column) -> Column:
    """FN16: class 1 only when its score is strictly larger (a tie gives 0)."""
    a = F.col(logit0) if isinstance(logit0, str) else logit0
    b = F.col(logit1) if isinstance(logit1, str) else logit1
    return F.when(b > a, F.lit(1)).otherwise(F.lit(0))


def _confusion_counts(label: Column, pred: Column, positive) -> list[Column]:
    # a row without a label is not judged; a missing prediction is not positive
    pos_l, pos_p = label == F.lit(positive), F.coalesce(pred == F.lit(positive), F.lit(False))
    return [F.count_if(pos_l & pos_p).alias("tp"), F.count_if(~pos_l & pos_p).alias("fp"),
            F.count_if(pos_l & ~pos_p).alias("fn"), F.count_if(~pos_l & ~pos_p).alias("tn")]


def binary_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                   positive=1) -> DataFrame:
    """AGG12: accuracy, precision, recall and F1 of the positive class in one
    aggregate; a zero denominator gives 0 (no exception, no NaN)."""
    counts = df.agg(*_confusion_counts(F.col(label_col), F.col(pred_col), positive))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def ratio(num: Column, den: Column) -> Column:
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return counts.select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """AGG13: long ``(label, prediction, count)`` with all four cells of a
    0/1 problem, zeros included."""
    counts = df.agg(*_confusion_counts(F.col(label_col), F.col(pred_col), 1))
    return counts.select(F.explode(F.array(
        F.struct(F.lit(1).alias("label"), F.lit(1).alias("prediction"), F.col("tp").alias("count")),
        F.struct(F.lit(0).alias("label"), F.lit(1).alias("prediction"), F.col("fp").alias("count")),
        F.struct(F.lit(1).alias("label"), F.lit(0).alias("prediction"), F.col("fn").alias("count")),
        F.struct(F.lit(0).alias("label"), F.lit(0).alias("prediction"), F.col("tn").alias("count")),
    )).alias("c")).select("c.label", "c.prediction", "c.count")


# Words of the relational classifier: runs of letters and digits.
WORD_PATTERN = r"([\p{L}\p{N}]+)"

# Weights are whole numbers of this fraction of a natural logarithm, so sums do
# not depend on their order.
LOG_UNIT = 1_000_000


def word_counts(df: DataFrame, text_col: str, by: Sequence[str]) -> DataFrame:
    """(by..., token, n): how often each lower-cased word occurs."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD_PATTERN), F.lit(1))
    return (df.select(*by, F.explode(words).alias("token")).groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n")))


# Settings compared on the validation part: smoothing, and the least log-odds
# (either way) of a word that counts; weak words outvote the telling ones in
# long texts.
NAIVE_BAYES_SETTINGS = ((1.0, 0.0), (1.0, 2.0), (1.0, 4.0), (0.1, 2.0), (0.1, 4.0), (0.1, 6.0))


def naive_bayes_weights(train: DataFrame, text_col: str = "song_lyrics", label_col: str = "label",
                        settings: Sequence[tuple[float, float]] = NAIVE_BAYES_SETTINGS) -> DataFrame:
    """ML6 as relations: multinomial naive Bayes of a 0/1 label, its classes
    weighed equally. One row per word of the training texts: token, and
    weights, for each setting (smoothing, least) its smoothed log-odds for
    class 1 in units of 1/``LOG_UNIT``, 0 where they are below ``least``.

    Words and totals are aggregates (partial before the shuffle). The counts
    are written once in the shared folder; the totals are one row of them. Rows
    without a label do not count.
    """
    labelled = train.filter(F.col(label_col).isin(0, 1))
    counts = (word_counts(labelled, text_col, [label_col]).groupBy("token")
              .agg(*[F.sum(F.when(F.col(label_col) == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]))
    path = shared_dir(train.sparkSession, "word_counts")
    counts.write.mode("overwrite").parquet(path)
    counts = train.sparkSession.read.parquet(path)
    *totals, words = counts.agg(F.sum("n0"), F.sum("n1"), F.count(F.lit(1))).first()

    def weight(smoothing: float, least: float) -> Column:
        share = [F.log((F.col(f"n{k}") + F.lit(smoothing)) / F.lit((totals[k] or 0) + smoothing * words)) for k in (0, 1)]
        whole = F.round((share[1] - share[0]) * F.lit(float(LOG_UNIT))).cast("bigint")
        return F.when(F.abs(whole) >= F.lit(int(least * LOG_UNIT)), whole).otherwise(0)

    return counts.select("token", F.array(*[weight(*s) for s in settings]).alias("weights"))


def naive_bayes_scores(docs: DataFrame, weights: DataFrame, id_col: str, text_col: str = "song_lyrics",
                       n_settings: int = len(NAIVE_BAYES_SETTINGS)) -> DataFrame:
    """``docs`` without the text, with scores: for each setting the weights of
    its words, summed (words without a weight count nothing). Rows are told
    apart by ``id_col``, which must be unique and not NULL."""
    words = word_counts(docs, text_col, [id_col])
    sums = [F.sum(F.col("n") * F.col("weights")[k]).alias(f"s{k}") for k in range(n_settings)]
    scored = words.join(weights, "token").groupBy(id_col).agg(*sums)
    rest = docs.drop(text_col).join(scored, id_col, "left")
    return rest.select(*docs.drop(text_col).columns, F.array(*[F.coalesce(f"s{k}", F.lit(0)) for k in range(n_settings)]).alias("scores"))


def evaluate_naive_bayes(data: DataFrame, id_col: str, text_col: str = "song_lyrics", label_col: str = "label",
                         seed: int = S.SPLIT_SEED, eval_split: str = "test",
                         settings: Sequence[tuple[float, float]] = NAIVE_BAYES_SETTINGS) -> DataFrame:
    """JOB15 without a library model: split, weights from the training part,
    the setting of the best F1 on the validation part (the first of equals),
    and the part to judge: (id, label, score, prediction). The prediction is 1
    where the score is above 0; a tie, as of a text without telling words, is
    0. All settings are scored in one pass, which is written once."""
    split = stable_split(data.select(id_col, text_col, label_col), id_col, seed)
    weights = naive_bayes_weights(split.filter(F.col("split") == "train"), text_col, label_col, settings)
    judged = split.filter(F.col("split").isin("validation", eval_split))
    scored, path = naive_bayes_scores(judged, weights, id_col, text_col, len(settings)), shared_dir(data.sparkSession, "scores")
    scored.write.mode("overwrite").parquet(path)
    scored = data.sparkSession.read.parquet(path)
    positive, valid = F.col(label_col) == 1, scored.filter((F.col("split") == "validation") & F.col(label_col).isNotNull())
    f1 = []
    for k in range(len(settings)):
        said = F.col("scores")[k] > 0
        f1.append(F.try_divide(2 * F.count_if(positive & said), F.count_if(positive) + F.count_if(said)).alias(f"f{k}"))
    reached = [x or 0.0 for x in valid.agg(*f1).first()]  # one row
    best = reached.index(max(reached))
    score = F.col("scores")[best]
    return (scored.filter(F.col("split") == eval_split)
            .select(id_col, label_col, score.alias("score"), argmax_prediction(F.lit(0), score).alias("prediction")))


def classifier_table(data: DataFrame, predictions: DataFrame, label_col: str = "label") -> DataFrame:
    """JOB15's report as (section, item, value): class counts, confusion
    matrix and metrics."""
    counts = class_counts(data, label_col).select(
        F.lit("class").alias("section"), F.col(label_col).cast("string").alias("item"), F.col("count").cast("double").alias("value"))
    cells = confusion_matrix(predictions, label_col).select(
        F.lit("confusion"), F.concat(F.col("label").cast("string"), F.lit(" as "), F.col("prediction").cast("string")),
        F.col("count").cast("double"))
    names = ["accuracy", "precision", "recall", "f1"]
    metrics = binary_metrics(predictions, label_col).select(F.explode(F.array(
        *[F.struct(F.lit(n).alias("item"), F.round(n, 6).alias("value")) for n in names])).alias("m"))
    return counts.union(cells).union(metrics.select(F.lit("metric"), "m.item", "m.value"))


# Words in any script: Java's \\W is ASCII without the flag.
TOKEN_GAPS = r"(?U)\W+"


def text_classifier(text_col: str = "song_lyrics", label_col: str = "label",
                    num_features: int = 1 << 18, model: str = "naive_bayes",
                    max_iter: int = 20, reg_param: float = 0.0, smoothing: float = 1.0,
                    weight_col: str | None = None):
    """ML6: tokens -> hashed term counts -> classifier.

    ``model="naive_bayes"``: multinomial naive Bayes on raw term counts,
    trained in one aggregation pass.
    ``model="logistic"``: IDF weighting, then ``max_iter`` distributed
    L-BFGS iterations of logistic regression.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    weight = {"weightCol": weight_col} if weight_col else {}
    tokens = RegexTokenizer(inputCol=text_col, outputCol="__tokens", pattern=TOKEN_GAPS, toLowercase=True)
    if model == "naive_bayes":
        return Pipeline(stages=[
            tokens,
            HashingTF(inputCol="__tokens", outputCol="features", numFeatures=num_features),
            NaiveBayes(featuresCol="features", labelCol=label_col, modelType="multinomial", smoothing=smoothing, **weight),
        ])
    if model == "logistic":
        return Pipeline(stages=[
            tokens,
            HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features),
            IDF(inputCol="__tf", outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                               regParam=reg_param, **weight),
        ])
    raise ValueError("model must be 'naive_bayes' or 'logistic'")


# Settings compared on the validation split, by model.
CANDIDATES = {
    "naive_bayes": ({"smoothing": 1.0}, {"smoothing": 0.1}),
    "logistic": ({"reg_param": 0.0}, {"reg_param": 0.01}),
}


def train_and_evaluate(df: DataFrame, text_col: str = "song_lyrics", label_col: str = "label",
                       id_col: str | None = None, seed: int = S.SPLIT_SEED, balance: bool = True,
                       eval_split: str = "test", model: str = "naive_bayes",
                       model_dir: str | None = None,
                       candidates: Sequence[dict] | None = None) -> tuple[object, DataFrame, DataFrame]:
    """JOB15 end to end: split, weigh the classes of the training split
    equally, fit each candidate setting, keep the one with the best F1 on the
    validation split, predict on ``eval_split``; returns ``(model,
    predictions, metrics)``.

    Rows without a label take no part in the training; empty and NULL texts
    have no tokens. The predictions are written once (in the shared folder)
    and read from there. With ``model_dir`` the fitted pipeline is stored
    there and the stored copy is used. A logistic model is always stored (in
    the shared folder when no ``model_dir`` is given): its training summary
    holds a session reference that cannot be shipped to executors once the
    session has served an ``Observation``, and the stored copy has no summary.
    """
    from pyspark.ml import PipelineModel
    spark = df.sparkSession
    id_col = id_col or text_col
    keep = list(dict.fromkeys([id_col, text_col, label_col]))
    data = stable_split(df.select(*keep), id_col, seed).withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    train = data.filter((F.col("split") == "train") & F.col(label_col).isNotNull()).drop("split")
    weight_col = None
    if balance:
        sizes = class_sizes(train, label_col)
        if sizes:
            weight_col, most = "__weight", max(sizes.values())
            weights = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, most / n)])
            train = train.withColumn(weight_col, weights[F.col(label_col)])
    # Every training pass reads these rows: rebalance them into partitions
    # sized by bytes (AQE) and keep them (spillable).
    train = train.hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)

    def predict(fitted, split: str) -> DataFrame:
        return (fitted.transform(data.filter(F.col("split") == split).drop("split"))
                      .select(*keep, F.col("prediction").cast("int").alias("prediction")))

    def score(fitted) -> float:
        return binary_metrics(predict(fitted, "validation").drop(text_col) if id_col != text_col
                              else predict(fitted, "validation"), label_col, "prediction").first()["f1"]

    def fit(setting: dict):
        fitted = text_classifier(text_col, label_col, model=model, weight_col=weight_col, **setting).fit(train)
        if model == "logistic":
            path = shared_dir(spark, "models")
            fitted.write().overwrite().save(path)
            fitted = PipelineModel.load(path)
        return fitted

    try:
        tried = [fit(s) for s in (candidates or CANDIDATES[model])]
    finally:
        train.unpersist()
    scores = [score(m) for m in tried] if len(tried) > 1 else [0.0]
    chosen = tried[scores.index(max(scores))]
    if model_dir:
        chosen.write().overwrite().save(model_dir)
        chosen = PipelineModel.load(model_dir)
    path = shared_dir(spark, "predictions")
    out = predict(chosen, eval_split)
    out.write.mode("overwrite").parquet(path)
    preds = spark.read.schema(out.schema).parquet(path)
    return chosen, preds, binary_metrics(preds, label_col, "prediction")
