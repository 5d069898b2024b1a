"""Toxicity by a classifier chain over the words and word beginnings of a text.

Categories are predicted one after another. Each link is a logistic model of
the features a text has and of the probabilities that earlier links gave it. A
later link is trained with out-of-fold probabilities, so it meets earlier
links as uncertain as they will be on new texts. The cut of the last link is
calibrated on all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import fresh, quoted, ship, smallest_by_hash, store
from tunelake.llm.quality import SCORE_BINS, pick_cut

# Seed words that tell which kind of toxicity a toxic row has; a
# toxic row without any is coded, in words that only the labels reveal.
CATEGORIES = {
    "insult": ("clown", "fool", "idiot", "jerk", "loser", "moron", "scum"),
    "contempt": ("disgusting", "garbage", "pathetic", "stupid", "trash", "ugly", "worthless"),
}
CODED = "coded"
LAST = "toxic"
LINKS = (*CATEGORIES, CODED, LAST)
# Lengths, in bytes, of the word beginnings that are features.
STEMS = (3, 4, 5, 6, 7, 8)

_CASE = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: lower case for A-Z, a space for every other ASCII character but digits
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in _CASE)


def words_of(data: bytes) -> set[bytes]:
    """The different words of a text in UTF-8: A-Z in lower case, ASCII punctuation and white space between."""
    return set(data.translate(_PLAIN).split())


def features_of(data: bytes) -> set[bytes]:
    """The words, and the beginnings of longer words behind a ``^``."""
    words = words_of(data)
    stems = [{b"^" + w[:k] for w in words if len(w) > k} for k in STEMS]
    return words.union(*stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic model, classes weighed
    equally (accelerated gradient steps from zero)."""
    n, x = len(y), x.astype(np.float32)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    x1 = np.concatenate([x, np.ones((n, 1), x.dtype)], axis=1)
    share = share.astype(np.float32)
    penalty = np.append(np.full(x.shape[1], ridge), 0.0)
    v = np.ones(x1.shape[1], np.float32)
    for _ in range(20):  # largest curvature, by power iteration
        v = x1.T @ (share * (x1 @ v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.3 * float(v @ (x1.T @ (share * (x1 @ v)))) + ridge)
    w = z = np.zeros(x1.shape[1], np.float32)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ z, -30, 30)))
        new = (z - step * (x1.T @ (share * (p - y)).astype(np.float32) + penalty * z)).astype(np.float32)
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = (new + (was - 1) / t * (new - w)).astype(np.float32), new
    return w[:-1].astype(np.float64), float(w[-1])


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """One row of ``weights`` per link: the vocabulary's, then one for each
    earlier link's probability."""

    names: list[str]
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    bias: np.ndarray
    cut: float = 2.0

    @classmethod
    def fit(cls, names: list[str], vocabulary: list[bytes], present: list[np.ndarray], y: np.ndarray, fold: np.ndarray, *,
            ridge: float = 1e-4, steps: int = 200) -> Chain:
        """present: numbers of the features of each training text; y: one 0/1
        column per link; fold: 0, 1, ..."""
        size = len(vocabulary)
        x = np.zeros((len(present), size + len(names) - 1), np.float32)
        for i, numbers in enumerate(present):
            x[i, numbers] = 1
        weights, bias = np.zeros((len(names), x.shape[1])), np.zeros(len(names))
        for k in range(len(names)):
            used = x[:, :size + k]
            w, bias[k] = fit_logistic(used, y[:, k], ridge, steps)
            weights[k, :len(w)] = w
            if k + 1 < len(names):
                for f in np.unique(fold):
                    out = fold == f
                    wf, bf = (w, bias[k]) if out.all() else fit_logistic(used[~out], y[~out, k], ridge, steps)
                    x[out, size + k] = _probability(used[out] @ wf + bf)
        return cls(names, {w: i for i, w in enumerate(vocabulary)}, weights, bias)

    def predict(self, texts: Iterable[bytes], n: int) -> np.ndarray:
        """Probabilities, a row per text and a column per link."""
        size = len(self.vocabulary)
        out = np.zeros((n, len(self.names)))
        get = self.vocabulary.get
        for i, data in enumerate(texts):
            mine = sorted(k for w in features_of(data) if (k := get(w)) is not None)
            z = self.weights[:, mine].sum(axis=1) + self.bias
            for k in range(len(self.names)):
                out[i, k] = _probability(z[k] + self.weights[k, size:size + k] @ out[i, :k])
        return out


def _features(texts: pa.Array) -> pa.Array:
    """One text's features at a time, so that a batch holds Arrow data only."""
    rows = [pa.array(sorted(features_of(t.as_py() or b"")), pa.binary()) for t in texts]
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([pa.array([], pa.binary()), *rows]))


def _encoder(shared):
    seeds = [{w.encode() for w in ws} for ws in CATEGORIES.values()]

    def encode(texts: pa.Array) -> pa.Array:
        get, present, seen = shared.value.get, [], []
        for t in texts:
            found = features_of(t.as_py() or b"")
            present.append(sorted(k for w in found if (k := get(w)) is not None))
            seen.append([not found.isdisjoint(s) for s in seeds])
        return pa.StructArray.from_arrays([pa.array(present, pa.list_(pa.int32())), pa.array(seen, pa.list_(pa.bool_()))], ["present", "seeds"])

    return F.arrow_udf(encode, "struct<present: array<int>, seeds: array<boolean>>")


def choose_features(texts: DataFrame, least_rows: int, least_chi2: float, most: int) -> list[bytes]:
    """Features most unevenly spread over the classes of a stored table (text
    binary, toxic), by the chi-squared statistic; ties by name."""
    n, pos = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = (texts.select("toxic", F.explode(F.arrow_udf(_features, "array<binary>")("text")).alias("feature"))
              .groupBy("feature").agg(F.count(F.lit(1)).alias("c"), F.sum("toxic").alias("hit")))
    share = F.col("c") / n
    gap = F.col("hit") / max(1, pos) - (F.col("c") - F.col("hit")) / max(1, n - pos)
    chi2 = gap * gap * (pos * (n - pos) / max(1, n)) / (share * (1 - share) + 1e-9)
    best = counts.filter(F.col("c") >= least_rows).select("feature", chi2.alias("chi2")).filter(F.col("chi2") >= least_chi2)
    return sorted(bytes(r[0]) for r in best.orderBy(F.desc("chi2"), "feature").limit(most).collect())


def train_chain(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 2000,
                folds: int = 3, least_rows: int = 4, least_chi2: float = 12.0, most_words: int = 800, seed: int = 7) -> Chain | None:
    """A chain fitted on at most ``fit_rows`` toxic and as many other labelled
    rows of ``docs`` (those with the smallest hash of their id), whole texts,
    exact copies once. None where a class has no row. The driver receives
    ``most_words`` features and, per training row, the numbers of its own."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("binary").alias("text")).filter("doc_id is not null")
    known = store(_known(labels).join(rows.select("doc_id"), "doc_id", "left_semi"), "known")
    picked = smallest_by_hash(known.filter("toxic = 1"), seed, "doc_id", fit_rows).unionByName(
        smallest_by_hash(known.filter("toxic = 0"), seed, "doc_id", fit_rows))
    picked = store(picked, "fit-rows")  # at most 2 * fit_rows ids
    texts = rows.join(F.broadcast(picked), "doc_id").select("toxic", F.xxhash64("text").alias("h"), "text")
    texts = store(texts.dropDuplicates(["h", "toxic"]), "fit-texts")
    if texts.select("toxic").distinct().count() < 2:
        return None
    vocabulary = choose_features(texts, least_rows, least_chi2, most_words)
    shared = spark.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})
    data = sorted(texts.select("h", "toxic", _encoder(shared)("text").alias("f")).select("h", "toxic", "f.*").collect())
    toxic = np.array([r["toxic"] for r in data], np.float64)
    has = np.array([r["seeds"] for r in data], np.float64) * toxic[:, None]
    y = np.column_stack([has, toxic * (has.sum(axis=1) == 0), toxic])
    return Chain.fit(list(LINKS), vocabulary, [np.array(r["present"], np.int64) for r in data], y,
                     np.array([r["h"] % folds for r in data]))


def _known(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
            .agg(F.max("toxic").cast("int").alias("toxic")))


def _predict(shared, names: list[str]) -> Column:
    def predict(texts: pa.Array) -> pa.Array:
        table = np.round(shared.value.predict((t.as_py() or b"" for t in texts), len(texts)), 6)
        return pa.StructArray.from_arrays([pa.array(c) for c in table.T], names)

    return F.arrow_udf(predict, "struct<" + ",".join(f"{n}: double" for n in names) + ">")


def with_probabilities(docs: DataFrame, chain: Chain, name: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct of one probability per link (null text: empty)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    return docs.withColumn(name, _predict(shared, chain.names)(quoted(text_col).cast("binary")))


def calibrate(scored: DataFrame, labels: DataFrame, *, id_col: str, name: str, clean_weight: float = 20.0) -> float:
    """The cut over all labelled rows of a stored table of probabilities."""
    rows = scored.select(quoted(id_col).alias("doc_id"), F.round(quoted(name)[LAST] * SCORE_BINS).cast("int").alias("bin"))
    bins = rows.join(_known(labels), "doc_id").groupBy("toxic", "bin").count().collect()  # at most two rows per bin
    return pick_cut({(1 - t, b): n for t, b, n in bins}, clean_weight)


def toxicity_verdicts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_all: bool = False,
                      name: str = "p", verdict: str = "toxic", **options) -> DataFrame:
    """Per row of ``docs``: id (``keep_all``: all columns), struct ``name`` of
    probabilities and boolean ``verdict``.

    Null text has no words. A row is judged by its text alone, so null and
    repeated ids are no matter. Of several labels of an id the toxic one
    counts; null or other labels are left out. Where no chain can be trained
    nothing is toxic and the probabilities are null.
    """
    rows = docs if keep_all else docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias(text_col))
    chain = train_chain(docs, labels, id_col=id_col, text_col=text_col, **options)
    if chain is None:
        none = F.struct(*[F.lit(None).cast("double").alias(n) for n in LINKS])
        out = rows.withColumn(name, none).withColumn(verdict, F.lit(False))
        return out if keep_all else out.drop(text_col)
    scored = with_probabilities(rows, chain, name, text_col=text_col)
    scored = store(scored if keep_all else scored.drop(text_col), "toxicity")
    cut = calibrate(scored, labels, id_col=id_col, name=name)
    return scored.withColumn(verdict, quoted(name)[LAST] > cut)


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns."""
    p, toxic = fresh(docs.columns, "p"), fresh(docs.columns, "toxic")
    out = toxicity_verdicts(docs, labels, keep_all=True, name=p, verdict=toxic, **options)
    return out.filter(~quoted(toxic)).select(*map(quoted, docs.columns))
