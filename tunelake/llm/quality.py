"""Quality rules judged by an isolation forest.

Every text gets rule statistics (counts and shares of words, symbols,
capitals, repeated lines and windows) in one pass. Trees of random splits are
grown over small random subsets of labelled rows; a text that few splits
isolate is anomalous. How anomalous a text may be is calibrated on all
labelled rows, through a histogram of their scores.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import fresh, quoted, ship, smallest_by_hash, store

# Characters counted as symbols, and base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# What ordinary prose may have; the statistics measure the excess.
CAPITAL_SHARE = 0.3
DUP_LINE_SHARE = 0.5
WORD_LENGTH = (3.0, 10.0)

CAPITALS = bytes(range(0x41, 0x5B))
LETTERS = CAPITALS + bytes(range(0x61, 0x7B))
CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters", "n_marks")
STATISTICS = ("symbol_share", "mark_share", "capital_excess", "dup_line_excess", "word_length_excess")

SCORE_BINS = 1000


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def rule_counts(data: bytes) -> tuple[int, ...]:
    """COUNTS of a text in UTF-8. Words are runs of other than ASCII white space."""
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            again = np.fromiter((seen[w] > 1 for w in windows), bool, n - 2)
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k:n - 2 + k] |= again
            repeated = int(covered.sum())
    return (n, sum(map(len, words)) - _without(data, CONTINUATION), _without(data, SYMBOLS), len(lines) - len(set(lines)),
            repeated, len(lines), _without(data, CAPITALS), _without(data, LETTERS), data.count(b"!"))


def _counts(texts: pa.Array) -> pa.Array:
    rows = [rule_counts(t.as_py() or b"") for t in texts]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(COUNTS))], list(COUNTS))


def with_rule_counts(docs: DataFrame, name: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct of COUNTS over the whole text (null: empty)."""
    ship(docs.sparkSession)
    schema = "struct<" + ",".join(f"{c}: long" for c in COUNTS) + ">"
    return docs.withColumn(name, F.arrow_udf(_counts, schema)(quoted(text_col).cast("binary")))


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def statistics(c: np.ndarray) -> np.ndarray:
    """Rows of COUNTS to rows of STATISTICS. Ordinary variation is zero in
    all of them, so that splits go where a rule is broken."""
    n_words, word_chars, symbols, dup, _, lines, capitals, letters, marks = c.T.astype(np.float64)
    length = word_chars / np.maximum(n_words, 1)
    low, high = WORD_LENGTH
    return np.stack([symbols / np.maximum(word_chars, 1), marks / np.maximum(n_words, 1),
                     np.maximum(capitals / np.maximum(letters, 1) - CAPITAL_SHARE, 0),
                     np.maximum(dup / np.maximum(lines, 1) - DUP_LINE_SHARE, 0),
                     np.maximum(low - length, 0) + np.maximum(length - high, 0)], axis=1)


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random binary tree of n rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


@dataclass
class IsolationForest:
    """Nodes of all trees in arrays: split column (-1 at a leaf), cut, left
    child (the right one follows it), depth plus average path at a leaf."""

    roots: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    length: np.ndarray
    subset: int

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int, subset: int, seed: int) -> IsolationForest:
        rng = np.random.default_rng(seed)
        subset = min(subset, len(rows))
        deepest = int(np.ceil(np.log2(max(2, subset))))
        nodes: list[list[float]] = []
        roots = []
        for _ in range(trees):
            roots.append(len(nodes))
            nodes.append([-1, 0, 0, 0])
            todo = [(roots[-1], rng.choice(len(rows), subset, replace=False), 0)]
            while todo:
                at, mine, depth = todo.pop()
                low, high = rows[mine].min(axis=0), rows[mine].max(axis=0)
                varying = np.flatnonzero(low < high)
                if depth == deepest or not len(varying):
                    nodes[at] = [-1, 0, 0, depth + float(_average_path(len(mine)))]
                    continue
                column = int(rng.choice(varying))
                cut = rng.uniform(low[column], high[column])
                left = rows[mine, column] <= cut
                nodes[at] = [column, cut, len(nodes), 0]
                todo += [(len(nodes), mine[left], depth + 1), (len(nodes) + 1, mine[~left], depth + 1)]
                nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
        table = np.array(nodes, np.float64).reshape(-1, 4)
        return cls(np.array(roots), table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3], subset)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** -(mean path / expected path)."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                column = self.column[at]
                inner = column >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(column, 0)] > self.cut[at]
                at = np.where(inner, self.child[at] + right, at)
            total += self.length[at]
        expected = max(float(_average_path(self.subset)), 1e-9)
        return 2.0 ** (-total / len(self.roots) / expected)


@dataclass
class RuleModel:
    """``forest`` None: nothing to learn from, only the base rules reject."""

    forest: IsolationForest | None
    cut: float


def pick_cut(histogram: dict[tuple[int, int], int], clean_weight: float) -> float:
    """Score above which a text goes. histogram: rows by (quality, score bin).

    Maximises the share of bad rows above minus ``clean_weight`` times the
    share of good rows above; of equal cuts, the middle of the widest run.
    """
    good, bad = (np.array([histogram.get((q, b), 0) for b in range(SCORE_BINS + 1)], float) for q in (1, 0))
    if not good.sum() or not bad.sum():
        return 2.0
    above = [x[::-1].cumsum()[::-1] / x.sum() for x in (good, bad)]
    gain = above[1] - clean_weight * above[0]
    if gain.max() <= 0:
        return 2.0
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    run = max(runs, key=len)
    return float((run[0] + run[-1]) / 2 / SCORE_BINS)


def _score(shared, counts: str = "counts") -> Column:
    def score(values: pa.Array) -> pa.Array:
        table = np.stack([c.to_numpy(zero_copy_only=False) for c in values.flatten()], axis=1)
        return pa.array(np.round(shared.value.score(statistics(table)), 6))

    return F.arrow_udf(score, "double")(quoted(counts))


def fit_rules(counted: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", counts_col: str = "counts", trees: int = 100,
              subset: int = 256, fit_rows: int = 20_000, seed: int = 5, clean_weight: float = 20.0) -> RuleModel:
    """A forest and its cut from a stored table of ids and counts and the
    labels (doc_id, quality: 1 good, 0 bad).

    The forest sees at most ``fit_rows`` labelled rows that pass the base
    rules, those with the smallest hash of their id; the cut is calibrated on
    all of them. Null ids and null or other labels are left out; of several
    labels of an id the lowest counts.
    """
    spark = counted.sparkSession
    labels = (labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
              .agg(F.min("quality").cast("int").alias("quality")))
    rows = counted.select(quoted(id_col).alias("doc_id"), quoted(counts_col).alias("counts"))
    known = rows.filter(~base_failed(F.col("counts"))).join(labels, "doc_id")
    sample = smallest_by_hash(known, seed, "doc_id", fit_rows).select("counts.*").collect()
    if not sample:
        return RuleModel(None, 2.0)
    forest = IsolationForest.grow(statistics(np.array(sample, np.int64)), trees, subset, seed)
    shared = spark.sparkContext.broadcast(forest)
    bins = (known.select("quality", F.round(_score(shared) * SCORE_BINS).cast("int").alias("bin"))
            .groupBy("quality", "bin").count().collect())  # at most two rows per bin
    return RuleModel(forest, pick_cut({(q, b): n for q, b, n in bins}, clean_weight))


def judge(counted: DataFrame, model: RuleModel, *, counts_col: str, score_col: str, kept_col: str) -> DataFrame:
    """``counted`` plus the anomaly score and whether the text is kept."""
    ship(counted.sparkSession)
    failed = base_failed(quoted(counts_col))
    if model.forest is None:
        return counted.withColumn(score_col, F.lit(None).cast("double")).withColumn(kept_col, ~failed)
    shared = counted.sparkSession.sparkContext.broadcast(model.forest)
    return (counted.withColumn(score_col, _score(shared, counts_col))
            .withColumn(kept_col, ~failed & (quoted(score_col) <= model.cut)))


def quality_verdicts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: id, counts, base_failed, anomaly, kept.

    Null text has no words and fails. A row is judged by its text alone, so
    null and repeated ids are no matter. Empty tables: no rows, or no forest.
    """
    rows = docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias("text"))
    counted = store(with_rule_counts(rows, "counts").drop("text"), "rule-counts")
    model = fit_rules(counted, labels, id_col=id_col, **options)
    out = judge(counted, model, counts_col="counts", score_col="anomaly", kept_col="kept")
    return out.withColumn("base_failed", base_failed(F.col("counts")))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. The texts are written
    once with their counts, since the model needs all counts first."""
    counts, score, kept = (fresh(docs.columns, n) for n in ("counts", "anomaly", "kept"))
    counted = store(with_rule_counts(docs, counts, text_col=text_col), "counted-texts")
    model = fit_rules(counted, labels, id_col=id_col, counts_col=counts, **options)
    out = judge(counted, model, counts_col=counts, score_col=score, kept_col=kept)
    return out.filter(quoted(kept)).select(*map(quoted, docs.columns))
