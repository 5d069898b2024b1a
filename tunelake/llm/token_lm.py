"""Cross-entropy difference of a target and a background bigram model over
the ids of one tokenizer.

Both models are Witten-Bell bigram models that back off to single tokens and
from there to the uniform distribution over one shared vocabulary: the token
ids that the corpus has, and the mark that opens and closes a text. The
background model counts every text, the target model those of the target rows.
A bigram is one exact integer. Counts cover whole texts and are a Spark table
that grows with the corpus; what depends on single tokens only (totals,
back-off) is bounded by the vocabulary and is broadcast.

A text's bigrams are written once, as distinct ones with counts. They meet
their losses in two ways: the most frequent bigrams of the corpus, at most
``HEAD_GRAMS`` at any size, are broadcast; the others, which are rare by
definition, are joined by the bigram. No bigram is left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm import bpe
from tunelake.llm.common import join_by_id, most_frequent, quoted, ship, store

# Bigrams whose losses are broadcast, at most (20 bytes each).
HEAD_GRAMS = 300_000

# Bigrams that a task gathers before it hands them on.
HELD_GRAMS = 500_000

# Bigrams that a task looks up at a time.
BLOCK_GRAMS = 1 << 18

# The largest vocabulary whose pairs fit 32 bits, the mark included.
MOST_TOKENS = 1 << 16

MODELS = ("target", "background")


@lru_cache(maxsize=4)
def vocabulary_size(spec: str) -> int:
    """Ids of the tokenizer file, and one more for the mark."""
    data = json.loads(spec)
    size = 2 + max([*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"])])
    if size > MOST_TOKENS:
        raise ValueError(f"a vocabulary of {size} tokens; pairs of ids must fit 32 bits")
    return size


def grams(ids: np.ndarray, size: int) -> np.ndarray:
    """Codes of the neighbouring pairs of a text's ids between two marks."""
    marked = np.concatenate(([size - 1], ids, [size - 1])).astype(np.int64)
    return (marked[:-1] * size + marked[1:] - (1 << 31)).astype(np.int32)


def _rows(shared, kind: pa.DataType):
    def table(rows: list[tuple]) -> pa.RecordBatch:
        row, doc, wanted, found, times = zip(*rows)
        offsets = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v).astype(np.int32))) for v in (found, times)]
        return pa.record_batch([pa.array(row, pa.int64()), pa.array(doc, kind), pa.array(wanted, pa.bool_()), *lists],
                               names=["row", "doc_id", "wanted", "grams", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size, rows, held = bpe.library(shared.value).encode, vocabulary_size(shared.value), [], 0
        for batch in batches:
            for row, doc, wanted, text in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                found, times = np.unique(grams(encode(text.as_py() or ""), size), return_counts=True)
                rows.append((row, doc, bool(wanted), found, times))
                held += len(found)
                if held >= HELD_GRAMS:
                    yield table(rows)
                    rows, held = [], 0
        if rows:
            yield table(rows)

    return run


def text_grams(docs: DataFrame, target_ids: DataFrame, tokenizer_path: str) -> DataFrame:
    """row, doc_id, wanted, grams (distinct bigram codes), times of every row
    of ``docs`` (doc_id, text)."""
    shared = bpe.share(docs.sparkSession, tokenizer_path)
    wanted = target_ids.select("doc_id").filter("doc_id is not null").distinct().withColumn("wanted", F.lit(True)).hint("shuffle_hash")
    field = docs.schema["doc_id"]
    kind = {"bigint": pa.int64(), "string": pa.string()}[field.dataType.simpleString()]
    marked = join_by_id(docs, wanted, "doc_id").select(F.monotonically_increasing_id().alias("row"), "doc_id", "wanted", "text")
    return marked.mapInArrow(_rows(shared, kind), f"row long, doc_id {field.dataType.simpleString()}, wanted boolean, "
                                                  "grams array<int>, times array<int>")


def gram_losses(found: DataFrame, size: int) -> DataFrame:
    """gram, n (times in the corpus), target_loss and background_loss (natural
    log) of every bigram in a stored table of ``text_grams``."""
    each = found.select("wanted", F.explode(F.arrays_zip("grams", "times")).alias("x"))
    times = F.col("x.times").cast("long")
    counts = each.groupBy(F.col("x.grams").alias("gram")).agg(
        F.sum(F.when(F.col("wanted"), times).otherwise(0)).alias("target"), F.sum(times).alias("background"))
    place = F.col("gram").cast("long") + F.lit(1 << 31)
    counts = store(counts.withColumns({"a": F.floor(place / size).cast("int"), "b": (place % size).cast("int")}), "bigrams")
    sums = [F.sum(m).alias(f"{m}_n") for m in MODELS] + [F.count_if(F.col(m) > 0).alias(f"{m}_kinds") for m in MODELS]
    # tables of at most `size` rows: a token each
    before = counts.groupBy("a").agg(*sums)
    single = store(counts.groupBy("b").agg(*[F.sum(m).alias(m) for m in MODELS]), "tokens")
    total = single.agg(*sums, F.count(F.lit(1)).alias("types")).first()

    def one(m: str):
        n, kinds, types = total[f"{m}_n"], total[f"{m}_kinds"], max(1, total["types"])
        return ((F.col(m) + F.lit(kinds / types)) / F.lit(n + kinds) if n else F.lit(1 / types)).alias(f"{m}_one")

    met = counts.join(F.broadcast(before), "a").join(F.broadcast(single.select("b", *map(one, MODELS))), "b")

    def loss(m: str):
        n, k, back = F.col(f"{m}_n"), F.col(f"{m}_kinds"), F.col(f"{m}_one")
        return (-F.log(F.when(n > 0, (F.col(m) + k * back) / (n + k)).otherwise(back))).alias(f"{m}_loss")

    return met.select("gram", F.col("background").alias("n"), *map(loss, MODELS))


def _head_sums(shared):
    def block(found: pa.Array, times: pa.Array) -> list:
        """Columns n, target, background, grams, times of some rows."""
        head, *losses = shared.value
        of = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
        g, t = found.flatten().to_numpy(), times.flatten().to_numpy()
        at = np.minimum(np.searchsorted(head, g), max(0, len(head) - 1))
        known = head[at] == g if len(head) else np.zeros(len(g), bool)
        out = [np.bincount(of[known], t[known] * x[at[known]], len(found)).astype(float) for x in losses]
        rest = np.concatenate(([0], np.bincount(of[~known], minlength=len(found)).cumsum())).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(rest), pa.array(v[~known])) for v in (g, t)]
        return [pa.array(np.bincount(of, t, len(found)).astype(np.int64)), *map(pa.array, out), *lists]

    def sums(found: pa.Array, times: pa.Array) -> pa.Array:
        # as many rows at a time as hold about BLOCK_GRAMS bigrams
        ends, blocks, lo = found.offsets.to_numpy(), [], 0
        while lo < len(found) or not blocks:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK_GRAMS, "right")) - 1) if len(found) else 0
            blocks.append(block(found.slice(lo, hi - lo), times.slice(lo, hi - lo)))
            lo = hi
        names = ["n", *MODELS, "grams", "times"]
        return pa.StructArray.from_arrays([pa.concat_arrays(c) for c in zip(*blocks)], names)

    return F.arrow_udf(sums, "struct<n: long, target: double, background: double, grams: array<int>, times: array<int>>")


def token_scores(docs: DataFrame, target_ids: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens (tokens and the closing mark), mean
    target_loss and background_loss per token, score (their difference).

    Null text counts as empty: its one token is the closing mark. Null ids are
    scored and are never target rows; repeated rows count as often as they
    come. Without target rows the target model is uniform. Texts of any length
    are taken whole; other columns are not read. Ids are long or string. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    found = store(text_grams(rows, target_ids, tokenizer_path), "text-grams")
    losses = store(gram_losses(found, vocabulary_size(bpe.read_spec(tokenizer_path))), "gram-losses")
    head = most_frequent(losses, "n", HEAD_GRAMS).toArrow().sort_by("gram")  # at most HEAD_GRAMS rows
    shared = spark.sparkContext.broadcast(tuple(head[c].to_numpy() for c in ("gram", "target_loss", "background_loss")))
    met = store(found.select("row", "doc_id", _head_sums(shared)("grams", "times").alias("met")), "head-sums")
    rest = (met.select("row", F.explode(F.arrays_zip("met.grams", "met.times")).alias("x"))
            .select("row", F.col("x.grams").alias("gram"), F.col("x.times").alias("k")).join(losses, "gram")
            .groupBy("row").agg(*[F.sum(F.col("k") * F.col(f"{m}_loss")).alias(f"rest_{m}") for m in MODELS]))
    summed = met.join(rest, "row", "left").select("doc_id", "met.n", *[
        (F.col(f"met.{m}") + F.coalesce(f"rest_{m}", F.lit(0.0))).alias(m) for m in MODELS])
    mean = [F.round(F.col(m) / F.col("n"), 9).alias(f"{m}_loss") for m in MODELS]
    return summed.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_tokens"), *mean,
                         F.round((F.col("target") - F.col("background")) / F.col("n"), 9).alias("score"))
