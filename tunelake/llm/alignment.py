"""Alignment of the tokens that two tokenizers make of the same text.

Every token covers a range of the text's bytes, so the running sums of token
lengths are the places where tokens end. Both tokenizers' ends go into
dictionaries from end to token index; the keys that both hold, sorted, cut the
two id lists into groups, and the two tokens that end at a cut are a link.

Links are counted over the corpus and every document is judged by the counts
of its links. Most links of any text are of few pairs of ids: the counts of the
most frequent pairs (at most ``HEAD_PAIRS``, whatever the corpus) are broadcast,
the rest meets the documents by a join. A pair of the rest is rare by
definition, so that join has no hot key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm import bpe
from tunelake.llm.common import fresh, most_frequent, quoted, ship, store

# Tokens of the first tokenizer whose ends are in a dictionary at a time.
BLOCK_TOKENS = 1 << 16

# Pairs of ids whose counts are broadcast, at most (17 bytes each).
HEAD_PAIRS = 200_000

# Bytes of results that a task gathers before it hands them on.
BATCH_BYTES = 4_000_000


class PlainEncoder(bpe.LibraryEncoder):
    """Ids of a byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, spec: str):
        super().__init__(spec)
        self.special = set()
        self.whole.encode_special_tokens = True


def byte_level_tokens(spec: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file."""
    data, symbol = json.loads(spec), bpe.byte_symbols()
    tokens = {i: bytes(symbol[c] for c in t) for t, i in data["model"]["vocab"].items() if all(c in symbol for c in t)}
    tokens |= {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of every id of a sentencepiece model."""
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


class TokenBytes:
    """The bytes of every id, and whether a sequence of ids spells a text."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array(list(map(len, tokens)), np.int64)
        self.begins = self.sizes.cumsum() - self.sizes
        self.all = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray, text: bytes) -> bool:
        want, at = np.frombuffer(text, np.uint8), 0
        if self.sizes[ids].sum() != len(want):
            return False
        for lo in range(0, len(ids), BLOCK_TOKENS):
            part = ids[lo:lo + BLOCK_TOKENS]
            sizes = self.sizes[part]
            ends = sizes.cumsum()
            place = np.arange(ends[-1]) + np.repeat(self.begins[part] - ends + sizes, sizes)
            if not np.array_equal(self.all[place], want[at:at + ends[-1]]):
                return False
            at += ends[-1]
        return True


class Aligner:
    """Two tokenizers, given as the text of a byte-level BPE file and the bytes
    of a sentencepiece model."""

    def __init__(self, spec_a: str, model_b: bytes):
        self.encode_a = PlainEncoder(spec_a).encode
        self.encode_b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        tokens_a, tokens_b = byte_level_tokens(spec_a), piece_tokens(self.encode_b)
        self.bytes_a, self.bytes_b, self.n_b = TokenBytes(tokens_a), TokenBytes(tokens_b), len(tokens_b)
        self.names = [str(i) for i in range(max(len(tokens_a), len(tokens_b)))]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both for a space and ``text``; none where the text is null or
        empty or where either's tokens do not spell it."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = b" " + text.encode()
        a = self.encode_a(" " + text).astype(np.int64)
        b = np.array(self.encode_b.encode(text, num_threads=1), np.int64)
        return (a, b) if self.bytes_a.spell(a, whole) and self.bytes_b.spell(b, whole) else (none, none)

    def cuts(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of the tokens of both that end at the common ends, in order,
        block by block."""
        ends_a, ends_b, from_b = self.bytes_a.sizes[a].cumsum(), self.bytes_b.sizes[b].cumsum(), 0
        for lo in range(0, len(a), BLOCK_TOKENS):
            part_a = ends_a[lo:lo + BLOCK_TOKENS]
            upto_b = int(np.searchsorted(ends_b, part_a[-1], "right"))
            at_a = dict(zip(part_a.tolist(), range(lo, lo + len(part_a))))
            at_b = dict(zip(ends_b[from_b:upto_b].tolist(), range(from_b, upto_b)))
            common = sorted(at_a.keys() & at_b.keys())
            yield tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b))
            from_b = upto_b

    def align(self, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """(tokens of a, of b, groups, the groups as ``a1,a2|b1;a3|b2,b3``,
        distinct linked pairs as a * size of b + b, how often each)."""
        a, b = self.tokens(text)
        cuts = list(self.cuts(a, b))
        cut_a, cut_b = (np.concatenate([c[k] for c in cuts] or [a]) for k in (0, 1))
        pairs, of, times = np.unique(a[cut_a] * self.n_b + b[cut_b], return_inverse=True, return_counts=True)
        # a group is written as its last tokens, unless it has more
        written = [f"{x}|{y}" for x, y in zip((pairs // self.n_b).tolist(), (pairs % self.n_b).tolist())]
        groups = list(map(written.__getitem__, of.tolist()))
        first_a, first_b = (np.concatenate(([0], c[:-1] + 1)) if len(c) else c for c in (cut_a, cut_b))
        more = np.flatnonzero((first_a < cut_a) | (first_b < cut_b))
        name, ids_a, ids_b = self.names.__getitem__, a.tolist(), b.tolist()
        places = (x[more].tolist() for x in (first_a, cut_a + 1, first_b, cut_b + 1))
        for k, i, j, x, y in zip(more.tolist(), *places):
            groups[k] = ",".join(map(name, ids_a[i:j])) + "|" + ",".join(map(name, ids_b[x:y]))
        return len(a), len(b), len(groups), ";".join(groups), pairs, times


@lru_cache(maxsize=2)
def aligner(spec_a: str, model_b: bytes) -> Aligner:
    """One aligner per pair of vocabularies and process."""
    return Aligner(spec_a, model_b)


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>"


def _align(shared):
    def table(rows: list[tuple]) -> pa.RecordBatch:
        row, doc, n_a, n_b, n_groups, groups, pairs, times = zip(*rows)
        offsets = pa.array(list(accumulate(map(len, pairs), initial=0)), pa.int32())
        arrays = [pa.array(c, pa.int64()) for c in (row, doc, n_a, n_b, n_groups)] + [pa.array(groups, pa.string())]
        arrays += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v).astype(kind))) for v, kind in ((pairs, "i8"), (times, "i4"))]
        return pa.record_batch(arrays, names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, rows, held = aligner(*shared.value).align, [], 0
        for batch in batches:
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                rows.append((row, doc, *align(text.as_py())))
                held += len(rows[-1][5]) + 12 * len(rows[-1][6]) + 100
                if held >= BATCH_BYTES:
                    yield table(rows)
                    rows, held = [], 0
        if rows:
            yield table(rows)

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's alignment: row (a number of its own), doc_id, n_a,
    n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``, decimal ids in order), pairs
    (distinct linked id pairs, a * size of b's vocabulary + b) and times.

    ``path_a`` is a byte-level BPE file, which gets a space before the text;
    ``path_b`` a sentencepiece model, which adds that space itself. A document
    whose text is null or empty, or whose tokens do not spell the text, has
    zeros, no groups and no pairs. Texts are taken whole; a long one's ends are
    in dictionaries a block of tokens at a time. Repeated rows and null ids are
    documents like any other, other columns are not read, no documents give no
    rows."""
    ship(docs.sparkSession)
    with open(path_b, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((bpe.read_spec(path_a), f.read()))
    return (docs.select(F.monotonically_increasing_id().alias("row"), quoted(id_col).cast("long"), quoted(text_col))
            .mapInArrow(_align(shared), ALIGNED))


def vocabulary_size(path_b: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


def link_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, n (links of the corpus that hold it) and best: is n the highest
    of all pairs with this b, ties included."""
    counts = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
              .agg(F.sum("x.times").alias("n")).withColumn("b", F.col("pair") % n_b))
    counts = store(counts, "link_counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head_sums(shared):
    def sums(pairs: pa.Array, times: pa.Array) -> pa.Array:
        head, n, best = shared.value
        offsets = pairs.offsets.to_numpy()
        of = np.repeat(np.arange(len(pairs)), np.diff(offsets))
        p, t = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        at = np.minimum(np.searchsorted(head, p), max(0, len(head) - 1))
        known = head[at] == p if len(head) else np.zeros(len(p), bool)
        count_sum, n_best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        np.add.at(count_sum, of[known], t[known] * n[at[known]])
        np.add.at(n_best, of[known], t[known] * best[at[known]])
        rest = np.concatenate(([0], np.bincount(of[~known], minlength=len(pairs)).cumsum())).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(rest), pa.array(v[~known])) for v in (p, t.astype(np.int32))]
        return pa.StructArray.from_arrays([pa.array(n_best), pa.array(count_sum), *lists], ["n_best", "count_sum", "pairs", "times"])

    return F.arrow_udf(sums, "struct<n_best: long, count_sum: long, pairs: array<long>, times: array<int>>")


def link_scores(aligned: DataFrame, n_b: int) -> DataFrame:
    """``aligned`` (a stored table with ``row``, ``pairs`` and ``times``) with
    n_links, n_best (links whose count is their b's highest) and count_sum
    (counts summed over the links) instead of the pairs."""
    spark = aligned.sparkSession
    links = store(link_counts(aligned, n_b), "links")
    head = most_frequent(links, "n", HEAD_PAIRS).toArrow().sort_by("pair")  # at most HEAD_PAIRS rows
    shared = spark.sparkContext.broadcast(tuple(head[c].to_numpy() for c in ("pair", "n", "best")))
    told = fresh(aligned.columns, "told")
    scored = store(aligned.select(*[quoted(c) for c in aligned.columns if c not in ("pairs", "times")],
                                  F.aggregate("times", F.lit(0).cast("long"), lambda s, x: s + x).alias("n_links"),
                                  _head_sums(shared)("pairs", "times").alias(told)), "link_scores")
    rest = (scored.select("row", F.explode(F.arrays_zip(f"{told}.pairs", f"{told}.times")).alias("x"))
            .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("k"))
            .join(links, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("rest_best"), F.sum(F.col("k") * F.col("n")).alias("rest_sum")))
    zero = F.lit(0)
    return scored.join(rest, "row", "left").select(
        *[c for c in scored.columns if c != told], (F.col(f"{told}.n_best") + F.coalesce("rest_best", zero)).alias("n_best"),
        (F.col(f"{told}.count_sum") + F.coalesce("rest_sum", zero)).alias("count_sum"))
