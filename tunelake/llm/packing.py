"""Packing token sequences by shortest-pack-first over their length histogram.

Documents are cut into pieces of at most ``size`` tokens: whole pieces first,
then the rest. Only the histogram of piece lengths (at most ``size`` numbers)
reaches the driver. There the lengths are placed longest first, each into the
packs that are shortest so far and still have room, a whole count at a time,
which gives a short list of packing patterns with counts. The n-th piece of a
length then finds its place by its rank: ranks are dealt out by buckets of
pieces, so that no length, however common, is numbered in one task.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import bpe
from tunelake.llm.common import quoted, ship, store

# Pieces that one task numbers, about; the number of buckets follows the data.
BUCKET_ROWS = 5_000


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, count) of packs that hold ``histogram[length]`` pieces of
    every length, longest first within a pattern."""
    # open packs by room left; of equal patterns one entry, so whole counts move at once
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []  # negative, for the largest room first

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        if count and not open_[room]:
            heapq.heappush(rooms, -room)
        if count:
            open_[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            pattern, count = open_[room].pop()
            if not open_[room]:
                heapq.heappop(rooms)
            take = min(left, count)
            put(room, pattern, count - take)
            put(room - length, pattern + (length,), take)
            left -= take
        # none has room: a new pack takes pieces until it is full
        each = size // length
        put(size - each * length, (length,) * each, left // each)
        put(size - left % each * length, (length,) * (left % each), min(1, left % each))
    return [entry for room in sorted(open_) for entry in open_[room]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length, in order of rank: (first rank, ranks, first sequence,
    offset, how many of the length the pattern holds before)."""
    places: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            places[length].append((used[length], count, sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return places


def place_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` (a stored table with ``length`` from 1 to size) plus
    ``sequence_id`` and ``offset``. Sequences are gapless from 0 and hold at
    most ``size`` tokens. Equal pieces are interchangeable. Input columns of
    those names are replaced."""
    ship(pieces.sparkSession)
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    histogram = dict(pieces.groupBy("length").count().collect())  # at most `size` rows
    places = slots(shortest_pack_first(histogram, size))
    buckets = max(1, sum(histogram.values()) // BUCKET_ROWS)
    rows = pieces.select(F.struct(*map(quoted, columns)).alias("piece"), F.col("length").alias("len"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(buckets)))
    counts = rows.groupBy("len", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("len").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("len", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("len", "bucket").orderBy(F.xxhash64("piece"))
    ranked = (rows.withColumn("nth", F.row_number().over(inside) - 1).join(counts, ["len", "bucket"])
              .select("piece", "len", (F.col("first") + F.col("nth")).alias("rank")))
    # the place of a rank: binary search in the places of its length
    starts = {n: (np.array([p[0] for p in v]), np.array([p[2] for p in v]), np.array([p[3] for p in v])) for n, v in places.items()}
    shared = pieces.sparkSession.sparkContext.broadcast(starts)

    def find(lens: pa.Array, ranks: pa.Array) -> pa.Array:
        lens, ranks = lens.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        seq, off = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
        for n in np.unique(lens):
            mine = lens == n
            first, sequence, offset = shared.value[int(n)]
            k = np.searchsorted(first, ranks[mine], "right") - 1
            seq[mine] = sequence[k] + ranks[mine] - first[k]
            off[mine] = offset[k]
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(off)], ["sequence_id", "offset"])

    found = F.arrow_udf(find, "struct<sequence_id: long, offset: long>")(F.col("len").cast("long"), F.col("rank").cast("long"))
    return ranked.withColumn("at", found).select("piece.*", "at.sequence_id", "at.offset")


def cut(lengths: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of that many tokens."""
    return [(a, min(size, lengths - a)) for a in range(0, lengths, size)]


def _cutter(shared, size: int, end_id: int):
    last = np.array([end_id], "<u4")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = bpe.library(shared.value).encode
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate((code(text.as_py() or ""), last))
                rows += [(doc, a, n, zlib.crc32(ids[a:a + n].tobytes()), len(ids)) for a, n in cut(len(ids), size)]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                  names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return pieces


def token_pieces(docs: DataFrame, tokenizer_path: str, *, size: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of the encoded documents, ``end_id`` after each: doc_id, start,
    length, ids_crc32, doc_tokens. Null text counts as empty (one piece of one
    id). A null id stays null; repeated rows each give their pieces."""
    shared = bpe.share(docs.sparkSession, tokenizer_path)
    return docs.select(quoted(id_col).cast("long"), quoted(text_col)).mapInArrow(
        _cutter(shared, size, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, size: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Where every piece of every document goes: the columns of
    ``token_pieces`` plus sequence_id and offset. No documents, no rows."""
    pieces = token_pieces(docs, tokenizer_path, size=size, end_id=end_id, id_col=id_col, text_col=text_col)
    return place_pieces(store(pieces, "pieces"), size)
