"""SimHash fingerprints, linked within a Hamming distance by pigeonring.

The 64 bits are cut into max_bits + 1 segments laid on a ring. If two
fingerprints differ in at most max_bits bits, then from some segment on, every
chain of 1, 2, ... consecutive segments stays within its proportional budget
floor(length * max_bits / segments): the first segment is equal, the first two
differ in at most floor(2 * max_bits / segments) bits, and so on round the
ring. So a fingerprint is dealt once per starting segment by that segment's
value; inside a deal, partners whose second segment is in budget are looked
up in a sorted index, longer chains prune them, and the full distance decides.

Equal fingerprints are one node, whatever the number of documents. A deal with
very many fingerprints is split into blocks that meet pairwise. A task returns
only the links that join parts not yet joined, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import fresh, quoted, ship, store
from tunelake.llm.components import components

BITS = 64
SEED = 42
# Fingerprints of one deal that a task takes at once; larger deals are split.
BLOCK_ROWS = 16_384
# Deals are handled together up to about this many rows.
CHUNK_ROWS = 100_000
# Candidate pairs expanded at once.
PAIR_ROWS = 1 << 20


def simhash64(data: bytes, shingle: int) -> int:
    """Fingerprint of a text in UTF-8; zero for a text without words."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        digests = [digest(joined[a:b], SEED)
                   for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(BITS, np.int64)
    values = np.array(digests, dtype="<u8")
    for at in range(0, len(values), 65_536):
        part = values[at: at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def _fingerprint_udf(shingle: int):
    def fingerprint(texts: pa.Array) -> pa.Array:
        values = np.fromiter((simhash64(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts),
                             np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return F.arrow_udf(fingerprint, "long")


def with_fingerprint(docs: DataFrame, name: str, *, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``docs`` plus the long column ``name``. Null text counts as empty."""
    ship(docs.sparkSession)
    return docs.withColumn(name, _fingerprint_udf(shingle)(quoted(text_col).cast("binary")))


class Ring:
    """Segments of a fingerprint and the budgets of their chains."""

    def __init__(self, max_bits: int):
        self.max_bits, self.n = max_bits, max_bits + 1
        cuts = [round(k * BITS / self.n) for k in range(self.n + 1)]
        self.shift = np.array(cuts[:-1], np.uint64)
        self.width = np.array([b - a for a, b in zip(cuts, cuts[1:])])
        self.mask = np.array([(1 << int(w)) - 1 for w in self.width], np.uint64)
        whole = [int(m) << int(s) for m, s in zip(self.mask, self.shift)]
        # chain[k, i]: the bits of the k + 1 segments from i on
        self.chain = np.array([[sum(whole[(i + j) % self.n] for j in range(k + 1)) for i in range(self.n)]
                               for k in range(self.n)], np.uint64)
        self.budget = [(k + 1) * max_bits // self.n for k in range(self.n)]

    def segment(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (values >> self.shift[at]) & self.mask[at]

    def close(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Pairs whose chains from segment ``at`` all stay in budget; the last
        chain is the whole ring, so these are within max_bits."""
        differ, ok = a ^ b, np.ones(len(a), bool)
        for k in range(1, self.n):
            ok[ok] = np.bitwise_count(differ[ok] & self.chain[k, at[ok]]) <= self.budget[k]
        return ok


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        parent = parent.copy()
        parent[np.maximum(ra, rb)] = np.minimum(ra, rb)
        parent = _roots(parent)


def _expand(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, position) for every position in [lo, hi) of each row, in pieces."""
    some = hi > lo
    rows, lo, n = rows[some], lo[some], (hi - lo)[some]
    ends = np.cumsum(n)
    at = 0
    while at < len(rows):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIR_ROWS, "right")))
        take = n[at:to]
        first = np.repeat(ends[at:to] - take, take)
        yield np.repeat(rows[at:to], take), np.repeat(lo[at:to], take) + np.arange(done, done + take.sum()) - first
        at = to


def links_in(ring: Ring, deal: np.ndarray, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links spanning what is within max_bits in each deal. deal: 0, 1, ...,
    one per group; at: the group's starting segment; values: fingerprints."""
    after = (at + 1) % ring.n
    code = (deal.astype(np.int64) << int(ring.width.max())) | ring.segment(values, after).astype(np.int64)
    order = np.argsort(code, kind="stable")
    deal, at, values, code, after = deal[order], at[order], values[order], code[order], after[order]
    _, node = np.unique(values, return_inverse=True)
    names = np.zeros(node.max() + 1, np.uint64)
    names[node] = values
    parent = np.arange(len(names))
    rows = np.arange(len(code))
    flips = [0] + [1 << t for t in range(int(ring.width.max()))] * (ring.n > 1 and ring.budget[1] >= 1)
    for flip in flips:
        to = code ^ flip
        mine = (flip >> ring.width[after]) == 0
        if flip:
            mine &= to > code
            lo, hi = np.searchsorted(code, to, "left"), np.searchsorted(code, to, "right")
        else:
            lo, hi = rows + 1, np.searchsorted(code, to, "right")
        for a, b in _expand(rows[mine], lo[mine], hi[mine]):
            apart = parent[node[a]] != parent[node[b]]
            a, b = a[apart], b[apart]
            ok = ring.close(values[a], values[b], at[a])
            parent = _union(parent, node[a[ok]], node[b[ok]])
    moved = parent != np.arange(len(parent))
    return names[moved], names[parent[moved]]


def _linker(max_bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, held = Ring(max_bits), []

        def solve(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
            change = np.any(key[1:] != key[:-1], axis=1)
            deal = np.concatenate(([0], np.cumsum(change)))
            a, b = links_in(ring, deal, key[:, 0], value)
            return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append((np.stack(cols[:-1], axis=1).astype(np.int64), cols[-1].astype(np.int64).view(np.uint64)))
            if sum(len(v) for _, v in held) < CHUNK_ROWS:
                continue
            key, value = (np.concatenate(x) for x in zip(*held))
            # the last deal may go on in the next batch
            whole = int(np.argmax(np.all(key == key[-1], axis=1)))
            if whole:
                yield solve(key[:whole], value[:whole])
            held = [(key[whole:], value[whole:])]
        if held:
            key, value = (np.concatenate(x) for x in zip(*held))
            if len(value):
                yield solve(key, value)

    return link


def link_fingerprints(values: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints (one long column) that
    connect exactly what pairs within ``max_bits`` connect."""
    ship(values.sparkSession)
    ring = Ring(max_bits)
    name = values.columns[0]
    # shiftrightunsigned keeps the sign bit of the top segment out of the way
    segments = F.array(*[F.shiftrightunsigned(name, int(s)).bitwiseAND(F.lit(int(m)).cast("long"))
                         if ring.n > 1 else F.lit(0).cast("long") for s, m in zip(ring.shift, ring.mask)])
    dealt = values.select(F.posexplode(segments).alias("at", "seg"), F.col(name).alias("value"))
    counts = dealt.groupBy("at", "seg").count()
    # at most one row per segment value, whatever the data
    large = (counts.filter(F.col("count") > BLOCK_ROWS)
             .select("at", "seg", F.ceil(F.col("count") / (BLOCK_ROWS // 2)).cast("long").alias("blocks")))
    large = F.broadcast(large) if ring.n >= 4 else large
    mine = F.pmod(F.xxhash64("value"), F.col("blocks"))
    split = (dealt.join(large, ["at", "seg"], "left")
             .withColumn("mine", F.when(F.col("blocks").isNotNull(), mine))
             .withColumn("other", F.explode(F.expr(
                 "if(blocks is null, array(-1L), filter(sequence(0L, blocks - 1), b -> b != mine))")))
             .select("at", "seg", F.coalesce(F.least("mine", "other"), F.lit(0).cast("long")).alias("x"),
                     F.coalesce(F.greatest("mine", "other"), F.lit(0).cast("long")).alias("y"), "value"))
    keys = ["at", "seg", "x", "y"]
    return split.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_linker(max_bits), "a long, b long")


def near_duplicates(prints: DataFrame, *, id_col: str = "doc_id", print_col: str = "fingerprint",
                    max_bits: int = 4) -> DataFrame:
    """(print_col, component_id) per distinct fingerprint: the smallest id
    among the documents reachable by links of at most ``max_bits``.

    ``prints`` should be a stored table. Rows with a null id name nothing and
    link nothing. Repeated rows change nothing. No rows give no rows.
    """
    named = prints.filter(quoted(id_col).isNotNull()).groupBy(print_col).agg(F.min(id_col).alias("first_id"))
    named = store(named, "fingerprints")
    groups = components(link_fingerprints(named.select(print_col), max_bits))
    placed = named.join(groups, named[print_col] == groups["node"], "left").select(
        named[print_col], "first_id", F.coalesce("component", print_col).alias("group"))
    placed = store(placed, "fingerprint-groups")
    least = placed.groupBy("group").agg(F.min("first_id").alias("component_id"))
    return placed.join(least, "group").select(print_col, "component_id")


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_bits: int = 4) -> DataFrame:
    """(id, fingerprint long, component_id) per row of ``docs``.

    Fewer words than ``shingle``: the whole word sequence is one shingle; no
    word (or null text): fingerprint zero, linked like any other. A null id
    gets a fingerprint and a null component.
    """
    prints = with_fingerprint(docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")),
                              "fingerprint", shingle=shingle).select("doc_id", "fingerprint")
    prints = store(prints, "prints")
    groups = near_duplicates(prints, max_bits=max_bits)
    out = prints.join(groups, "fingerprint", "left")
    return out.select(F.col("doc_id").alias(id_col), "fingerprint",
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: the document with the
    smallest id of each group, once. Rows without an id stay. Only ids and
    hashes are stored; the texts move once, to meet the ids that stay."""
    h = fresh(docs.columns, "text_hash")
    rows = docs.withColumn(h, F.xxhash64(F.coalesce(quoted(text_col), F.lit(""))))
    prints = with_fingerprint(rows.select(quoted(id_col).alias("doc_id"), quoted(h).alias("h"), quoted(text_col).alias("text"))
                              .filter("doc_id is not null"), "fingerprint", shingle=shingle)
    prints = store(prints.select("doc_id", "h", "fingerprint"), "prints")
    groups = near_duplicates(prints, max_bits=max_bits)
    stays = (prints.groupBy("doc_id", "h", "fingerprint").count()
             .join(groups, "fingerprint").filter("doc_id = component_id"))
    its_id, its_h = fresh(rows.columns, "stays_id"), fresh(rows.columns, "stays_hash")
    stays = store(stays.select(F.col("doc_id").alias(its_id), F.col("h").alias(its_h), "count"), "stays")
    kept = rows.filter(quoted(id_col).isNotNull()).join(
        stays.drop("count"), (quoted(id_col) == F.col(its_id)) & (quoted(h) == F.col(its_h)), "left_semi")
    if not stays.filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, h])
    return kept.unionByName(rows.filter(quoted(id_col).isNull())).select(*map(quoted, docs.columns))
