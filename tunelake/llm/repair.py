"""Cheapest repair of the structure of conversations.

The edits of a conversation's rows are arcs of a lattice: a node is a row
boundary and what the roles so far allow next. A shortest path through it is a
cheapest repair. Shortest paths come from an auction: every node has a price,
never more than any arc's cost plus the price behind it. A path is extended
from its last node along an arc that is worth the node's price, or, if there is
none, the node's price rises to the cheapest arc's and the path gives the node
up. Origins are taken from the last column to the first, so that a path ends at
the first node whose price is final, and work grows with the rows. At the end
the arcs that are worth their node's price (the tight ones) are exactly those
of cheapest repairs; following the smallest letter among them gives the
ASCII-least one.

Rows are dealt by ranges of (conversation, turn), so a long conversation is cut
into pieces over many tasks. A piece gives the cheapest audit for each pair of
states at its ends, and the same auction over the pieces joins them. Texts are
only streamed past, in the conversation's order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import quoted, ship

# The contract's costs, and the characters that count as blank.
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"

# What the roles so far allow: anything (nothing yet), a user after the system
# row, an assistant, or a user or the end.
START, AFTER_SYSTEM, WANTS_ASSISTANT, COMPLETE = range(4)
STATES, ENDS = range(4), (START, COMPLETE)
KEPT = {(START, "s"): AFTER_SYSTEM, (START, "u"): WANTS_ASSISTANT, (AFTER_SYSTEM, "u"): WANTS_ASSISTANT,
        (WANTS_ASSISTANT, "a"): COMPLETE, (COMPLETE, "u"): WANTS_ASSISTANT}
NEXT = {START: WANTS_ASSISTANT, AFTER_SYSTEM: WANTS_ASSISTANT, WANTS_ASSISTANT: COMPLETE, COMPLETE: WANTS_ASSISTANT}
# States from which a piece can end in a state.
COMES_FROM = {START: {START}, AFTER_SYSTEM: {START, AFTER_SYSTEM}, WANTS_ASSISTANT: set(STATES), COMPLETE: set(STATES)}

# Different rows of a conversation that one lattice holds.
PIECE_ROWS = 2_048

Arc = tuple[str, int, int]  # letters of the audit, cost, node


def new_role(state: int) -> str:
    """Of a row inserted or given a role there."""
    return "assistant" if state == WANTS_ASSISTANT else "user"


def auction(columns: Iterator[list[int]], arcs: Callable[[int], list[Arc]], price: dict[int, float]) -> None:
    """Completes ``price``, which holds the final prices of the end nodes, by
    those of ``columns`` of nodes: the least cost to an end, infinite if none
    is reached.

    Arcs lead to the same column, at a cost, or to the one before it in the
    sequence (the first column's to the end nodes). A column's prices start at
    the lowest of the one before, which is never too much.
    """
    final, before = set(price), list(price)
    for column in columns:
        floor = min(price[v] for v in before)
        price |= dict.fromkeys(column, floor)
        for origin in column:
            path = [] if origin in final else [origin]
            while path:
                node = path[-1]
                offer, to = min(((cost + price[v], v) for _, cost, v in arcs(node)), default=(math.inf, -1))
                if offer == math.inf:
                    price[node] = offer
                    final.add(node)
                    path.pop()
                elif price[node] < offer:  # contract
                    price[node] = offer
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(to)  # extend
                    if to in final:
                        final.update(path)
                        break
        before = column


def trace(node: int, arcs: Callable[[int], list[Arc]], price: dict[int, float], ends) -> tuple[str, int]:
    """Letters of the ASCII-least tight path from ``node``, and the end that it reaches."""
    letters = []
    while node not in ends:
        label, node = min((label, v) for label, cost, v in arcs(node) if cost + price.get(v, math.inf) == price[node])
        letters.append(label)
    return "".join(letters), node


def piece_options(rows: list[tuple[str, str, int]], entries) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of the cheapest repairs of consecutive rows
    for every pair of states that they can lead from and to; rows are
    (initial, fault, copies), fault one of ``b d t`` or empty. Rows are
    inserted before a piece's rows, not after its last."""
    # copies after the first are duplicates (or blank): a run of deletions
    steps = [s for initial, fault, n in rows for s in
             ([("", n)] if fault in ("b", "d") else [((initial or " ") + fault, 1), ("", n - 1)]) if s[1]]
    last, cache = len(steps) * 4, {}

    def column(step: tuple[str, int]) -> list[list[tuple[str, int, int, int]]]:
        kind, n = step
        if not kind:
            return [[("D" * n, DELETE * n, 1, s)] for s in STATES]
        more = KEEP_TRUNCATED if kind[1:] == "t" else 0
        out = []
        for s in STATES:
            arcs = [("D", DELETE, 1, s), ("I", INSERT, 0, NEXT[s]), ("R", REROLE + more, 1, NEXT[s])]
            if (s, kind[0]) in KEPT:
                arcs.append(("K", more, 1, KEPT[s, kind[0]]))
            out.append(arcs)
        return out

    found = []
    for leave in STATES:
        able = COMES_FROM[leave]

        def arcs(node: int) -> list[Arc]:
            k, s = divmod(node, 4)
            step = steps[k]
            if (step, s, leave) not in cache:
                cache[step, s, leave] = [a for a in column(step)[s] if a[3] in able]
            return [(label, cost, (k + go) * 4 + v) for label, cost, go, v in cache[step, s, leave]]

        price: dict[int, float] = {last + s: math.inf for s in STATES} | {last + leave: 0}
        auction(([k * 4 + s for s in sorted(able)] for k in reversed(range(len(steps)))), arcs, price)
        for enter in entries:
            if price.get(enter, math.inf) < math.inf:
                found.append((enter, leave, int(price[enter]), trace(enter, arcs, price, {last + leave})[0]))
    return found


def join_pieces(pieces: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of a conversation from its pieces' options, in order."""
    last, end = len(pieces) * 4, len(pieces) * 4 + 4

    def arcs(node: int) -> list[Arc]:
        k, s = divmod(node, 4)
        if node < last:
            return [(audit, cost, (k + 1) * 4 + leave) for enter, leave, cost, audit in pieces[k] if enter == s]
        return [("I", INSERT, last + NEXT[s])] + [("", 0, end)] * (s in ENDS)

    price: dict[int, float] = {end: 0}
    auction(([k * 4 + s for s in STATES] for k in reversed(range(len(pieces) + 1))), arcs, price)
    return int(price[0]), trace(0, arcs, price, {end})[0]


PIECE = "array<struct<enter: int, leave: int, cost: long, audit: string>>"
PIECES = f"cn boolean, c long, has boolean, t long, word binary, options {PIECE}, faults string"


def _solve_pieces(most: int):
    schema = pa.schema([("cn", pa.bool_()), ("c", pa.int64()), ("has", pa.bool_()), ("t", pa.int64()), ("word", pa.binary()),
                        ("options", pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
                        ("faults", pa.string())])

    def solved(piece: list[tuple], entries) -> dict:
        options = piece_options([r[5:] for r in piece], entries)
        return dict(zip(schema.names, piece[0][:5])) | {
            "options": [dict(zip(("enter", "leave", "cost", "audit"), o)) for o in options],
            "faults": "".join((f or "-") + ("b" if f == "b" else "d") * (n - 1) for *_, f, n in piece)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of a task to pieces. Its first conversation may have
        begun in the task before, so that one is solved from every state."""
        piece, out, held, conversation, whole = [], [], 0, None, False
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if piece and (row[:2] != conversation or len(piece) >= most):
                    out.append(solved(piece, (START,) if whole else STATES))
                    held += len(piece)
                    # a piece that opens its conversation is entered at the start only
                    whole, piece = row[:2] != conversation, []
                    if held >= 20_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                conversation = row[:2]
                piece.append(row)
        if piece:
            out.append(solved(piece, (START,) if whole else STATES))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


class Repair:
    """One conversation, streamed: its pieces first, then its rows in order."""

    def __init__(self):
        self.pieces, self.faults, self.audit, self.cost = [], {"b": 0, "d": 0, "t": 0}, None, 0
        self.least = self.most = self.last_turn = self.initial = None
        self.turns = self.illegal = self.at = 0
        self.state, self.hash, self.said = START, hashlib.sha256(), 0

    def piece(self, options, faults: str) -> None:
        self.pieces.append([(o["enter"], o["leave"], o["cost"], o["audit"]) for o in options])
        for f in self.faults:
            self.faults[f] += faults.count(f)

    def _solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = join_pieces(self.pieces)
            self.pieces = []

    def _say(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.hash.update(("\n" * (self.said > 0) + f"{role}:{text}").encode())
        self.said += 1
        return self.said - 1, edit, role, text

    def _inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            role = new_role(self.state)
            self.state = NEXT[self.state]
            yield self._say("I", role, "")

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        """The repaired rows up to and with this row's."""
        self._solve()
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[:1]]
            yield self._say(edit, role, text)
        elif edit == "R":
            role = new_role(self.state)
            self.state = NEXT[self.state]
            yield self._say(edit, role, text)

    def end(self) -> Iterator[tuple[int, str, str, str]]:
        self._solve()
        yield from self._inserted()

    def summary(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, self.cost, self.audit, self.hash.hexdigest())


SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _stream(rows_wanted: bool):
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in (REPAIRED if rows_wanted else SUMMARY).split(", "))])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, repair, out, held = None, None, [], 0

        def closed() -> list[tuple]:
            conv_id = None if now[0] else now[1]
            rest = [(conv_id, *x) for x in repair.end()]
            return rest if rows_wanted else [(conv_id, *repair.summary())]

        for batch in batches:
            for cn, c, kind, has, t, _, role, text, options, faults in zip(*(x.to_pylist() for x in batch.columns)):
                if (cn, c) != now:
                    out += closed() if repair else []
                    now, repair = (cn, c), Repair()
                if kind == 1:
                    repair.piece(options, faults)
                elif kind == 2:
                    for said in repair.row(t if has else None, role, text):
                        if rows_wanted:
                            out.append((None if cn else c, *said))
                            held += len(said[3])
                if len(out) >= 5_000 or held >= 4_000_000:
                    yield batch_of(out)
                    out, held = [], 0
        out += closed() if repair else []
        if out:
            yield batch_of(out)

    return run


def _keyed(turns: DataFrame) -> DataFrame:
    """Rows in sortable form: nulls as flags, role and text as one exact word."""
    blank = F.lit(" ")
    role, text = F.coalesce(quoted("role"), blank), F.coalesce(quoted("text"), blank)
    conv, turn = quoted("conv_id").cast("long"), quoted("turn").cast("long")
    zero = F.lit(0).cast("long")
    word = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    return turns.select(conv.isNull().alias("cn"), F.coalesce(conv, zero).alias("c"), turn.isNotNull().alias("has"),
                        F.coalesce(turn, zero).alias("t"), word.alias("word"), role.alias("role"), text.alias("text"))


PLACE = ["cn", "c", "has", "t", "word"]


def _fault(text: Column) -> Column:
    bare = F.rtrim(text, F.lit(BLANKS))
    return F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")


def _sorted_stream(turns: DataFrame, ids: DataFrame | None) -> DataFrame:
    rows = _keyed(turns)
    met = rows.select(*PLACE, F.left("role", F.lit(1)).alias("initial"), _fault(F.col("text")).alias("fault"))
    met = met.groupBy(*PLACE).agg(F.max("initial").alias("initial"), F.max("fault").alias("fault"), F.count(F.lit(1)).alias("n"))
    # the first place of a word is not a duplicate; the join's keys are one per row
    first = met.groupBy("cn", "c", "word").agg(F.min(F.struct("has", "t")).alias("at"))
    first = first.select("cn", "c", "word", "at.has", "at.t", F.lit(True).alias("opens"))
    met = met.join(first, PLACE, "left").select(
        *PLACE, "initial", F.when((F.col("fault") != "b") & F.col("opens").isNull(), "d").otherwise(F.col("fault")).alias("fault"), "n")
    pieces = met.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_solve_pieces(PIECE_ROWS), PIECES)
    stream = pieces.withColumn("kind", F.lit(1)).unionByName(rows.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    if ids is not None:
        conv = quoted("conv_id").cast("long")
        marks = ids.select(conv.isNull().alias("cn"), F.coalesce(conv, F.lit(0).cast("long")).alias("c")).distinct()
        stream = stream.unionByName(marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return (stream.repartition("cn", "c").sortWithinPartitions("cn", "c", "kind", "has", "t", "word")
            .select("cn", "c", "kind", "has", "t", "word", "role", "text", "options", "faults"))


def repair_report(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text) and of
    ``ids`` (conv_id, optional): faults, cheapest audit, digest of the repair.

    Rows stand in the order of their turn, nulls first; ties by the SHA-256 of
    role and text. Each row's first fault counts: blank, duplicate (role and
    text seen earlier in the conversation), truncated. The audit has a letter
    per edit: K keep, R new role, D delete, I insert; of the cheapest audits it
    is the ASCII-least. Null role or text: one space. A role that is empty or
    begins with another letter than s, u, a can't be kept. Null conv_id: a
    conversation like any other, null turns take no part in gaps. Repeated
    rows are duplicates. Other columns are not read. No rows, no result; a
    conversation only ``ids`` has: zeros, no audit, the empty text's digest.

    Texts of any length are streamed; of a conversation only the audit (a
    letter per row) is held, which is also its result."""
    ship(turns.sparkSession)
    return _sorted_stream(turns, ids).mapInArrow(_stream(False), SUMMARY)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (gapless from 0), edit (K, R
    or I), role, text. Rules as in ``repair_report``."""
    ship(turns.sparkSession)
    return _sorted_stream(turns, None).mapInArrow(_stream(True), REPAIRED)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` as a log might lose them, by crc32 of ``conv_id:turn`` (nulls:
    one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    conv, turn, role, text = (quoted(c) for c in ("conv_id", "turn", "role", "text"))
    name = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    hit = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce(text, blank), F.coalesce(role, blank)
    return (turns.select(conv.alias("conv_id"), turn.alias("turn"), F.when(hit == 4, "user").otherwise(role).alias("role"),
                         F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                         F.explode(F.when(hit == 0, F.array().cast("array<int>")).when(hit == 3, F.array(F.lit(0), F.lit(1)))
                                   .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))
