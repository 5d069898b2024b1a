"""Repair against a plain search over all edits, on whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tunelake.llm import repair
from tunelake.llm.queries import op12_conversation_repair

from .conftest import SF

BLANK = re.compile(r"[\x20\x09-\x0D]")


def cheapest(rows):
    """Cost and ASCII-least audit of (initial, fault) rows, state by state."""
    best = {0: (0, "")}

    def with_inserts(best):
        best = dict(best)
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                t, x = repair.NEXT[s], (c + 5, a + "I")
                best[t] = min(best.get(t, x), x)
        return best

    for initial, fault in rows:
        after = defaultdict(list)
        for s, (c, a) in with_inserts(best).items():
            after[s].append((c + 2, a + "D"))
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                after[repair.NEXT[s]].append((c + 1 + more, a + "R"))
                if (s, initial) in repair.KEPT:
                    after[repair.KEPT[s, initial]].append((c + more, a + "K"))
        best = {s: min(v) for s, v in after.items()}
    best = with_inserts(best)
    return min(best[s] for s in (0, 3) if s in best)


def plain(rows):
    """Everything about a conversation's (turn, role, text) rows."""
    word = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, word(r)))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = BLANK.sub("", text)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(rows, faults)])
    state, said, left = 0, [], iter(rows)
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = repair.KEPT[state, role[0]]
        else:
            role, state = "assistant" if state == 2 else "user", repair.NEXT[state]
        said.append((edit, role, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in said))
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in said).encode()).hexdigest()), said


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    """conversations with a clashing extra column, over several partitions."""
    full = [(*r, "x", "y") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, kind string, `cost` string").repartition(5)


def check(spark, rows, ids=None):
    held = defaultdict(list)
    for c, *r in rows:
        held[c].append(tuple(r))
    want = {c: plain(v) for c, v in held.items()}
    want |= {c: ((0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()), []) for c in (ids or []) if c not in want}
    marks = None if ids is None else spark.createDataFrame([(c,) for c in ids], "conv_id long")
    got = repair.repair_report(frame(spark, rows), ids=marks).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]][0], r
    turns = defaultdict(list)
    for r in repair.repaired_turns(frame(spark, rows)).collect():
        turns[r["conv_id"]].append((r["place"], r["edit"], r["role"], r["text"]))
    assert {c: [x[1:] for x in sorted(v)] for c, v in turns.items()} == {c: said for c, (_, said) in want.items() if said}
    assert all([x[0] for x in sorted(v)] == list(range(len(v))) for v in turns.values())


@pytest.mark.parametrize("pieces", [1, 2, 5, 100])
def test_pieces_join_to_the_cheapest_audit(pieces):
    rng = random.Random(pieces)
    for _ in range(1500):
        rows = [(rng.choice("suaux "), rng.choice(["", "", "", "b", "d", "t"]), rng.choice([1, 1, 1, 3])) for _ in range(rng.randrange(12))]
        parts = [rows[k:k + pieces] for k in range(0, len(rows), pieces)]
        options = [repair.piece_options(p, repair.STATES if k else (0,)) for k, p in enumerate(parts)]
        single = [(i, f if not k else "b" if f == "b" else "d") for i, f, n in rows for k in range(n)]
        assert repair.join_pieces(options) == cheapest(single), rows


def test_work_grows_with_the_rows():
    rng = random.Random(7)
    rows = [(rng.choice("suaux"), rng.choice(["", "", "", "b", "d", "t"]), 1) for _ in range(4000)]
    looked = 0

    def count(node, arcs):
        nonlocal looked
        looked += 1
        return arcs(node)

    real = repair.auction

    def spy(columns, arcs, price):
        real(columns, lambda node: count(node, arcs), price)

    steps = {}
    for n in (1000, 4000):
        looked, repair.auction = 0, spy
        try:
            repair.piece_options(rows[:n], (0,))
        finally:
            repair.auction = real
        steps[n] = looked
    assert steps[4000] < 4.5 * steps[1000]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    held = {r["conv_id"]: [] for r in rows}
    for r in rows:
        hit = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", r["text"]) if hit == 2 else r["text"]
        held[r["conv_id"]] += [(r["turn"], "user" if hit == 4 else r["role"], text)] * {0: 0, 3: 2}.get(hit, 1)
    out = op12_conversation_repair(spark, SF)
    assert out.columns == ["conv_id", *COLUMNS]
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in out.collect()} == {c: plain(v)[0] for c, v in held.items()}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "Hello."), (1, None, "assistant", "x."), (1, None, "user", "y."), (1, 4, "tool", "z"),
            (None, 0, "user", "a."), (None, 1, "assistant", "b."), (2, None, "", "c."), (2, None, "", ""), (3, 5, "user", " \t\n\x0b"),
            (4, 0, "user", "same."), (4, 0, "user", "same."), (4, 0, "user", "same."), (4, 1, "assistant", "word. " * 50_000),
            (5, 0, "system", "s."), (6, -3, "user", "é ?"), (6, 10, "assistant", "日本語")]
    check(spark, rows, ids=[1, 3, 99, 99, None])
    check(spark, [])
    assert repair.repair_report(frame(spark, []), ids=spark.createDataFrame([(1,)], "conv_id long")).count() == 1


def test_long_conversation_in_many_pieces(spark, monkeypatch):
    """A conversation with most of the rows goes over several tasks."""
    monkeypatch.setattr(repair, "PIECE_ROWS", 7)
    rng = random.Random(8)
    rows = [(9 if k % 4 else k, k // 2, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", f"{k}", f"{k}!", "", "x?"]))
            for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tables would be one task
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_equal_rows(spark):
    rows = [(1, None, "user", "again.")] * 500 + [(1, 3, "assistant", "yes.")] + [(2, k, "user", "again.") for k in range(300)]
    check(spark, rows)


def test_damage(spark):
    turns = spark.createDataFrame([(c, t, "assistant", "A. B! C?") for c in range(40) for t in (0, None)] + [(None, 1, None, None)],
                                  "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in repair.damage(turns).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    for (c, t) in [(c, t) for c in range(40) for t in (0, None)] + [(None, 1)]:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" ", " ") if c is None else ("assistant", "A. B! C?")
        text = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(hit, text)
        assert got[c, t] == [("user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    assert "text" in repair.damage(turns.withColumn("copy", F.lit(1))).columns
