"""Chat folding and rendering: a plain fold, exact round trips, SQL."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tunelake.llm import chat
from tunelake.llm.queries import HOSTILE, ORACLE_SQL, op1_chat_format

from .conftest import SF

EVENT = "conv_id long, seq long, target string, kind string, role string, text string, n_turns string, formatted int"


def events_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], EVENT).repartition(3)


def plain_fold(rows):
    order = ["message", "start", "regenerate", "edit", "delta", "delete"]
    key = lambda r: (r[1] is not None, r[1] or 0, order.index(r[3] or "message"), r[4] or "", r[5] or "")
    made, last = [], {}
    for conv, seq, target, kind, role, text in sorted(rows, key=key):
        kind = kind or "message"
        if kind in ("message", "start") or (conv, target) not in last:
            last[conv, target] = m = {"conv": conv, "seq": seq, "role": role or "", "text": "", "gone": False}
            made.append(m)
        m = last[conv, target]
        if kind in ("message", "edit", "delta", "regenerate", "start"):
            m["text"] = (m["text"] if kind == "delta" else "") + ((text or "") if kind in ("message", "edit", "delta") else "")
        m["gone"] |= kind == "delete"
    out = {}
    for m in made:
        out.setdefault(m["conv"], [])
        if not m["gone"]:
            out[m["conv"]].append((m["seq"], m["role"], m["text"]))
    return {c: sorted(v, key=lambda x: (x[0] is not None, x)) for c, v in out.items()}


def folded(frame):
    return {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in chat.fold_events(frame).collect()}


def test_fold_by_example(spark):
    rows = [(1, 1, "a", "message", "user", "hi"), (1, 2, "b", "start", "assistant", None), (1, 3, "b", "delta", None, "Hel"),
            (1, 5, "b", "delta", None, "lo"), (1, 6, "b", "regenerate", None, None), (1, 7, "b", "delta", None, "Good "),
            (1, 8, "b", "delta", None, "day"), (1, 9, "a", "edit", None, "hello"), (1, 10, "c", "message", "user", "oops"), (1, 11, "c", "delete", None, None)]
    assert folded(events_of(spark, rows)) == {1: [(1, "user", "hello"), (2, "assistant", "Good day")]}


def test_fold_at_random(spark):
    rng = random.Random(1)
    kinds = ["message", "start", "delta", "delta", "edit", "regenerate", "delete", None]
    rows = [(rng.choice([None, 1, 2]), s, rng.choice(["a", "b", None]), rng.choice(kinds), rng.choice(["user", "assistant", None]), rng.choice(["x", "y", "", None]))
            for s in range(120)]
    assert folded(events_of(spark, rows)) == plain_fold(rows)


TEXTS = [None, "", HOSTILE, "\\", "\\\\n", "</turn>", "</turn>\n", "###", "######", "### User: x</turn>\n### Assistant: y", "<\\/turn>", "#\\##", "a\nb\r\n", "é日本🙂", "</turn</turn>>"]


def test_round_trip(spark):
    roles = ["user", "assistant", "system", "User", "", "a: b", "=x", "###", "tool</turn>\n", "\\", None]
    rows = [(c, i, str(i), "message", roles[(c + i) % len(roles)], t) for c in range(len(roles)) for i, t in enumerate(TEXTS)]
    back = {r["conv_id"]: r for r in chat.read_turns(chat.format_conversations(events_of(spark, rows))).collect()}
    for c in range(len(roles)):
        turns = [(roles[(c + i) % len(roles)] or "", t or "") for i, t in enumerate(TEXTS)]
        r = back[c]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss_texts"] == [t for role, t in turns if role == "assistant"]
        for s, t in zip(r["loss_spans"], r["loss_texts"]):
            part = r["formatted"][s["start"]:s["start"] + s["length"]]
            raw = r["formatted"].encode()[s["byte_start"]:s["byte_start"] + s["byte_length"]]
            assert raw.decode() == part and "</turn>" not in part and "###" not in part


def test_query_equals_sql(spark):
    from scripts.check_oracle import compare, open_duckdb
    n, problems = compare(spark, open_duckdb(SF), SF, op1_chat_format, ORACLE_SQL["op1_chat_format"])
    assert n and not problems
    row = op1_chat_format(spark, SF).filter("conv_id = -7").first()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(HOSTILE), hashlib.sha256(HOSTILE.encode()).hexdigest())


def test_odd_rows(spark):
    turns = spark.createDataFrame([(None, 0, "user", "a", 1), (1, None, "assistant", "b", 1), (1, 0, "user", None, 1), (2, 0, "user", "same", 1), (2, 0, "user", "same", 1),
                                   (3, 0, None, "long " * 200_000, 1)], "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(chat.turn_events(turns))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {c: r["turns_sha256"] for c, r in got.items()} == {None: sha("user\na\n"), 1: sha("assistant\nb\nuser\n\n"), 2: sha("user\nsame\n" * 2),
                                                             3: sha("\n" + "long " * 200_000 + "\n")}
    assert {c: r["loss_chars"] for c, r in got.items()} == {None: 0, 1: 1, 2: 0, 3: 0}
    assert chat.format_conversations(chat.turn_events(turns.limit(0))).count() == 0
    with pytest.raises(Exception, match="unknown event kind"):
        chat.fold_events(chat.turn_events(turns).withColumn("kind", F.lit("odd"))).collect()


def test_plan_has_no_python(spark):
    plan = op1_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
