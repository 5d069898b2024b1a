"""Archives: exact round trips, members that stand alone, duplicates as revisits."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tunelake.llm import warc
from tunelake.llm.queries import ORACLE_SQL, op4_warc_normaliser

from .conftest import SF


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages_of(spark, rows):
    schema = "page_id long, url string, html string, payload string, sha1 string, keeper int, key string, type string"
    return spark.createDataFrame([(*r, "x", "y", 1, "k", "t") for r in rows], schema).repartition(3)


def stream_of(payloads):
    return b"".join(warc.page_record(i, f"http://x/{i}", p, hashlib.sha1(p).hexdigest(), i) for i, p in enumerate(payloads))


@pytest.mark.parametrize("pieces", [1, 3])
def test_normaliser(pieces, monkeypatch):
    """One stream of one or several members; tiny pieces cross every border."""
    monkeypatch.setattr(warc, "PIECE", 7)
    rng = random.Random(1)
    payloads = [b"", b"\r\n\r\n", b"WARC/1.1\r\n", rng.randbytes(5000), b"a" * 70_000]
    raw = stream_of(payloads)
    cuts = [len(raw) * k // pieces for k in range(pieces + 1)]
    data = b"".join(gzip.compress(raw[a:b]) for a, b in zip(cuts, cuts[1:]))
    out = io.BytesIO()
    index = list(warc.normalise_stream(io.BytesIO(data), out.write))
    made = out.getvalue()
    assert gzip.decompress(made) == raw
    assert sum(x[1] for x in index) == len(made) and [x[3] for x in index] == [f"<urn:x-page:{i}>" for i in range(5)]
    for (offset, length, kind, _), p in zip(index, payloads):
        row = warc.read_page(io.BytesIO(made[offset:offset + length]), True)
        assert kind == "response" and row[1:4] == (len(p), sha(p), "response") and row[6] == p


def test_damage_raises():
    data = gzip.compress(stream_of([b"hello" * 100]))
    for bad in (data[:-9], data[:40], gzip.compress(b"nonsense\r\n\r\n"), gzip.compress(stream_of([b"x"])[:-3])):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.normalise_stream(io.BytesIO(bad), lambda b: None))
    record = warc.page_record(1, None, b"payload", hashlib.sha1(b"other").hexdigest(), 1)
    with pytest.raises(ValueError):
        warc.read_page(io.BytesIO(gzip.compress(record)), False)


def test_query_equals_sql(spark):
    from scripts.check_oracle import compare, open_duckdb
    n, problems = compare(spark, open_duckdb(SF), SF, op4_warc_normaliser, ORACLE_SQL["op4_warc_normaliser"])
    assert n and not problems


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 500)
    long = "é" * 300_000
    rows = [(1, "http://a/b c\n", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "n", "same"), (None, None, None),
            (9, "r", "twice"), (9, "r", "twice"), (10, "l", long)]
    got = sorted(((r["page_id"] if r["page_id"] is not None else -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"],
                   r["payload"]) for r in warc.archive_pages(pages_of(spark, rows)).collect()), key=lambda r: r[:2] + (r[4],))
    text = lambda t: (len(t.encode()), sha(t.encode()))
    want = [(-1, "response", None, *text("same"), b"same"), (-1, "response", None, *text(""), b""), (1, "revisit", 2, *text("same"), None),
            (2, "response", None, *text("same"), b"same"), (3, "revisit", 4, *text(""), None), (4, "response", None, *text(""), b""),
            (9, "response", None, *text("twice"), b"twice"), (9, "response", None, *text("twice"), b"twice"), (10, "response", None, *text(long), long.encode())]
    assert got == sorted(want, key=lambda r: r[:2] + (r[4],))
    small = {r["page_id"]: r["record_type"] for r in warc.archive_pages(pages_of(spark, rows).filter("page_id < 9"), min_bytes=1).collect()}
    assert small == {1: "revisit", 2: "response", 3: "response", 4: "response"}
    assert warc.archive_pages(pages_of(spark, rows).limit(0)).count() == 0


def test_read_back_is_dealt_by_bytes(spark, tmp_path, monkeypatch):
    """Many archive bytes behind few index lines still make many tasks."""
    import random
    monkeypatch.setattr(warc, "READ_BYTES", 20_000)
    rng = random.Random(6)
    pages = spark.createDataFrame([(i, f"http://x/{i}", "".join(chr(rng.randrange(33, 126)) for _ in range(3000))) for i in range(200)],
                                  "page_id long, url string, html string")
    back = warc.archive_pages(pages)
    assert back.rdd.getNumPartitions() >= 10
    tasks = back.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 8 and back.count() == 200
