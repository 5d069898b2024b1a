import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tunelake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="tunelake-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tunelake-test-ckpt-"))
    yield s


def docs_of(spark, rows, extra=()):
    """documents with the given (doc_id, text) rows and clashing extra columns."""
    names = ["size", "shard", "fingerprint", "kept", "component_id", "n_words", "a.b", "_id"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    full = [(i, t, None, "s", None) + ("x",) * len(names) for i, t in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
