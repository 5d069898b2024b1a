"""Embedding links against all pairs in double precision."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import embed_dedup
from tunelake.llm.queries import ORACLE_SQL, op3_embedding_dedup

from .conftest import SF, union_find


def cloud(seed, n=400, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    x = np.concatenate([rng.normal(size=(n // 2, dims)), centres[rng.integers(0, 8, n // 2)] + 0.16 * rng.normal(size=(n // 2, dims))])
    x[5], x[6], x[7] = x[4], x[4] * 3, -x[4]
    return x.astype(np.float32)


def brute(x, threshold=0.95):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return np.argwhere(np.triu(u @ u.T >= threshold, 1))


@pytest.mark.parametrize("dims", [1, 3, 16, 1100])
def test_bound_never_loses_a_pair(dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(60, dims)) * 10.0 ** rng.integers(-12, 12, (60, 1))
    u = embed_dedup.unit_rows(np.concatenate([x, x + 0.2 * np.abs(x).max(axis=1, keepdims=True) * rng.normal(size=x.shape)]))
    codes, step, error = embed_dedup.quantise(u)
    approx = (codes.astype(float) @ codes.T.astype(float)) * step[:, None] * step[None, :]
    bound = (1 + error)[:, None] * (1 + error)[None, :] - 1
    assert (np.abs(approx - u @ u.T) <= bound).all()
    for t in (0.5, 0.95, 0.999):
        maybe = embed_dedup.possible(codes, step, error, codes, step, error, t)
        assert maybe[u @ u.T >= t].all()
    if dims == 16:
        assert maybe.mean() < 0.2


@pytest.mark.parametrize("tile,pivots", [(4096, 512), (40, 512), (25, 2)])
def test_all_pairs(spark, monkeypatch, tile, pivots):
    monkeypatch.setattr(embed_dedup, "TILE_ROWS", tile)
    monkeypatch.setattr(embed_dedup, "MOST_PIVOTS", pivots)
    x = cloud(tile)
    rows = [(int(i), [float(v) for v in r], "e", 1.0) for i, r in enumerate(x)]
    got = embed_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string, cell double").repartition(3))
    pairs = brute(x)
    degree = np.bincount(pairs.ravel(), minlength=len(x))
    group = union_find(range(len(x)), [tuple(p) for p in pairs.tolist()])
    assert len(pairs) > 300
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got.collect()} == {
        i: (degree[i], group[i], group[i] == i) for i in range(len(x))}


def test_dense_tile_equals_sparse_tile():
    u = embed_dedup.unit_rows(1 + 0.01 * np.random.default_rng(1).normal(size=(700, 8)))
    n, d, a, b = embed_dedup.solve_tile(np.arange(700), np.ones(700, np.int64), u, np.ones(700, bool), 0.95, True)
    assert (d == 699).all() and len(n) == 700 and len(a) == 699


def test_query_equals_sql(spark):
    from scripts.check_oracle import compare, open_duckdb
    n, problems = compare(spark, open_duckdb(SF), SF, op3_embedding_dedup, ORACLE_SQL["op3_embedding_dedup"])
    assert n and not problems


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, v), (2, v), (2, v), (3, [2.0, 4.0, 6.1]), (4, w), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 3.0]),
            (9, [1.0, math.nan, 3.0]), (10, [1.0, math.inf, 3.0]), (None, v), (11, [1.0, 2.0]), (12, [1.0, 2.0]), (2, w)]
    docs = spark.createDataFrame([(*r, "m", 3) for r in rows], "vec_id long, embedding array<float>, mult string, degree int")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.embedding_groups(docs).collect())
    assert got == [(0, 0, None, True), (1, 3, 1, True), (2, 1, 2, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False), (4, 1, 2, False),
                   (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True),
                   (11, 1, 11, True), (12, 1, 11, False)]
    assert embed_dedup.embedding_groups(docs.limit(0)).count() == 0
    assert embed_dedup.embedding_groups(docs.filter("vec_id = 5")).count() == 1


def test_few_vectors_with_late_hashes_have_a_pivot(spark):
    """Node numbers of which none falls below a hash bound made from their count."""
    place = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(1 << 40))
    late = [r[0] for r in spark.range(3000).toDF("node").orderBy(place.desc()).limit(60).collect()]
    x = cloud(5, 60, 3)
    nodes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in zip(late, x)], "node long, mult long, embedding array<double>")
    links = embed_dedup.tile_links(nodes, 0.95).filter("b = -1").groupBy("a").agg(F.sum("n").alias("n")).collect()
    degree = np.bincount(brute(x).ravel(), minlength=len(x))
    assert degree.any() and {r["a"]: r["n"] for r in links if r["n"]} == {late[i]: n for i, n in enumerate(degree) if n}
