"""Embedding near-duplicates by int8 tile products with error bounds.

Equal vectors are one node with a multiplicity. Nodes are dealt into cells by
their nearest pivot; a node also visits every later cell that can hold a
partner of it (triangle inequality on angles), so no pair is missed whatever
the pivots are. Within a cell, blocks of residents and visitors meet in tiles.

In a tile the unit vectors are quantised to int8 with a scale per vector. The
product of the codes is exact in whole numbers, and differs from the cosine by
at most e_x + e_y + e_x * e_y, where e is the length of a vector's own
quantisation error. Only pairs that could reach the threshold within that
bound are computed again, in double precision. A tile returns the number of
links of its nodes and the links that span its groups, never the pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import quoted, ship, smallest_by_hash, store
from tunelake.llm.components import components
from tunelake.llm.simhash import _union

# Nodes per side of a tile, about, and rows of a side multiplied at once.
TILE_ROWS = 4096
STRIP_ROWS = 512
MOST_PIVOTS = 512
# Room for rounding: of the approximate product, and of angles.
PRODUCT_SLACK = 1e-5
ANGLE_SLACK = 1e-6
# Products of codes stay whole numbers in float32 up to 2**24.
EXACT_DIMS = (1 << 24) // (127 * 127)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that neither
    tiny nor huge components over- or underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, step, error): unit is codes * step up to a vector of length error."""
    step = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / step[:, None])
    error = np.sqrt(((unit - codes * step[:, None]) ** 2).sum(axis=1))
    return codes.astype(np.int8), step, error * (1 + 1e-9) + 1e-12


def possible(codes_a: np.ndarray, step_a, error_a, codes_b: np.ndarray, step_b, error_b, threshold: float) -> np.ndarray:
    """Which pairs may reach ``threshold``."""
    carrier = np.float32 if codes_a.shape[1] <= EXACT_DIMS else np.float64
    product = codes_a.astype(carrier) @ codes_b.astype(carrier).T
    product *= step_a.astype(carrier)[:, None]
    product *= step_b.astype(carrier)[None, :]
    # product + ea + eb + ea * eb >= threshold, as product >= (threshold + 1) - (1 + ea) * (1 + eb)
    least = threshold + 1 - PRODUCT_SLACK - (1 + error_a)[:, None] * (1 + error_b)[None, :]
    return product >= least.astype(carrier)


def links_of_tile(a: np.ndarray, b: np.ndarray, threshold: float, same: bool):
    """Yields (rows of a, rows of b) of linked pairs, strip by strip; with
    ``same`` a and b are one block and each pair comes once."""
    coded_a, coded_b = quantise(a), quantise(b)
    for at in range(0, len(a), STRIP_ROWS):
        part = slice(at, at + STRIP_ROWS)
        maybe = possible(*(x[part] for x in coded_a), *coded_b, threshold)
        if same:
            maybe &= np.arange(at, at + maybe.shape[0])[:, None] < np.arange(len(b))[None, :]
        i, j = np.nonzero(maybe)
        if len(i) > maybe.size // 50:
            sure = (a[part] @ b.T)[i, j] >= threshold
        else:
            sure = np.einsum("ij,ij->i", a[at + i], b[j]) >= threshold
        yield at + i[sure], j[sure]


def solve_tile(node: np.ndarray, mult: np.ndarray, unit: np.ndarray, left: np.ndarray, threshold: float, same: bool):
    """(node, links) and (node, node) arrays of a tile; left: rows of its first side."""
    ia = np.flatnonzero(left)
    ib = ia if same else np.flatnonzero(~left)
    degree, parent = np.zeros(len(node), np.int64), np.arange(len(node))
    for i, j in links_of_tile(unit[ia], unit[ib], threshold, same):
        i, j = ia[i], ib[j]
        degree += np.bincount(i, mult[j], len(node)).astype(np.int64) + np.bincount(j, mult[i], len(node)).astype(np.int64)
        parent = _union(parent, i, j)
    linked, moved = degree > 0, parent != np.arange(len(node))
    return node[linked], degree[linked], node[moved], node[parent[moved]]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _tile_udf(threshold: float):
    def tile(table: pa.Table) -> pa.Table:
        node, mult = (table[c].to_numpy() for c in ("node", "mult"))
        left = table["left"].to_numpy()
        kind = table["kind"][0].as_py()
        n, d, a, b = solve_tile(node, mult, unit_rows(_matrix(table["embedding"])), left, threshold, kind == "same")
        none = np.full(len(n), -1, np.int64)
        return pa.table({"a": np.concatenate([n, a]), "b": np.concatenate([none, b]), "n": np.concatenate([d, np.zeros(len(a), np.int64)])})

    return tile


def _home_udf(shared):
    def home(vectors: pa.Array) -> pa.Array:
        angle = np.arccos(np.clip(unit_rows(_matrix(vectors)) @ shared.value.T, -1, 1)) if len(vectors) else np.zeros((0, len(shared.value)))
        cell = angle.argmin(axis=1)
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(angle[np.arange(len(cell)), cell])], ["cell", "angle"])

    return F.arrow_udf(home, "struct<cell: int, angle: double>")


def _visits_udf(shared, radius, theta: float):
    def visits(vectors: pa.Array, cell: pa.Array, own: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        angle = np.arccos(np.clip(unit_rows(_matrix(vectors)) @ shared.value.T, -1, 1))
        cell, own = cell.to_numpy(zero_copy_only=False), own.to_numpy(zero_copy_only=False)
        near = (angle <= own[:, None] + 2 * theta + ANGLE_SLACK) & (angle <= radius[None, :] + theta + ANGLE_SLACK)
        near &= np.arange(angle.shape[1])[None, :] > cell[:, None]
        return pa.array([np.flatnonzero(row).astype(np.int32) for row in near], pa.list_(pa.int32()))

    return F.arrow_udf(visits, "array<int>")


def tile_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n) from a stored table of node, mult, embedding (one length, no
    zero vector): n links of node a where b is -1, else a spanning link."""
    spark = nodes.sparkSession
    theta = math.acos(threshold)
    count = nodes.count()
    pivots = smallest_by_hash(nodes, 3, "node", max(1, min(MOST_PIVOTS, -(-count // TILE_ROWS)))).select("embedding").collect()
    shared = spark.sparkContext.broadcast(unit_rows(np.array([p[0] for p in pivots])))
    homes = store(nodes.withColumn("home", _home_udf(shared)(F.col("embedding"))).select("node", "mult", "embedding", "home.*"), "homes")
    cells = {r["cell"]: r for r in homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("far")).collect()}  # a row per pivot
    radius = np.array([cells[c]["far"] if c in cells else -math.inf for c in range(len(pivots))])
    visiting = homes.withColumn("visits", _visits_udf(shared, radius, theta)(F.col("embedding"), F.col("cell"), F.col("angle")))
    visiting = store(visiting.filter("size(visits) > 0").select("node", "mult", "embedding", F.explode("visits").alias("cell")), "visits")
    guests = dict(visiting.groupBy("cell").count().collect())
    # blocks of residents and of visitors per cell: a literal map of a row per pivot
    blocks = F.create_map(*[F.lit(int(x)) for c, r in cells.items() for x in (c, -(-r["n"] // TILE_ROWS))])
    rooms = F.create_map(*[F.lit(int(x)) for c in cells for x in (c, -(-guests.get(c, 0) // TILE_ROWS))])

    def keyed(rows: DataFrame, kind: str, left, x, y) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "cell", x.cast("int").alias("x"), y.cast("int").alias("y"), left.alias("left"), "node", "mult", "embedding")

    def dealt(rows: DataFrame, others) -> DataFrame:
        """Rows with their own block, once per block of ``others``."""
        own = blocks if rows is homes else rooms
        return (rows.withColumn("mine", F.pmod(F.xxhash64("node"), own[F.col("cell")]))
                .withColumn("blocks", others[F.col("cell")])
                .withColumn("other", F.explode(F.expr("if(blocks > 0, sequence(0, blocks - 1), cast(array() as array<int>))"))))

    inside = dealt(homes, blocks)
    same = keyed(inside.filter("mine = other"), "same", F.lit(True), F.col("mine"), F.col("mine"))
    cross = keyed(inside.filter("mine != other"), "cross", F.col("mine") < F.col("other"), F.least("mine", "other"), F.greatest("mine", "other"))
    hosts = keyed(dealt(homes, rooms), "visit", F.lit(True), F.col("mine"), F.col("other"))
    calls = keyed(dealt(visiting, blocks), "visit", F.lit(False), F.col("other"), F.col("mine"))
    tiles = reduce(DataFrame.unionByName, [same, cross, hosts, calls])
    return tiles.groupBy("kind", "cell", "x", "y").applyInArrow(_tile_udf(threshold), "a long, b long, n long")


def embedding_groups(vectors: DataFrame, threshold: float = 0.95, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: id, n_links (other rows at cosine >= threshold), component_id
    (smallest id reachable, itself included), kept (id = component_id).

    A vector that is null, empty or zero, or holds a null or non-finite
    component, links with nothing; vectors of different lengths do not link;
    rows with a null id link with nothing and are kept, with a null component.
    Rows repeating an id count as rows of their own. No rows, no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(quoted(id_col).alias("id"), quoted(vector_col).alias("embedding"))
    sound = F.expr("id is not null and embedding is not null and size(embedding) > 0 and "
                   "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x != 0)")
    rows = store(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    classes = (rows.filter("sound").groupBy("embedding").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("mult"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = store(classes, "vector-classes")
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = [tile_links(classes.filter(F.size("embedding") == n), threshold) for n in lengths]
    if not found:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = store(reduce(DataFrame.unionByName, found), "tile-links")
    degree = links.filter("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("degree"))
    groups = components(links.filter("b != -1").select("a", "b"))
    placed = classes.join(degree, "node", "left").join(groups, "node", "left").select(
        "embedding", "first_id", "mult", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "node").alias("group"))
    placed = store(placed, "vector-groups")
    least = placed.groupBy("group").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(least, "group").select("embedding", (F.col("mult") - 1 + F.col("degree")).alias("n_links"), "component_id")
    alone = rows.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = rows.filter("sound").join(placed, "embedding").select("id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
