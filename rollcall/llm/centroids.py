"""Centroid clustering by nearest-centroid search in a vantage-point tree (op 12).

Vectors become whole numbers. In every round the driver builds a vantage-point tree over the centroids and broadcasts it (one
vector and a few numbers for each centroid; their number is a parameter). Tasks search it for every vector best-first: a
vector has an open set of subtrees with a lower bound of its distance to their centroids (by the triangle inequality on the
true distances; each side of a node holds its centroids' least and greatest distance from the vantage point), and always
opens the lowest one, until that bound is beyond the best distance found. A bound equal to it is still opened (the pruning
radius includes its border), so of centroids at one distance the smallest number wins. Vectors of a batch take their steps
together, each in its own order. Distances to vantage points and leaves are squared whole numbers; bounds are floating point
with a margin, which can only open more.

Tasks send their sums for each centroid, so a cluster that holds most vectors is no hot key, and a centroid becomes the exact
floor of sum over count in each component. A centroid without vectors stays as it was.

Vectors that are null, of another length than asked, or hold null or non-finite components take no part. Null ids do; they
are never chosen as a start while there are others. Repeated rows each count. If a start vector occurs twice, both are centroids and
the smaller number gets all. Fewer vectors than centroids: as many centroids as vectors. Empty table: no rows. Components
are refused beyond 2**27 after scaling, where squared distances would leave 64 bits. Other columns are left out, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

#: Components up to this give squared distances of 64 components within 64 bits.
LARGEST = 1 << 27


def whole_vectors(table: DataFrame, width: int = 64, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and `v`, floor(scale * component), of the vectors that take part."""
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    rows = rows.filter(F.col("e").isNotNull() & (F.size("e") == width)).filter(F.coalesce(sound, F.lit(False)))
    within = F.when(F.exists("e", lambda x: F.abs(x) * scale >= LARGEST), F.raise_error(F.lit("a vector component is beyond 2**27 after scaling"))).otherwise(F.col("e"))
    return rows.select("vec_id", F.transform(within, lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def first_centroids(vectors: DataFrame, k: int = 16, salt: str = "1:") -> np.ndarray:
    """The `k` vectors with the smallest SHA-256 of the salt and their id, in that order; ties by id and vector."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "vec_id", "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in rows], np.int64)


@dataclass
class Tree:
    """Nodes of a vantage-point tree: a centroid each; children, and the range of their distances from it (-1: none)."""

    centre: np.ndarray
    number: np.ndarray
    child: np.ndarray
    near: np.ndarray
    far: np.ndarray


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def build(centre: np.ndarray) -> Tree:
    """The vantage point of a subtree is its centroid farthest from the subtree's first; the rest is cut at the median distance."""
    number, child, near, far = [], [], [], []

    def grow(members: np.ndarray) -> int:
        at = members[int(np.argmax(squares(centre[members], centre[members[0]])))]
        node = len(number)
        for column, empty in ((number, int(at)), (child, [-1, -1]), (near, [0.0, 0.0]), (far, [0.0, 0.0])):
            column.append(empty)
        rest = members[members != at]
        distance = squares(centre[rest], centre[at])
        order = np.argsort(distance, kind="stable")
        half = (len(rest) + 1) // 2
        for side, some in enumerate((order[:half], order[half:])):
            if len(some):
                near[node][side], far[node][side] = float(np.sqrt(distance[some].min())), float(np.sqrt(distance[some].max()))
                child[node][side] = grow(rest[some])
        return node

    if len(centre):
        grow(np.arange(len(centre)))
    return Tree(centre, np.array(number, np.int64), np.array(child, np.int64).reshape(-1, 2), np.array(near).reshape(-1, 2), np.array(far).reshape(-1, 2))


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and the squared distance to it of every row, and how many nodes were opened in all."""
    n, opened = len(vectors), 0
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.full(n, -1, np.int64)
    # the lower bound of every open node of every vector; infinite where it is not open
    open_at = np.full((n, len(tree.number)), np.inf)
    open_at[:, :1] = 0.0
    going = np.arange(n)
    while len(going):
        node = open_at[going].argmin(axis=1)
        bound = open_at[going, node]
        radius = np.where(cluster[going] < 0, np.inf, np.sqrt(best[going].astype(float)) * (1 + 1e-9) + 1e-6)
        within = (bound <= radius) & np.isfinite(bound)
        going, node, bound = going[within], node[within], bound[within]
        opened += len(going)
        open_at[going, node] = np.inf
        number = tree.number[node]
        square = squares(vectors[going], tree.centre[number])
        better = (square < best[going]) | (square == best[going]) & (number < cluster[going])
        best[going[better]], cluster[going[better]] = square[better], number[better]
        distance = np.sqrt(square.astype(float))
        for side in (0, 1):
            child = tree.child[node, side]
            has = child >= 0
            low = np.maximum(tree.near[node, side] - distance, distance - tree.far[node, side])
            open_at[going[has], child[has]] = np.maximum(low, bound)[has]
    return cluster, best, opened


def _rows(batch: pa.RecordBatch, column: str, width: int, most: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, most):
        part = batch.slice(at, most)
        yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def assign(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(astuple(build(centre)))  # k vectors
    width = centre.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, v in _rows(batch, "v", width):
                cluster, distance, _ = nearest(Tree(*shared.value), v)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centre: np.ndarray) -> np.ndarray:
    """The centroids after a round."""
    shared = vectors.sparkSession.sparkContext.broadcast(astuple(build(centre)))
    k, width = centre.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a component is below 2**27, so 2**36 vectors of a task are summed within 64 bits
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, v in _rows(batch, "v", width):
                cluster, _, _ = nearest(Tree(*shared.value), v)
                np.add.at(sums, cluster, v)
                counts += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(counts)
        if len(held):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(held, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(held))), pa.array(sums[held].ravel()), pa.array(np.repeat(counts[held], width))],
                names=["cluster", "place", "total", "n"],
            )

    parts = vectors.select("v").mapInArrow(run, "cluster int, place int, total long, n long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    out = centre.copy()
    for r in parts.groupBy("cluster", "place").agg(*exact).collect():  # k * width rows
        out[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return out


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, salt: str = "1:") -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance, cluster_inertia and inertia of every vector, and the centroids."""
    vectors = stage(vectors, "whole-vectors")
    centre = first_centroids(vectors, k, salt)
    if not len(centre):
        nothing = vectors.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")))
        return nothing, centre
    for _ in range(rounds):
        centre = moved(vectors, centre)
    placed = stage(assign(vectors, centre), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    by = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(total).collect()}  # at most k rows
    whole = sum(by.values())
    if whole >= 1 << 63:
        raise OverflowError("the inertia does not fit a long")
    own = per_cluster([by.get(i, 0) for i in range(len(centre))], "long")
    return placed.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(whole).cast("long").alias("inertia")), centre


def per_cluster(values: list, kind: str) -> Column:
    """A value for the row's cluster, from one value for each centroid."""
    return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)


def digests(centre: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre.tolist()]


def cluster_vectors(table: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0, **columns) -> DataFrame:
    """`clustered` with the SHA-256 of each row's centroid."""
    found, centre = clustered(whole_vectors(table, width, scale, **columns), k, rounds)
    sha = per_cluster(digests(centre), "string") if len(centre) else F.lit("")
    return found.withColumn("centroid_sha256", sha)


def _sql(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> str:
    steps = [f"""
vecs AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
),
c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, v) - 1 AS INTEGER) AS cluster, v AS c
    FROM (SELECT * FROM vecs ORDER BY sha256('1:' || vec_id), vec_id, v LIMIT {k})
)"""]
    for i in range(rounds + 1):
        steps.append(f"""
far{i} AS (
    SELECT row, vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM vecs, c{i}
),
a{i} AS (SELECT * FROM far{i} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (
    SELECT cluster, place, sum(x)::HUGEINT AS s, count(*) AS n
    FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY cluster, place
),
m{i} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c FROM s{i} GROUP BY cluster
),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",".join(steps) + f"""
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


#: The same result in SQL, from all distances.
SQL = _sql()
