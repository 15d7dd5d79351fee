"""Exact top-k by inner product as a Voronoi join (op 5).

Vectors become whole numbers and go to their nearest pivot. A summary holds, for each pivot, how many vectors it has and the
radius of its cell. For a query q and the cell of pivot p, every inner product lies within |q| * radius of q.p (Cauchy-
Schwarz). The cells with the highest lower bounds that hold k vectors together beside as many as carry the query's own id
give a score that the k-th best result cannot fall below; only cells whose upper bound reaches it can hold results, and only those are sent to the
group of queries. Groups of queries are cells put together, or parts of a cell, of about `group_rows` queries, and cells
are dealt out in blocks of about `block_rows` vectors by hash, so a crowded cell is many tasks. Each pair of a group and a
block is solved by one matrix product in whole numbers, and gives at most k rows for each query.

Pivots are `pivots` vectors picked by hash of their id (by default the square root of the number of rows, at least 64 and
at most 2048, so that cells do not outgrow the bounds); results do not depend on them.

Vectors that are null or empty or hold a null or non-finite component take no part, nor do those with a null id. Vectors
of several lengths are answered length by length, as a product needs two of the same: a query's results have its length. A query's own id is not among its results.
A score beyond 64 bits ends the query with an error.
Rows repeated with id and vector are one query, and as many candidates as rows. Ties go to the smaller id. Empty table: no rows.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import stage


def whole_vectors(table: DataFrame, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and `v` (array of long), floor(scale * component), of the vectors that take part."""
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("e")).filter(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull()
    )
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(F.coalesce(x, F.lit(0.0))) & (F.abs(F.coalesce(x, F.lit(0.0))) != float("inf")))
    rows = rows.filter(sound)
    return rows.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def _matrix(column: pd.Series | list, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(-1, width)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where every sum is below 2**53, else with whole numbers of any size."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = float(np.abs(left.astype(float)).max()) * float(np.abs(right.astype(float)).max()) * left.shape[1]
    if most < 2.0**53:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    return (left.astype(object) @ right.T.astype(object)).astype(np.int64)  # an OverflowError beyond 64 bits


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, pivots: int | None = None, group_rows: int = 4096, block_rows: int = 8192
) -> DataFrame:
    """query_id, rank, vec_id, score; `is_query` is a condition on vec_id."""
    schema = "query_id long, rank int, vec_id long, score long"
    # one row for each length
    lengths = sorted((r["n"], r["count"]) for r in vectors.filter(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().collect())
    found = [_of_length(vectors.filter(F.size("v") == n), n, is_query, k, pivots or min(2048, max(64, math.isqrt(rows))), group_rows, block_rows) for n, rows in lengths]
    return functools.reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], schema)


def _of_length(same: DataFrame, width: int, is_query: Column, k: int, pivots: int, group_rows: int, block_rows: int) -> DataFrame:
    """`top_k` of vectors that all have `width` components."""
    chosen = same.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    centre = np.unique(np.array([r["v"] for r in chosen], float), axis=0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (centre**2).sum(axis=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                v = part.column(1).flatten().to_numpy().reshape(-1, width)
                x = v.astype(float)
                near = (x @ centre.T * 2 - square).argmax(axis=1)
                far = np.sqrt(((x - centre[near]) ** 2).sum(axis=1))
                data = [r.tobytes() for r in np.ascontiguousarray(v, np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(data, pa.binary()), pa.array(near.astype(np.int32)), pa.array(far)],
                    names=["vec_id", "v", "cell", "far"],
                )

    placed = stage(same.mapInArrow(assign, "vec_id long, v binary, cell int, far double").withColumn("is_query", is_query), "cells")
    # one row for each pivot
    summary = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("vec_id").alias("n"), F.max("far").alias("radius")).collect()}
    size = np.array([summary[c]["n"] if c in summary else 0 for c in range(len(centre))])
    radius = np.array([summary[c]["radius"] if c in summary else 0.0 for c in range(len(centre))])
    blocks = np.maximum(1, -(-size // block_rows))
    queries = placed.filter("is_query").select("vec_id", "v", "cell").distinct()
    # how many rows carry a query's id: these are not among its results
    own_rows = stage(placed.filter("is_query").groupBy(F.col("vec_id").alias("its_id")).agg(F.count(F.lit(1)).alias("own_rows")), "rows-of-query-ids")
    asked = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    group_of, parts_of, group, held = [0] * len(centre), [1] * len(centre), 0, 0
    # neighbouring cells share a group: in the order of their distance from the first pivot
    for c in np.argsort(((centre - centre[0]) ** 2).sum(axis=1), kind="stable").tolist():
        n = asked.get(c, 0)
        if held and held + n > group_rows:
            group, held = group + 1, 0
        group_of[c], parts_of[c] = group, max(1, -(-n // group_rows))
        held += n
        if parts_of[c] > 1:
            group, held = group + parts_of[c], 0

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its group, the score it must reach, and the cells that can."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                q = _matrix(part.column("v").to_pylist(), width).astype(float)
                middle = q @ centre.T
                reach = np.sqrt((q**2).sum(axis=1))[:, None] * radius[None, :] + 1e-9 * np.abs(middle) + 1
                low, high = middle - reach, middle + reach
                order = np.argsort(-low, axis=1, kind="stable")
                enough = np.cumsum(size[order], axis=1) >= k + part.column("own_rows").to_numpy()[:, None]
                at_least = np.where(enough.any(axis=1), np.take_along_axis(low, order, 1)[np.arange(len(q)), enough.argmax(axis=1)], -np.inf)
                needed = (high >= at_least[:, None]) & (size > 0)[None, :]
                ids = part.column("vec_id").to_numpy()
                cells = part.column("cell").to_numpy()
                groups = [group_of[c] + zlib.crc32(int(i).to_bytes(8, "little", signed=True)) % parts_of[c] for i, c in zip(ids, cells, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("v"), pa.array(groups, pa.int32()), pa.array(at_least), pa.array([np.flatnonzero(x) for x in needed], pa.list_(pa.int32()))],
                    names=["query_id", "v", "part", "at_least", "cells"],
                )

    bounded = stage(
        queries.join(own_rows, F.col("vec_id") == F.col("its_id")).drop("its_id").mapInArrow(bound, "query_id long, v binary, part int, at_least double, cells array<int>"), "bounded-queries"
    )
    n_blocks = F.element_at(F.array(*(F.lit(int(b)) for b in blocks)), F.col("cell") + 1)
    wanted = bounded.select("part", F.explode("cells").alias("cell")).distinct()
    sent = wanted.select("part", "cell", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
    asking = bounded.select("part", "query_id", "v", "at_least").join(sent, "part")
    data = placed.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id", "v"), n_blocks).cast("int").alias("block")).join(wanted, "cell")
    data = data.select("vec_id", "v", *(F.col(c).alias(f"its_{c}") for c in ("part", "cell", "block")))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("vec_id", kind="stable")
        own = right.vec_id.to_numpy()
        x = _matrix(right.v, width)
        out = []
        for at in range(0, len(left), 512):
            some = left.iloc[at : at + 512]
            scores = _products(_matrix(some.v, width), x)
            for query_id, v, least, row in zip(some.query_id, some.v, some.at_least, scores, strict=True):
                can = np.flatnonzero((row >= least) & (own != query_id))
                if len(can) > k:
                    edge = np.partition(row[can], len(can) - k)[len(can) - k]
                    can = can[row[can] >= edge]
                    can = can[np.argsort(-row[can], kind="stable")][:k]
                out.append(pd.DataFrame({"query_id": query_id, "v": v, "vec_id": own[can], "score": row[can]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "v": [], "vec_id": [], "score": []})

    keys = ["part", "cell", "block"]
    found = asking.groupBy(*keys).cogroup(data.groupBy(*(f"its_{c}" for c in keys))).applyInPandas(solve, "query_id long, v binary, vec_id long, score long")
    best = W.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
