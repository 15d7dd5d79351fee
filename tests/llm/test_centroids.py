"""Centroid clustering (op 12)."""

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows

from rollcall.llm import centroids as ce, queries


def test_query_against_sql(spark, tables):
    assert spark_rows(queries.op12_vantage_point_clusters(spark, tables)) == duck_rows(connect(tables), ce.SQL)


@pytest.mark.parametrize(("k", "width", "spread"), [(1, 2, 5), (2, 1, 3), (16, 64, 200), (300, 3, 6), (300, 3, 100_000_000)])
def test_search_against_all_distances(k, width, spread):
    rng = np.random.default_rng(k)
    centre, rows = rng.integers(-spread, spread + 1, (k, width)), rng.integers(-spread, spread + 1, (2000, width))
    centre[-1] = centre[0]  # a tie that the smaller number wins
    rows[:k] = centre
    square = ((rows[:, None] - centre[None]) ** 2).sum(axis=-1)
    cluster, distance, opened = ce.nearest(ce.build(centre), rows)
    assert (cluster == square.argmin(axis=1)).all() and (distance == square.min(axis=1)).all()
    if k == 300:
        assert opened < 2000 * k / 4  # the bounds leave most nodes shut


def plain(rows, k, rounds, salt="1:"):
    import hashlib

    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    centre = [list(v) for _, v in order[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centre)) for _, v in rows]

    for _ in range(rounds):
        placed = place()
        for i in range(len(centre)):
            own = [v for (_, v), (_, c) in zip(rows, placed, strict=True) if c == i]
            if own:
                centre[i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    placed = place()
    total = sum(d for d, _ in placed)
    by = {i: sum(d for d, c in placed if c == i) for i in range(k)}
    sha = ce.digests(np.array(centre))
    return sorted(((r[0], c, d, by[c], total, sha[c]) for r, (d, c) in zip(rows, placed, strict=True)), key=repr)


def test_ties_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 90) if i % 17 else None, rng.integers(-4, 5, 3).tolist()) for i in range(400)] + [(500, [1, 1, 1])] * 300
    table = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    found, centre = ce.clustered(table, k=9, rounds=2)
    sha = ce.per_cluster(ce.digests(centre), "string")
    got = found.withColumn("sha", sha).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "sha").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 9, 2)


def test_vectors_that_take_part(spark):
    good = [0.5, -0.25]
    rows = [(1, good, "x"), (2, None, "x"), (3, [0.5], "x"), (4, [0.5, None], "x"), (5, [0.5, float("nan")], "x"), (6, [float("inf"), 0.5], "x"), (None, good, "x"), (1, good, "x"), (7, [], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string")
    got = ce.cluster_vectors(table, k=4, rounds=1, width=2).collect()
    assert sorted((r.vec_id or -1, r.cluster, r.distance) for r in got) == [(-1, 0, 0), (1, 0, 0), (1, 0, 0)]
    assert [r.v for r in ce.whole_vectors(table, 2).collect()] == [[32, -16]] * 3
    assert ce.cluster_vectors(table.filter("vec_id = 2")).collect() == []


def test_components_beyond_the_range(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        ce.cluster_vectors(table, width=2).collect()
