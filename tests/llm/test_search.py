"""Exact top-k (op 5) and the language model (op 10)."""

import collections
import math
import zlib

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from rollcall.llm import knn, lm, queries
from rollcall.llm.eliasfano import Monotone, Trie


def test_top_k_query_against_sql(spark, tables):
    assert spark_rows(queries.op5_voronoi_top_k(spark, tables)) == duck_rows(connect(tables), queries.ORACLES["op5_voronoi_top_k"])


def plain_top_k(rows, k):
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in rows if i % 10 == 0}):
        scored = sorted((-int(np.dot(np.array(v, object), np.array(w, object))), i) for i, w in rows if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"pivots": 5, "group_rows": 3, "block_rows": 7}, {"pivots": 1}])
@pytest.mark.parametrize("scale", [1, 10**6])
def test_top_k_blocks_ties_and_clusters(spark, how, scale):
    rng = np.random.default_rng(2)
    base = rng.integers(-3, 4, (6, 5)) * scale
    rows = [(i, (base[i % 6] + (0 if i % 4 else rng.integers(-1, 2, 5))).tolist()) for i in range(130)]
    table = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = knn.top_k(table, F.col("vec_id") % 10 == 0, k=7, **how).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top_k(rows, 7)


@pytest.mark.parametrize("own", [2, 10, 11, 40, 300])
def test_ids_that_repeat(spark, own):
    """One query's id is on many rows of a tight cell, as others are in cells of their own."""
    rows = [(0, [1000 + i % 2, 0, 0]) for i in range(own)] + [(i, [10 * (i % 7) - 30, 5 * (i % 3), i % 2]) for i in range(1, 31)]
    rows += [(10, [0, 0, 900])] * 12
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 10 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(plain_top_k(rows, 10))


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-9, 10, (2, 3, 3, 5)[i % 4]).tolist()) for i in range(90)] + [(200, []), (210, [4] * 7), (0, [1, 1, 1])]
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 10 == 0, k=4).collect()
    want = [x for n in (2, 3, 5, 7) for x in plain_top_k([(i, v) for i, v in rows if len(v) == n], 4)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want) and {r.query_id for r in got} == set(range(0, 90, 10))


def test_far_cells_are_not_sent(spark):
    """Two clusters far apart: the bounds leave each query's own cell only."""
    rows = [(i, [1000 + i % 3, 0, 0] if i % 2 else [-1000 - i % 3, 0, 0]) for i in range(60)]
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 10 == 0, k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top_k(rows, 3)


def test_products_beyond_floating_point():
    a = np.array([[2**40 + 1, 3]])
    with pytest.raises(OverflowError):  # 2**80 does not fit
        knn._products(a, a)
    b = np.array([[2**30 + 1, 1]])
    assert knn._products(b, b)[0, 0] == (2**30 + 1) ** 2 + 1


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.25, -1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]),
        (6, [1.0]), (None, [1.0, 1.0]), (7, [-0.0005, 2.0]), (100, [0.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cell int, rank int")
    whole = {(r.vec_id, tuple(r.v)) for r in knn.whole_vectors(table).collect()}
    assert (7, (-1, 2048)) in whole and not {2, 3, 4, 5} & {i for i, _ in whole}
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in knn.top_k(knn.whole_vectors(table), F.col("vec_id") % 100 == 0).collect())
    assert got == sorted(
        [(0, 1, 7, -1024 + 512 * 2048), (0, 2, 100, 0), (0, 3, 1, 256 * 1024 - 1024 * 512)] + [(100, k + 1, i, 0) for k, i in enumerate([0, 0, 1, 7])]
    )
    assert knn.top_k(knn.whole_vectors(table.filter("vec_id < 0")), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize(("n", "top"), [(1, 1), (1, 10**12), (700, 40), (700, 10**10)])
def test_monotone(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    e = Monotone.encode(values)
    m = Monotone(e["upper"], e["low"], *map(int, e["shape"]))
    assert (m.access(np.arange(n)) == values).all()
    x = rng.integers(0, top + 3, 500)
    assert (m.find(x) == np.searchsorted(values, x)).all()


def test_trie(tmp_path):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 400 * 900, 3000))
    context, successor, p = keys // 900, keys % 900, rng.random(len(keys))
    Trie.write(str(tmp_path), context, successor, p)
    trie = Trie(str(tmp_path))
    asked = np.arange(400 * 900)
    codes = trie.codes_of(asked // 900, asked % 900)
    assert ((codes != 65535) == np.isin(asked, keys)).all()
    assert np.abs(np.log10(Trie.probability(codes[keys]) / p)).max() <= Trie.STEP / 2 + 1e-12
    Trie.write(str(tmp_path), keys[:0], keys[:0], p[:0])
    assert (Trie(str(tmp_path)).codes_of(asked[:5], asked[:5]) == 65535).all()


def plain_scores(rows, smoothing=100.0):
    split = [(i, t.encode().lower().split() + [b""]) for i, t in rows]
    train = [w for i, w in split if (zlib.crc32(str(i).encode()) % 5 if i is not None else 0) != 1]
    one = collections.Counter(w for words in train for w in words)
    two = collections.Counter(p for words in train for p in zip([None, *words], words, strict=False))
    n, v = sum(one.values()), len(one)
    one[None] = len(train)
    found = []
    for i, words in split:
        p = [(one[w] + 0.5) / (n + 0.5 * (v + 1)) for w in words]
        whole = [(two[a, b] + smoothing * x) / (one[a] + smoothing) for a, b, x in zip([None, *words], words, p, strict=False)]
        found.append((i, len(words), sum(one[w] > 0 for w in words), n, sum(map(math.log10, p)), sum(map(math.log10, whole))))
    return found


def check_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9)
        assert a[5] == pytest.approx(b[5], abs=Trie.STEP * a[1])


def test_scores_against_plain_counts(spark, tables, texts_of):
    rows = queries.op10_elias_fano_lm(spark, tables).collect()
    check_scores(rows, plain_scores(texts_of))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_chunks_and_odd_documents(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs, chunk_tokens=50).collect()
    check_scores(rows, plain_scores([(r.doc_id, r.text or "") for r in odd_docs.collect()]))
    assert lm.score_documents(no_docs).count() == 0


def test_nothing_to_learn_from(odd_docs):
    rows = lm.score(odd_docs, F.lit(False)).collect()
    assert {r.train_tokens for r in rows} == {0} and all(r.score <= 0 for r in rows)
