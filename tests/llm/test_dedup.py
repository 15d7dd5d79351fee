"""SimHash near-duplicates (op 8) and line chunks (op 9)."""

from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import connect, duck_rows, spark_rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollcall.llm import linededup, queries, simhash, stages


def plain_fingerprint(text, size=3):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_against_all_pairs(spark, tables, texts_of):
    got = {r.doc_id: r for r in queries.op8_simhash_pigeonring(spark, tables).collect()}
    fps = [plain_fingerprint(t) for _, t in texts_of]
    assert [got[d].fingerprint for d, _ in texts_of] == [f"{f:016x}" for f in fps]
    assert [got[d].component_id for d, _ in texts_of] == plain_components([d for d, _ in texts_of], fps)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=7), st.integers(1, 6), st.integers(1, 4))
def test_linked_fingerprints_share_a_key(a, flips, max_bits, depth):
    b = a
    for f in flips[:max_bits]:
        b ^= 1 << f
    masks, chains = simhash.ring_masks(max_bits, depth)
    shared = [k for k, m in enumerate(masks) if a & m == b & m]
    assert any(all(((a ^ b) & c).bit_count() <= n for n, c in enumerate(chains[k])) for k in shared)


@pytest.mark.parametrize("max_bits", [1, 3, 5])
def test_dense_groups(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    fps = [int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for c in rng.integers(0, 2**63, 6) for _ in range(60)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    links = simhash.edges(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits)
    found = {r.node: r.root for r in simhash.contract(links).collect()}
    want = plain_components(fps, [f % (1 << 64) for f in fps], max_bits)
    assert [min(g for g in fps if found.get(g, g) == found.get(f, f)) for f in fps] == want


def test_long_chain(spark):
    """A path of links, none of which joins its ends directly."""
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "src long, dst long")
    assert {r.root for r in simhash.contract(chain).collect()} == {0}
    assert simhash.contract(chain.filter("src < 0")).count() == 0


def test_odd_documents(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    source = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    want = plain_components([d for d, _ in source], [plain_fingerprint(t) for _, t in source])
    assert Counter((r.doc_id, r.component_id) for r in rows) == Counter(zip([d for d, _ in source], want, strict=True))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_line_query_against_sql(spark, tables):
    con = connect(tables)
    assert spark_rows(queries.op9_line_chunks(spark, tables)) == duck_rows(con, queries.ORACLES["op9_line_chunks"])
    assert queries.op9_line_chunks(spark, tables).agg(F.sum("n_removed")).first()[0] > 0


def test_line_plan_has_no_python(spark, tables):
    plan = queries.op9_line_chunks(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_shared_passage_is_removed_once(spark):
    passage = "\n".join(f"this is line number {i} of a passage that many documents share" for i in range(30))
    rows = [(i, f"own first line {i}\n{passage}\nown last line {i}") for i in range(20)]
    kept = {r.doc_id: r.kept_text for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept[0] == rows[0][1]
    for i in range(1, 20):
        assert f"own first line {i}" in kept[i] and f"own last line {i}" in kept[i]
        assert kept[i].count("\n") < 12  # a few lines at either end share a chunk with the document's own


def test_one_long_line_is_removed(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"alpha {i}\nbeta {i}\n{line}\ngamma {i}") for i in range(4)]
    kept = {r.doc_id: r.kept_text for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [line in kept[i] for i in range(4)] == [True, False, False, False]


def test_line_odd_documents(odd_docs, no_docs):
    found = linededup.line_dedup(odd_docs)
    assert found.columns == [*(c for c in odd_docs.columns if c != "n_removed"), "kept_text", "n_chunks", "n_removed"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.kept_text is None and r.n_chunks == 0 for r in rows if r.text is None)
    assert all(r.kept_text == r.text for r in rows if r.n_removed == 0)
    assert linededup.line_dedup(no_docs).count() == 0


@pytest.mark.parametrize("n", range(2, 11))
def test_short_passages_are_removed_whole(spark, n):
    """Lines under 50 words each, amid unlike lines; each passage holds 50 words or more."""
    rng = np.random.default_rng(n)
    line = lambda size: " ".join(f"w{x}" for x in rng.integers(0, 10**9, size))
    sizes = [[49, 1, *[3] * (n - 2)] if k % 3 == 0 else [-(-50 // n)] * n if k % 3 == 1 else [1, *[2] * (n - 2), 49] for k in range(12)]
    passages = ["\n".join(map(line, s)) for s in sizes]
    rows, want = [], {}
    for i in range(36):
        before, after = "\n".join(line(9) for _ in range(i % 4 + 1)), "\n".join(line(9) for _ in range(i % 3 + 1))
        rows.append((i, f"{before}\n{passages[i % 12]}\n{after}"))
        want[i] = rows[i][1] if i < 12 else f"{before}\n{after}"
    found = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.kept_text for r in found} == want


def test_runs_that_repeat_in_one_text(spark):
    """Each document keeps the first place of a run whole, also where the next one overlaps it; blank lines go with a run."""
    same, long = "ten words " * 5, " ".join(f"v{i}" for i in range(30))
    rows = [(1, "\n".join(["a", *[same.strip()] * 9, "b"])), (2, f"c\n{long}\n\n{long} x\nd"), (None, f"e\n{long}\n\n{long} x\nf"), (3, "g\nh")]
    found = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = {r.doc_id: r.kept_text for r in found}
    assert kept == {1: "\n".join(["a", *[same.strip()] * 5, "b"]), 2: rows[1][1], None: "e\nf", 3: "g\nh"}


def test_pipeline_stage_removes_short_passages(spark):
    from rollcall.llm import stages

    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(18)) for i in range(3))
    docs = spark.createDataFrame([(i, f"first {i}\n{passage}\nlast {i}", 7) for i in range(9)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in stages.line_dedup(spark, docs, "").collect()}
    assert got[0][0].count("\n") == 4 and all(got[i] == (f"first {i}\nlast {i}", len(f"first {i}\nlast {i}")) for i in range(1, 9))
