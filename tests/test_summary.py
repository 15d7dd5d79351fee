"""The exact median against Python's."""

import math
import random
import statistics
from fractions import Fraction

import pytest

from rollcall.operators import ranks
from rollcall.operators.ranks import exact_quantiles
from rollcall.operators.summary import exact_median


def wanted(values, kind):
    held = sorted(v for v in values if v is not None)
    if not held:
        return None
    return statistics.median_low(held) if kind == "lower" else int(statistics.median(held))


@pytest.mark.parametrize("kind", ["lower", "interp"])
@pytest.mark.parametrize("part_bits", [24, 3])
def test_median(spark, monkeypatch, kind, part_bits):
    monkeypatch.setattr(ranks, "PART_BITS", part_bits)
    rng = random.Random(7)
    groups = {
        "hot": [rng.choice([0, 0, 0, 5, 7 * 10**6, rng.randrange(10**9)]) for _ in range(4000)],
        "even": [1, 2, 3, 100],
        "negative": [-5, -4, 3, None, -10**7, 10**7],
        "one": [42],
        "none": [None, None],
        "near": [10**8 + i for i in range(1001)],
        "huge": [9 * 10**18 - i for i in range(501)] + [10**15 + 7 * i for i in range(500)],
        None: [9, 8, 7],
    }
    rows = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v long")
    got = dict(exact_median(rows.repartition(8), ["k"], "v", kind).collect())
    assert got == {k: wanted(vs, kind) for k, vs in groups.items()}


def test_bad_kind(spark):
    rows = spark.createDataFrame([(1, 2)], "k int, v long")
    with pytest.raises(ValueError):
        exact_median(rows, ["k"], "v", "upper")


@pytest.mark.parametrize("resolution", [256, 2])
def test_quantiles_of_any_share(spark, monkeypatch, resolution):
    """Also where buckets are so wide that one holds several asked ranks and most of a group."""
    monkeypatch.setattr(ranks, "RESOLUTION", resolution)
    rng = random.Random(3)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    groups = {("a", 1): [rng.randrange(1000) for _ in range(3001)], ("a", 2): [7] * 500 + [None] * 9, (None, 1): [rng.randrange(-50, 10**12) for _ in range(999)], ("b", 1): [None], ("c", None): [1, 2]}
    rows = [(*k, v) for k, vs in groups.items() for v in vs]
    got = exact_quantiles(spark.createDataFrame(rows, "k string, j int, v long").repartition(6), ["k", "j"], "v", shares).collect()
    assert len(got) == len(groups)
    for r in got:
        held = sorted(v for v in groups[r.k, r.j] if v is not None)
        assert r.n == len(held)
        assert r.quantiles == [held[max(math.ceil(Fraction(str(s)) * len(held)), 1) - 1] if held else None for s in shares]


def test_bad_share(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.createDataFrame([(1, 2)], "k int, v long"), ["k"], "v", [1.5])


def test_marts_together_and_apart(spark, tables, tmp_path):
    """Five marts from one lattice equal those built alone, and the table is scanned twice."""
    from rollcall.catalogue import samples
    from rollcall.operators import marts

    silver = samples.silver(spark, tables)
    together = marts.median_marts(silver)
    alone = {
        "gold_national_trends": marts.national_trends, "gold_party_summary": marts.party_summary, "gold_state_summary": marts.state_summary,
        "gold_state_trends": marts.state_trends, "gold_party_state": marts.party_by_state,
    }
    assert set(together) == set(alone)
    for name, build in alone.items():
        one = build(silver)
        assert one.columns == together[name].columns
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, together[name].collect()), key=repr)
