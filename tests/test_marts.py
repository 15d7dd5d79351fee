"""Invariants of silver and the marts."""

import pytest
from pyspark.sql import functions as F

from rollcall.catalogue import samples
from rollcall.functions import lookups
from rollcall.operators import conform, marts, quality, slices


@pytest.fixture(scope="module")
def silver(spark, tables):
    return samples.silver(spark, tables)


def test_groups_add_up(silver):
    total = silver.count()
    national = marts.national_trends(silver)
    per_cohort = dict(national.groupBy("cohort").agg(F.sum("n")).collect())
    assert per_cohort[lookups.ALL_CANDIDATES] == total
    assert per_cohort[lookups.WINNERS] == silver.filter("is_winner").count()
    for mart in (marts.age_dist(silver), marts.education_dist(silver)):
        assert mart.agg(F.sum("candidates")).first()[0] == total
    named = silver.filter("state <> ''").count()
    states = marts.state_trends(silver).filter(F.col("cohort") == lookups.ALL_CANDIDATES)
    assert states.agg(F.sum("n")).first()[0] == named
    assert marts.age_by_state(silver).agg(F.sum("candidates")).first()[0] == named


def test_leaderboards_are_limited_before_the_shuffle(silver):
    text = marts.top_n(silver, "assets", "x")._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_party_groups(spark):
    rows = spark.createDataFrame(
        [(2004, p, w) for p, w in [("A", True)] * 5 + [("B", True)] * 4 + [("IND", True)] * 9 + [("UNKNOWN", False)]]
        + [(2009, "B", True)],
        "election_year int, party string, is_winner boolean",
    )
    groups = dict(conform.party_group(rows, conform.qualifying_labels(rows)).select("party", "party_group").distinct().collect())
    assert groups == {"A": "A", "B": "Other parties", "IND": "Independent", "UNKNOWN": "Other parties"}
    assert conform.qualifying_labels(rows, 4).count() == 3


def test_special_contests(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, is_bye_election boolean")
    assert sorted(r.i for r in conform.general_only(rows).collect()) == [2, 3]


REPEAT = "name string, state string, election_year int, assets long, is_winner boolean, criminal_cases int, candidate_id long"


def test_repeat_entities(spark):
    rows = spark.createDataFrame(
        [
            ("A. Rao", "S", 2004, 100, True, 1, 1),
            ("A Rao", "S", 2004, 300, False, 7, 2),
            ("A RAO", "S", 2009, 150, True, 2, 3),
            ("A Rao", "T", 2009, 150, True, 2, 4),
            ("Z", "S", 2004, 0, False, 0, 5),
            ("Z", "S", 2009, 5, False, 0, 6),
            ("N", "S", 2004, None, False, 0, 7),
            ("N", "S", 2009, 5, False, 0, 8),
        ],
        REPEAT,
    )
    found = {r.name: r.asDict() for r in marts.repeat_entities(rows).collect()}
    assert set(found) == {"A RAO", "Z"}
    rao = found["A RAO"]
    assert (rao["min_assets"], rao["max_assets"], rao["asset_growth_pct"]) == (300, 150, -50.0)
    assert (rao["elections_contested"], rao["elections_won"], rao["peak_cases"]) == (2, 1, 7)
    assert found["Z"]["asset_growth_pct"] is None


def test_repeat_entities_with_a_common_name(spark):
    common = spark.range(9000).select(
        F.lit("Ram Singh").alias("name"), F.lit("S").alias("state"), (2004 + F.col("id") % 3 * 5).cast("int").alias("election_year"),
        F.col("id").alias("assets"), F.lit(False).alias("is_winner"), F.lit(0).alias("criminal_cases"), F.col("id").alias("candidate_id"),
    )
    row = marts.repeat_entities(common).first()
    assert (row.elections_contested, row.min_assets, row.max_assets) == (3, 8997, 8999)


def test_gate(spark):
    rows = spark.createDataFrame([(2004, True, 1, "S", 5), (2004, False, 1, "S", None)], "election_year int, is_winner boolean, constituency_id int, state string, assets long")
    bad = quality.completeness_violations(rows)
    assert bad.first().broken_rules == "winners,candidates"
    with pytest.raises(ValueError, match="truncated"):
        quality.require(bad, "looks truncated")
    quality.require(quality.completeness_violations(rows, 1, 2), "fine")


def test_missing_slices(spark):
    rows = spark.createDataFrame([("A", 2004), ("A", 2009), ("B", 2009), ("", 2004)], "state string, election_year int")
    years = quality.election_years(rows)
    assert [tuple(r) for r in slices.missing_slices(rows, years).collect()] == [("B", 2004)]
    assert years.first().years == [2004, 2009]


def test_sort_puts_nulls_last_both_ways(spark):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in slices.sort_view(rows, "v").collect()] == [1, 3, None]
    assert [r.v for r in slices.sort_view(rows, "v", True).collect()] == [3, 1, None]


TREND = "cohort string, election_year int, n long, pct_criminal double, pct_crorepati double, median_assets long, avg_age double, pct_graduate_plus double"


def test_series_queries(spark):
    won, every = lookups.WINNERS, lookups.ALL_CANDIDATES
    rows = spark.createDataFrame(
        [
            (won, 2004, 5, 20.0, 10.0, 100, 50.0, 1.0), (won, 2014, 5, 30.5, 11.0, 2500, 51.0, 1.0), (won, 2019, 5, 10.0, 12.0, None, 51.0, 1.0),
            (every, 2004, 9, 10.0, 1.0, 50, 45.0, 1.0), (every, 2014, 9, 10.0, 2.0, 1000, 46.0, 1.0),
        ],
        TREND,
    )
    delta = {(r.cohort, r.election_year): r for r in slices.kpi_delta(rows, ["cohort"]).collect()}
    assert (delta[won, 2014].previous_year, delta[won, 2014].pct_criminal_change) == (2004, 10.5)
    assert delta[won, 2004].previous_year is None
    insight = {r.cohort: r for r in slices.trend_insights(rows, ["cohort"]).collect()}
    assert (insight[won].direction, insight[won].asset_multiple) == ("down from", None)
    assert (insight[every].direction, insight[every].asset_multiple) == ("down from", 20.0)
    premium = slices.cohort_premium(rows, []).first()
    assert (premium.median_year, premium.premium) == (2014, 2.5)
    # the winners' latest share is of 2019, where the field has none
    assert premium.pct_crorepati_year is None
    later = rows.union(spark.createDataFrame([(every, 2019, 9, 10.0, 3.0, 1000, 46.0, 1.0)], TREND))
    premium = slices.cohort_premium(later, []).first()
    assert (premium.pct_crorepati_year, premium.winner_pct_crorepati, premium.field_pct_crorepati) == (2019, 12.0, 3.0)
    assert (premium.median_year, premium.winner_median) == (2014, 2500)
