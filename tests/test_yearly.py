"""Marts kept up year by year against marts made whole."""

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from rollcall.catalogue import samples
from rollcall.operators import changes, marts, slices
from rollcall.plans import yearly
from rollcall.sources import commits


def whole(rows):
    made = {**marts.median_marts(rows), **{name: build(rows) for name, build in yearly.SIMPLE.items()}}
    for mart, (delta, keys) in yearly.DELTAS.items():
        made[delta] = slices.kpi_delta(made[mart], keys)
    return made


def check(spark, target, rows):
    for name, df in whole(rows).items():
        assert spark_rows(yearly.read_mart(spark, target, name)) == spark_rows(df), name


def test_years_that_change_come_and_go(spark, tables, tmp_path):
    rows, target = samples.silver(spark, tables), f"file:{tmp_path}/marts"
    years = sorted(r[0] for r in rows.select("election_year").distinct().collect())
    first = yearly.refresh_years(spark, rows, target).collect()
    assert {r.status for r in first} == {"new"} and {int(r.year) for r in first} == set(years)
    check(spark, target, rows)
    # nothing to do: no commit
    assert yearly.refresh_years(spark, rows.withColumn("_processed_at", F.current_timestamp()), target).count() == 0
    assert commits.newest(spark, target).number == 0
    # one year with other figures, for one state: that year, and the change of the year after it
    year, after = years[2], years[3]
    state = rows.filter((F.col("election_year") == year) & (F.col("state") != "")).first().state
    more = rows.withColumn("assets", F.when((F.col("election_year") == year) & (F.col("state") == state), F.col("assets") * 3).otherwise(F.col("assets")))
    second = yearly.refresh_years(spark, more, target).collect()
    assert {r.status for r in second} == {"updated"}
    deltas = {d for d, _ in yearly.DELTAS.values()}
    assert {int(r.year) for r in second if r.mart not in deltas} == {year}
    assert {year, after} <= {int(r.year) for r in second if r.mart in deltas} < set(years)
    check(spark, target, more)
    # a year goes, which makes the years before and after it neighbours; a state goes from another
    less = more.filter((F.col("election_year") != years[1]) & ~((F.col("election_year") == years[4]) & (F.col("state") == state)))
    third = {(r.mart, int(r.year)): r.status for r in yearly.refresh_years(spark, less, target).collect()}
    assert third["gold_state_trends", years[1]] == "removed" and third["gold_state_changes", years[2]] == "updated"
    check(spark, target, less)
    # a series that lacks a year: what follows is found across the gap
    yearly.refresh_years(spark, rows, target)
    check(spark, target, rows)


def test_changed_years_are_read_alone(spark, tables):
    rows = samples.silver(spark, tables)
    plan = marts.age_dist(rows.filter(yearly._same_year(["1995"])))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(election_year" in plan and "election_year#" in plan
    assert changes.content_hash(rows, ["election_year"]).count() > 1


def test_empty_table_and_rows_without_a_year(spark, tables, tmp_path):
    rows, target = samples.silver(spark, tables), f"file:{tmp_path}/marts"
    assert yearly.refresh_years(spark, rows.filter("election_year < 0"), target).count() == 0
    with pytest.raises(KeyError):
        yearly.read_mart(spark, target, "gold_age_dist")
    odd = rows.withColumn("election_year", F.when(F.col("election_year") != 1995, F.col("election_year")))
    yearly.refresh_years(spark, odd, target)
    check(spark, target, odd)
