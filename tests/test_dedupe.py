from pyspark.sql import functions as F

from rollcall.operators import changes, dedupe


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_limited_before_the_shuffle(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 1000).alias("v"), "id"
    )
    best = dedupe.keep_best(rows, ["k"], [F.col("v").desc(), F.col("id").asc()])
    assert "WindowGroupLimit" in plan(best).split("Exchange")[1]
    assert best.count() == 20001
    hot = best.filter("k = 0").first()
    assert (hot.v, hot.id) == (999, 1857)


def test_dedupe_keeps_largest_and_groups_null_keys(spark):
    columns = "election_year int, constituency_id int, candidate_id long, name string, assets long, liabilities long, criminal_cases int, is_winner boolean, party string"
    rows = spark.createDataFrame(
        [
            (2004, 1, None, "A", 5, 0, 0, False, "P"),
            (2004, 1, None, "A", 9, 0, 0, False, "P"),
            (2004, 1, None, "A", None, 0, 0, False, "P"),
            (2004, 1, 3, "A", None, 0, 0, False, "P"),
            (2009, 1, 3, "A", 1, 0, 0, False, "P"),
        ],
        columns,
    )
    once = dedupe.dedupe_candidates(rows)
    assert sorted((r.election_year, r.candidate_id or 0, r.assets) for r in once.collect()) == [(2004, 0, 9), (2004, 3, None), (2009, 3, 1)]
    assert once.exceptAll(dedupe.dedupe_candidates(once)).count() == 0
    assert dedupe.dedupe_report(rows, dedupe.CANDIDATE_KEY).first().asDict() == {"rows_in": 5, "rows_out": 3, "rows_dropped": 2}
    assert dedupe.dedupe_report(rows.limit(0), dedupe.CANDIDATE_KEY).first().rows_dropped == 0


def test_funded_row_is_kept(spark):
    rows = spark.createDataFrame(
        [("S", "a", 1, "x", None, 9), ("S", "a", 2, "y", 10, None), ("S", "b", 3, "z", None, None)],
        "state string, constituency string, mp_id int, mp_name string, allocated long, expenditure long",
    )
    assert sorted(r.mp_id for r in dedupe.dedupe_funded(rows).collect()) == [2, 3]


def test_snapshot_diff(spark):
    columns = "k int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, "p", "q"), (5, "d", "d"), (5, "d", "d"), (6, "s", "t"), (6, "u", "v")], columns)
    new = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (4, "p", "q"), (5, "d", "d"), (6, "u", "v"), (6, "s", "t")], columns)
    status = {r.k: r.status for r in changes.snapshot_diff(new, old, ["k"]).collect()}
    assert status == {1: "updated", 2: "unchanged", 3: "removed", 4: "new", 5: "updated", 6: "unchanged"}
    assert {r.k for r in changes.changed_partitions(new, old, ["k"]).collect()} == {1, 3, 4, 5}
