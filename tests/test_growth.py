"""What tables that grow must not make one task, or one shuffle, carry."""

import re

from pyspark.sql import functions as F

from rollcall.catalogue import samples
from rollcall.functions import text
from rollcall.plans import medallion

RAW = (
    "election_year int, state string, constituency string, constituency_id int, candidate_id bigint, name string, party string, "
    "criminal_cases int, education string, age int, assets bigint, liabilities bigint, is_winner boolean, is_bye_election boolean"
)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_dealt_out_by_the_size_of_the_table(spark, tables, monkeypatch):
    """a task parses the pages of so many bytes of orders, behind the join."""
    monkeypatch.setattr(samples, "PAGE_TASK_BYTES", 1000)
    pages = samples.candidate_pages(spark, tables)
    assert pages.rdd.getNumPartitions() > 8 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = optimized(pages)
    assert plan.index("Repartition") < plan.index("Join")


def test_rows_are_chosen_before_the_rest_is_derived(spark, tmp_path):
    """columns that no row is chosen by are made above the window, so they are not shuffled."""
    rows = [
        (2001, "ORISSA", "abel (SC)", 1, 7, "K.bel  ara", "Front & x", 2, "10th  Pass", 44, 500, None, True, False),
        (2001, "goa", "abel", 1, 7, "K. bel ara", "front&x", None, None, 12, 900, -5, False, None),
        (2001, "goa", "abel", 1, 8, None, None, 1, "Graduate", None, -3, 9, None, True),
    ]
    silver = medallion.build_silver(spark.createDataFrame(rows, RAW))
    plan = optimized(silver)
    above = plan.index("Window [row_number")
    assert all(plan.rindex(f"AS {c}#") < above for c in ("age_band", "seat_category", "education_group", "net_worth"))
    (row,) = silver.collect()
    assert (row.state, row.constituency, row["name"], row.party) == ("Goa", "Abel", "K. bel ara", "FRONT & X")
    assert (row.assets, row.liabilities, row.net_worth, row.age, row.age_band) == (900, None, 900, None, "Unknown")
    assert (row.education, row.party_group, row.seat_category) == ("Not Given", "Other parties", "GEN")


def test_orders_are_dealt_out_only_for_a_broadcast(spark, tables, monkeypatch):
    """a join that shuffles the orders needs no shuffle before it."""
    assert "Repartition" in optimized(samples.candidates(spark, tables))
    monkeypatch.setattr(samples, "SHUFFLED_BYTES", 0)
    assert "Repartition" not in optimized(samples.candidates(spark, tables))


def test_short_ways_of_text_columns(spark):
    """plain text takes a shorter way to the same result."""
    given = ["", "goa", "10th  pASS", "can't DO", "(nct)delhi", "a_b.c&d", "new\n", "tab\tin", "élan vital", "ß x", "ab cd", "x&amp;y", "a<b>c", "& &#12;k", "S . K .  B"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*given, None])], "i int, t string")
    short, guarded = text.title_case(F.col("t")), text.tidy(F.col("t"))
    cleaned = text.clean_html(F.col("t"))
    for row in df.select("t", short.alias("title"), guarded.alias("tidy"), cleaned.alias("clean")).collect():
        if row.t is None:
            assert (row.title, row.tidy, row.clean) == (None, None, "")
            continue
        runs = re.findall(r"[^\W\d_]+|[\W\d_]+", row.t.lower())
        assert row.title == "".join(r[0].upper()[0] + r[0].upper()[1:].lower() + r[1:] for r in runs)
        flat = re.sub(r"\s+", " ", row.t).strip()
        assert row.tidy == re.sub(r"\s*\.\s*", ". ", re.sub(r"\s*&\s*", " & ", flat)).strip()
        tags = re.sub("<[^>]+>", " ", row.t).replace("&amp;", "&")
        assert row.clean == re.sub(r"\s+", " ", re.sub(r"&#\d+;", " ", tags)).strip()
