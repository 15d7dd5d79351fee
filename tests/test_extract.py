"""Pages, tiles and the place hierarchy, on literal pages."""

from pyspark.sql import functions as F

from rollcall.operators import extract, quality
from rollcall.plans.pages import rows_of_pages


def row(n, name, party="ABC", cases="0", education="Graduate", age="50", assets="Rs 10,00,000 ~", debts="Nil", link=True):
    link = f"<a href=candidate.php?candidate_id={900 + n}>" if link else "<a>"
    cells = [str(n), f"{link}{name}</a>", party, f"<b>{cases}</b>", education, age, assets, debts]
    return "<TR class=x>" + "".join(f"<td>{c}</td>" for c in cells) + "</TR>"


HEAD = "<tr><td>Sno</td><td>Candidate</td><td>Party</td><td>C</td><td>E</td><td>A</td><td>T</td><td>L</td></tr>"
GOOD = (
    "<h3>List of Candidates in ARAKU (ST) : ANDHRA PRADESH Lok Sabha 2024</h3><table><tr><td>menu</td></tr></table>"
    "<table>" + row(9, "Wrong", debts="x") + "</table><table>\n" + HEAD
    + row(1, "A &amp; B<font> Winner</font>", assets="Rs&nbsp;3,09,16,833 ~") + row(2, "C. D", "", "", "--", "", "--", "Rs 5 ~", link=False)
    + row(3, " ") + "<tr><td>1</td><td>short row</td></tr>" + row(4, "Total") + "</table>"
)
SPECIAL = "List of Candidates in X : BYE ELECTION ON 04-02-2017 : PUNJAB Lok Sabha 2014<table>" + row(1, "P") + "</table>"
SPECIAL_NO_STATE = "List of Candidates in X : Bye-Election on 1 : BYE ELECTION Lok Sabha 2014<table>" + row(1, "P") + "</table>"
OLDER = "List of Candidates - ARAKU (ST):ANDHRA PRADESH ( 2004 )<table>" + row(1, "Q") + "</table>"
PAGES = [(1, GOOD), (2, SPECIAL), (3, SPECIAL_NO_STATE), (4, OLDER), (5, "<p>moved</p>"), (6, ""), (7, None)]


def pages(spark):
    return spark.createDataFrame(PAGES, "page int, html string")


def test_rows(spark):
    found = extract.explode_rows(pages(spark)).orderBy("page", "name").collect()
    first, second = [r.asDict() for r in found if r.page == 1]
    assert first == {
        "page": 1, "state": "ANDHRA PRADESH", "constituency": "ARAKU (ST)", "candidate_id": 901, "name": "A & B",
        "party": "ABC", "criminal_cases": 0, "education": "Graduate", "age": 50, "assets": 30916833,
        "liabilities": 0, "is_winner": True, "is_bye_election": False,
    }
    assert second["candidate_id"] is None and second["party"] == "Unknown" and second["education"] == "Not Given"
    assert second["criminal_cases"] is None and second["age"] is None and second["assets"] is None
    assert second["liabilities"] == 5 and not second["is_winner"]
    by_page = {r.page: r for r in found}
    assert (by_page[2].state, by_page[2].is_bye_election) == ("PUNJAB", True)
    assert (by_page[3].state, by_page[3].is_bye_election) == ("", True)
    assert (by_page[4].state, by_page[4].constituency) == ("ANDHRA PRADESH", "ARAKU (ST)")
    assert set(by_page) == {1, 2, 3, 4}


def test_first_table_wins_a_tie(spark):
    page = "<table>" + row(1, "first") + "</table><table>" + row(2, "second") + "</table>"
    rows = spark.createDataFrame([(page,)], "html string").select(F.explode(extract.best_table(F.col("html")))).collect()
    assert len(rows) == 1 and "first" in rows[0][0][1]


def test_rejected_pages(spark):
    good, bad = extract.split_pages(pages(spark))
    assert sorted(r.page for r in good.collect()) == [1, 2, 3, 4]
    assert {r.page: r.reason for r in bad.collect()} == {5: "no rows", 6: "empty page", 7: "empty page"}


def test_page_checks(spark):
    records = extract.explode_rows(pages(spark))
    assert sorted(r.page for r in quality.not_one_winner(records, ["page"]).collect()) == [2, 3, 4]
    assert quality.seats_not_named(records.filter("page = 1"), F.lit("araku")).count() == 0
    assert quality.seats_not_named(records.filter("page = 2"), F.lit("araku")).count() == 1


def test_hierarchy(spark):
    states = spark.createDataFrame(
        [("18", " Goa ", 1, [(5, "North ", [
            (7, "A B ", {"Allocated Limit for Hon'ble MPs": ["₹1,000.50", "x"],
                         "Expenditure on Completed and On-going Works as on Date": ["250.9"],
                         "Works Recommended": ["12", "₹3,000", "3K"], "Works Completed": ["4"]}),
            (8, "C", {}),
        ])])],
        "tenure string, state string, state_id int, seats array<struct<id int, name string, members "
        "array<struct<id int, name string, tiles map<string, array<string>>>>>>",
    )
    first, second = extract.flatten_hierarchy(states).orderBy("mp_id").collect()
    assert (first.state, first.constituency, first.mp_name) == ("Goa", "North", "A B")
    assert (first.allocated, first.expenditure, first.pct_spent) == (1000, 250, 25.0)
    assert (first.works_recommended, first.works_recommended_amt) == (12, 3000)
    assert (first.works_completed, first.works_completed_amt, first.works_sanctioned) == (4, None, None)
    assert second.allocated is None and second.pct_spent is None


def test_pages_are_parsed_once_for_rows_and_rejects(spark):
    columns = ["page AS constituency_id", "2004 AS election_year", "'u' AS source_url", "html"]
    rows, rejects = rows_of_pages(pages(spark).selectExpr(*columns))
    assert sorted({r.constituency_id for r in rows.collect()}) == [1, 2, 3, 4]
    assert {r.constituency_id: r.reason for r in rejects.collect()} == {5: "no rows", 6: "empty page", 7: "empty page"}
    for df in (rows, rejects):  # both read what was written of the pages, without their text
        assert "html" not in df._jdf.queryExecution().executedPlan().toString()
