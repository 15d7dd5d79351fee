"""Golden values of the scalar functions."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rollcall.functions import lookups, parsing, text, values


def apply(spark, function, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", function(F.col("v"))).orderBy("i").collect()]


MONEY = [
    ("Rs 3,09,16,833 ~ 3 Crore+", 30916833),
    ("Rs 29,01,575 ~ 29 Lacs+", 2901575),
    ("Rs 0 ~", 0),
    ("", None),
    ("Nil", 0),
    ("--", None),
    ("Not Given", None),
    ("Rs&nbsp;23,54,678 ~ 23&nbsp;Lacs+", 2354678),
    ("Rs 56,81,54,912 ~ 56 Crore+", 568154912),
    (None, None),
    ("N/A", None),
    ("none", None),
    ("<b>about 12,000</b>", 12000),
    ("7", None),
    ("Rs , only", None),
]


def test_money(spark):
    assert apply(spark, parsing.parse_money, [m for m, _ in MONEY]) == [w for _, w in MONEY]


def test_int(spark):
    assert apply(spark, parsing.parse_int, ["31", "", "52", "<b>4</b> cases", None]) == [31, None, 52, 4, None]


def test_amount(spark):
    cells = ["₹14,94,58,905.11", "1.2.3", ".", "", None, "12"]
    assert apply(spark, parsing.parse_amount, cells) == [149458905, None, None, None, None, 12]


def test_clean_html(spark):
    cells = [
        "Gumma Thanuja Rani &nbsp&nbsp Winner ",
        "a<br>b &amp; c&#8377;d",
        "x   y\n\tz",
        None,
    ]
    want = ["Gumma Thanuja Rani Winner", "a b & c d", "x y z", ""]
    assert apply(spark, text.clean_html, cells) == want


def test_education_default(spark):
    assert apply(spark, parsing.parse_education, ["--", "", "n/a", "Graduate"]) == ["Not Given"] * 3 + ["Graduate"]


def test_link_ids(spark):
    pages = ["constituency_id=9 x constituency_id=2 constituency_id=9", "none", "constituency_id=99999999999999999999"]
    assert apply(spark, lambda c: parsing.parse_link_ids(c, lookups.SEAT_LINK), pages) == [[2, 9], [], []]


def test_tidy(spark):
    assert apply(spark, text.tidy, [" A.B  &C ", "x&y", "P.  V.Rao"]) == ["A. B & C", "x & y", "P. V. Rao"]


def test_label_default(spark):
    assert apply(spark, text.label, [None, " bjp "]) == ["UNKNOWN", "BJP"]


STATES = [
    ("ORISSA", "Odisha"),
    ("jammu and kashmir", "Jammu & Kashmir"),
    ("ANDHRA PRADESH", "Andhra Pradesh"),
    ("ANDAMAN AND NICOBAR ISLANDS", "Andaman & Nicobar Islands"),
    ("DELHI (NCT)", "Delhi"),
    ("nct of delhi", "Delhi"),
    ("Daman  and Diu", "Dadra & Nagar Haveli and Daman & Diu"),
    ("Dadra and Nagar Haveli and Daman and Diu", "Dadra & Nagar Haveli and Daman & Diu"),
    ("", ""),
]


def test_conform_state(spark):
    assert apply(spark, text.conform_state, [s for s, _ in STATES]) == [w for _, w in STATES]


def test_seat_tags(spark):
    seats = ["ARAKU (ST)", "AMALAPURAM (sc)", "x ( SC )", "plain"]
    assert apply(spark, text.seat_category, seats) == ["ST", "SC", "SC", "GEN"]
    assert apply(spark, text.strip_seat_tag, seats) == ["ARAKU", "AMALAPURAM", "x ( SC )", "plain"]


def test_place_key(spark):
    rows = spark.createDataFrame([("Jammu & Kashmir", "Anantnag (SC)"), ("JAMMU AND KASHMIR", "ANANT NAG")], "s string, c string")
    keys = {r[0] for r in rows.select(text.place_key(F.col("s"), F.col("c"))).collect()}
    assert keys == {"JAMMUANDKASHMIR|ANANTNAG"}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="latin-1", exclude_characters="µÿªº"), max_size=20), min_size=1, max_size=30))
def test_title_case_is_python_title(spark, words):
    assert apply(spark, text.title_case, words) == [w.title() for w in words]


def test_education_rank(spark):
    labels = ["10th Pass", "GRADUATE", "Diploma", "Post Graduate", "odd", None]
    rank = lambda c: values.ordinal_rank(c, lookups.EDUCATION_RANKS)
    assert apply(spark, rank, labels) == [4, 6, 6, 8, None, None]
    assert apply(spark, values.education_group, [0, 1, 2, 5, 6, None], "int") == [
        "Illiterate / Literate", "Illiterate / Literate", "Class 5-12", "Class 5-12", "Graduate or above", "Not disclosed",
    ]


def test_bands_and_guards(spark):
    band = lambda c: values.band(values.null_outside(c, 21, 100), lookups.AGE_EDGES, lookups.AGE_BANDS)
    ages = [20, 21, 39, 40, 54, 55, 69, 70, 100, 101, None]
    assert apply(spark, band, ages, "int") == [
        "Unknown", "Under 40", "Under 40", "40-54", "40-54", "55-69", "55-69", "70+", "70+", "Unknown", "Unknown",
    ]
    flag = lambda c: values.threshold_flag(c, lookups.CRORE)
    assert apply(spark, flag, [None, 9_999_999, 10_000_000], "bigint") == [None, False, True]
    with pytest.raises(ValueError):
        values.band(F.lit(1), [1], ["a"])


def test_ratio_is_exact(spark):
    rows = spark.createDataFrame([(1, 8, 0.1), (1, 40, 0.0), (-1, 8, -0.1), (5, 0, None), (201, 200, 1.0)], "n long, d long, w double")
    for n, d, got in rows.select("n", "d", values.ratio(F.col("n"), F.col("d"), 2)).collect():
        if d == 0:
            assert got is None
        else:
            whole = (abs(n) * 200 + d) // (2 * d)
            assert got == (whole if n >= 0 else -whole) / 100


def test_ratio_of_large_sums(spark):
    rows = spark.createDataFrame([(9 * 10**18, 9 * 10**18), (-(9 * 10**18), 8 * 10**18)], "n long, d long")
    got = [r[0] for r in rows.select(values.ratio(F.col("n"), F.col("d"), 2, times=100)).collect()]
    assert got == [100.0, -112.5]


def test_money_display(spark):
    figures = [None, 0, 999, 1_000, 99_499, 150_000, 100_000, 1_500_000, 12_345_678, 20_000_000, 309_168_330, 1_000_000_000]
    assert apply(spark, values.format_inr, figures, "bigint") == [
        "—", "₹0", "₹999", "₹1K", "₹99K", "₹1.5 L", "₹1 L", "₹15 L", "₹1.23 Cr", "₹2 Cr", "₹31 Cr", "₹100 Cr",
    ]
    assert apply(spark, values.group_indian, [None, 5, 999, 1000, 30916833], "bigint") == ["—", "5", "999", "1,000", "3,09,16,833"]
    assert apply(spark, values.format_percent, [None, 12.0, 8.05], "double") == ["—", "12.0%", "8.1%"]
