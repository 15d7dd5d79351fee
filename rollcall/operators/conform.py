"""Raw candidate rows -> conformed, enriched rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import lookups, text, values
from ..session import stage


def general_only(df: DataFrame, flag: str = "is_bye_election") -> DataFrame:
    """Rows of general contests; a missing flag counts as general."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def conform_text(df: DataFrame) -> DataFrame:
    """State, seat, seat category, name and party in one spelling."""
    return _conform_places(_conform_labels(df))


def _conform_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({"name": text.tidy(F.col("name")), "party": text.label(F.col("party"))})


def _conform_places(df: DataFrame) -> DataFrame:
    seat = F.col("constituency")
    return df.withColumns(
        {
            "state": text.conform_state(F.coalesce(F.col("state"), F.lit(""))),
            "constituency": text.tidy(seat),
        }
    ).withColumns(
        {
            "seat_category": text.seat_category(F.coalesce(seat, F.lit(""))),
            "constituency": text.title_case(text.strip_seat_tag(seat)),
        }
    )


def rank_education(df: DataFrame) -> DataFrame:
    label = text.title_case(text.collapse(F.coalesce(F.col("education"), F.lit("Not Given"))))
    rank = values.ordinal_rank(F.col("education"), lookups.EDUCATION_RANKS)
    return (
        df.withColumn("education", label)
        .withColumn("education_rank", rank)
        .withColumn("education_group", values.education_group(F.col("education_rank")))
    )


def derive_measures(df: DataFrame) -> DataFrame:
    """Amounts, flags and the age band. Missing stays missing, except cases and liabilities."""
    return _derive_flags(_clean_amounts(df))


def _clean_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "assets": values.non_negative(F.col("assets")),
            "liabilities": values.non_negative(F.col("liabilities")),
            "criminal_cases": F.coalesce(F.col("criminal_cases"), F.lit(0)),
        }
    )


def _derive_flags(df: DataFrame) -> DataFrame:
    assets, cases, age = F.col("assets"), F.col("criminal_cases"), F.col("age")
    return df.withColumns({"age": values.null_outside(age, 21, 100)}).withColumns(
        {
            "net_worth": assets - F.coalesce(F.col("liabilities"), F.lit(0)),
            "is_crorepati": values.threshold_flag(assets, lookups.CRORE),
            "has_criminal_case": cases > 0,
            "age_band": values.band(age, lookups.AGE_EDGES, lookups.AGE_BANDS),
        }
    )


def conform_judged(df: DataFrame) -> DataFrame:
    """Names, parties and amounts: what one row per key is chosen by."""
    return _clean_amounts(_conform_labels(df))


def conform_rest(df: DataFrame) -> DataFrame:
    """All that nothing is chosen by, of rows out of `conform_judged`."""
    return _derive_flags(rank_education(_conform_places(df)))


def conform(df: DataFrame) -> DataFrame:
    """All row-level steps; no shuffle."""
    return conform_rest(conform_judged(df))


def qualifying_labels(df: DataFrame, min_wins: int = lookups.MAJOR_PARTY_WINS) -> DataFrame:
    """Parties with at least `min_wins` wins in one election."""
    return (
        df.filter("is_winner")
        .groupBy("election_year", "party")
        .agg(F.count(F.lit(1)).alias("wins"))
        .filter(F.col("wins") >= min_wins)
        .select("party")
        .distinct()
    )


def party_group(df: DataFrame, qualifying: DataFrame) -> DataFrame:
    """`Independent`, the party's own name if it qualifies, else `Other parties`.

    `qualifying` is written out first, so that its size decides between a broadcast and a
    shuffled join; in the latter the adaptive skew split takes care of a dominant party.
    """
    kept = stage(qualifying.withColumn("_qualifies", F.lit(True)), "qualifying")
    return (
        df.join(kept, "party", "left")
        .withColumn(
            "party_group",
            F.when(F.col("party").isin("IND", "INDEPENDENT"), "Independent")
            .when(F.col("_qualifies"), F.col("party"))
            .otherwise("Other parties"),
        )
        .drop("_qualifies")
    )
