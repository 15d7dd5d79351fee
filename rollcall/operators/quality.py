"""Profiles, gates and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import count_true, mean, rows, share


def ingest_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("election_year").agg(
        rows().alias("candidates"),
        count_true(F.col("is_winner")).alias("winners"),
        F.countDistinct("constituency_id").alias("constituencies"),
        F.countDistinct("state").alias("states"),
        share(F.col("assets").isNotNull()).alias("asset_cov_pct"),
    )


def silver_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("election_year").agg(
        rows().alias("candidates"),
        count_true(F.col("is_winner")).alias("winners"),
        F.countDistinct("state").alias("states"),
        F.countDistinct("party").alias("parties"),
        mean(F.col("age")).alias("avg_age"),
        share(F.col("has_criminal_case")).alias("pct_criminal"),
        share(F.col("is_crorepati")).alias("pct_crorepati"),
    )


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("broken_rules", F.array_join(broken, ",")).filter("broken_rules <> ''")


def completeness_violations(
    df: DataFrame, min_winners: int = 500, min_candidates: int = 2000
) -> DataFrame:
    """Years that look truncated."""
    rules = {
        "winners": F.col("winners") >= min_winners,
        "candidates": F.col("candidates") >= min_candidates,
    }
    return violations(ingest_profile(df), rules)


def require(found: DataFrame, what: str) -> None:
    """Raise if there are violations, showing the first few."""
    sample = found.limit(20).collect()
    if sample:
        shown = "\n".join(str(row.asDict()) for row in sample)
        raise ValueError(f"{what}:\n{shown}")


def page_checks(records: DataFrame, page_key: list[str]) -> DataFrame:
    """Rows and winners per page; good pages have exactly one winner."""
    return records.groupBy(*page_key).agg(
        rows().alias("n_rows"), count_true(F.col("is_winner")).alias("n_winners")
    )


def not_one_winner(records: DataFrame, page_key: list[str]) -> DataFrame:
    return page_checks(records, page_key).filter("n_winners <> 1")


def seats_not_named(records: DataFrame, expected: Column) -> DataFrame:
    """Rows whose seat name does not contain the expected text."""
    return records.filter(~F.contains(F.upper(F.col("constituency")), F.upper(expected)))


def is_scarce(ids: str, minimum: int = 500) -> Column:
    """Whether an index page lists fewer ids than expected."""
    return F.size(ids) < minimum


def scarce_links(pages: DataFrame, ids: str, minimum: int = 500) -> DataFrame:
    return pages.filter(is_scarce(ids, minimum))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-empty values of several columns as (column, value), one pass."""
    pairs = reduce(
        lambda a, b: a + b,
        [[F.lit(name), F.col(name).cast("string")] for name in columns],
    )
    return (
        df.select(F.stack(F.lit(len(columns)), *pairs).alias("column", "value"))
        .filter(F.coalesce(F.col("value"), F.lit("")) != "")
        .distinct()
    )


def election_years(df: DataFrame) -> DataFrame:
    """One row: the election years in ascending order, as an array."""
    return df.agg(F.sort_array(F.collect_set("election_year")).alias("years"))
