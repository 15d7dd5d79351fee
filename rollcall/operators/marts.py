"""Presentation marts over conformed candidate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import lookups
from ..functions.measures import count_true, rows, total
from ..functions.values import ratio
from .summary import Mart, lattice


def with_cohorts(df: DataFrame) -> DataFrame:
    """Every row under `All candidates`, winners under `Winners (MPs)` too; one scan for both."""
    every, won = F.lit(lookups.ALL_CANDIDATES), F.lit(lookups.WINNERS)
    labels = F.when(F.col("is_winner"), F.array(every, won)).otherwise(F.array(every))
    return df.withColumn("cohort", F.explode(labels))


def named_states(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("state"), F.lit("")) != "")


def mart_sums() -> dict[str, Column]:
    """What every measure of the marts is made of; all of it adds up over rows."""
    cases, rank = F.col("criminal_cases"), F.col("education_rank")
    flags = {"_case": F.col("has_criminal_case"), "_multi": cases >= 2, "_crore": F.col("is_crorepati"), "_graduate": rank >= 6}
    sums = {"_n": rows(), "_won": count_true(F.col("is_winner")), "_cases": total(cases), "_cases_seen": F.count(cases)}
    sums |= {"_age": total(F.col("age")), "_age_seen": F.count("age")}
    for name, flag in flags.items():
        sums |= {name: F.count_if(flag), f"{name}_seen": F.count(flag)}
    return sums


def _share(name: str, seen: str | None = None) -> Column:
    return ratio(F.sum(name), F.sum(seen or f"{name}_seen"), 1, times=100)


def _pairs(*names: str) -> tuple[str, ...]:
    return tuple(n for name in names for n in (name, f"{name}_seen"))


def _mean(name: str, digits: int = 1) -> Column:
    return ratio(F.sum(name), F.sum(f"{name}_seen"), digits)


def trend_mart(scope: list[str] | None = None, null_as_false: bool = False) -> Mart:
    """Year series of both cohorts, national or per `scope`."""
    measures = {
        "n": F.sum("_n"),
        "pct_criminal": _share("_case"),
        "pct_multi_case": _share("_multi"),
        "pct_crorepati": _share("_crore"),
        "avg_age": _mean("_age"),
        "pct_graduate_plus": _share("_graduate", "_n" if null_as_false else None),
        "avg_cases": _mean("_cases", 2),
    }
    view = with_cohorts if not scope else lambda cells: with_cohorts(named_states(cells))
    uses = ("_n", *_pairs("_case", "_multi", "_crore", "_age", "_graduate", "_cases"))
    return Mart([*(scope or []), "election_year", "cohort"], view, measures, "median_assets", uses)


def party_mart(min_n: int = 5) -> Mart:
    measures = {
        "candidates": F.sum("_n"),
        "seats_won": F.sum("_won"),
        "pct_criminal": _share("_case"),
        "pct_crorepati": _share("_crore"),
        "avg_age": _mean("_age"),
    }
    strike = ratio(F.col("seats_won"), F.col("candidates"), 1, times=100)

    def then(grouped: DataFrame) -> DataFrame:
        return grouped.withColumn("strike_rate", strike).filter(F.col("candidates") >= min_n)

    uses = ("_n", "_won", *_pairs("_case", "_crore", "_age"))
    return Mart(["election_year", "party_group"], measures=measures, median_name="median_assets", uses=uses, then=then)


def state_mart() -> Mart:
    """Winners only."""
    measures = {
        "seats": F.sum("_n"),
        "pct_criminal": _share("_case"),
        "pct_crorepati": _share("_crore"),
        "avg_age": _mean("_age"),
        "total_cases": F.sum("_cases"),
    }
    uses = ("_n", "_cases", *_pairs("_case", "_crore", "_age"))
    return Mart(["election_year", "state"], lambda cells: named_states(cells.filter("is_winner")), measures, "median_assets", uses)


def party_state_mart(min_n: int = 5) -> Mart:
    """Kept if there are enough candidates or any seat was won."""
    measures = {"candidates": F.sum("_n"), "seats_won": F.sum("_won"), "pct_criminal": _share("_case")}

    def then(grouped: DataFrame) -> DataFrame:
        return grouped.filter((F.col("candidates") >= min_n) | (F.col("seats_won") > 0))

    return Mart(["election_year", "state", "party_group"], named_states, measures, "median_assets", ("_n", "_won", *_pairs("_case")), then)


def median_marts(df: DataFrame, marts: dict[str, Mart] | None = None, kind: str = "lower") -> dict[str, DataFrame]:
    """The marts with a median, from two scans of `df` in all; the five of the published payload by default."""
    marts = marts or {
        "gold_national_trends": trend_mart(),
        "gold_party_summary": party_mart(),
        "gold_state_summary": state_mart(),
        "gold_state_trends": trend_mart(["state"]),
        "gold_party_state": party_state_mart(),
    }
    needed = {"cohort": "is_winner"} | {k: k for m in marts.values() for k in m.keys if k != "cohort"}
    used = {needed[k] for m in marts.values() for k in m.keys} | ({"is_winner"} if any("seats" in (m.measures or {}) for m in marts.values()) else set())
    base = [k for k in ("election_year", "state", "party_group", "is_winner") if k in used] + sorted(used - {"election_year", "state", "party_group", "is_winner"})
    return lattice(df, base, mart_sums(), marts, "assets", kind)


def _one(df: DataFrame, mart: Mart, kind: str) -> DataFrame:
    return median_marts(df, {"one": mart}, kind)["one"]


def trend(df: DataFrame, scope: list[str] | None = None, kind: str = "lower", null_as_false: bool = False) -> DataFrame:
    return _one(df, trend_mart(scope, null_as_false), kind)


def national_trends(df: DataFrame, **options) -> DataFrame:
    return trend(df, **options)


def state_trends(df: DataFrame, **options) -> DataFrame:
    return trend(df, ["state"], **options)


def party_summary(df: DataFrame, min_n: int = 5, kind: str = "lower") -> DataFrame:
    return _one(df, party_mart(min_n), kind)


def state_summary(df: DataFrame, kind: str = "lower") -> DataFrame:
    """Winners only."""
    return _one(df, state_mart(), kind)


def party_by_state(df: DataFrame, min_n: int = 5, kind: str = "lower") -> DataFrame:
    return _one(df, party_state_mart(min_n), kind)


def distribution(df: DataFrame, label: str, scope: list[str] | None = None) -> DataFrame:
    """Candidates and winners per year and label."""
    return df.groupBy("election_year", *(scope or []), label).agg(
        rows().alias("candidates"), count_true(F.col("is_winner")).alias("winners")
    )


def education_dist(df: DataFrame) -> DataFrame:
    return distribution(df, "education_group")


def age_dist(df: DataFrame) -> DataFrame:
    return distribution(df, "age_band")


def education_by_state(df: DataFrame) -> DataFrame:
    return distribution(named_states(df), "education_group", ["state"])


def age_by_state(df: DataFrame) -> DataFrame:
    return distribution(named_states(df), "age_band", ["state"])


def winners_view(df: DataFrame) -> DataFrame:
    return (
        df.filter("is_winner")
        .select(*lookups.WINNER_COLUMNS)
        .orderBy("election_year", "state", "constituency", "candidate_id", "name")
    )


def leaderboards(df: DataFrame, boards: dict[str, str] | None = None, n: int = 50) -> DataFrame:
    """Leading `n` rows per board and year, one scan for all boards.

    Rows without the board's measure are left out. Each map task forwards at most `n` rows per
    board and year.
    """
    boards = boards or {lookups.RICHEST: "assets", lookups.MOST_CASES: "criminal_cases"}
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("board"), F.col(by).cast("bigint").alias("measure"))
            for label, by in boards.items()
        ]
    )
    order = [
        F.col("_entry.measure").desc(),
        F.col("candidate_id").asc_nulls_last(),
        F.col("name").asc_nulls_last(),
        F.col("constituency").asc_nulls_last(),
    ]
    place = F.row_number().over(Window.partitionBy("board", "election_year").orderBy(*order))
    return (
        df.withColumn("_entry", F.explode(entries))
        .filter(F.col("_entry.measure").isNotNull())
        .withColumn("board", F.col("_entry.board"))
        .withColumn("rank", place)
        .filter(F.col("rank") <= n)
        .select(*lookups.BOARD_COLUMNS)
    )


def top_n(df: DataFrame, by: str, label: str, n: int = 50) -> DataFrame:
    """One board."""
    return leaderboards(df, {label: by}, n)


def person_key(name: str = "name") -> Column:
    return F.regexp_replace(F.upper(F.col(name)), "[^A-Z ]", "")


def repeat_entities(df: DataFrame, key: Column | None = None, limit: int | None = None) -> DataFrame:
    """People seen in two or more elections, with wealth at the first and the last.

    Rows are first reduced to the best one per person and year, which is combined before the
    shuffle, so a very common name is small when its years are put together.
    """
    best = F.max_by(
        F.struct("name", "assets", "is_winner", "criminal_cases"),
        F.struct("assets", -F.coalesce(F.col("candidate_id"), F.lit(2**62)), "name"),
    )
    per_year = (
        df.filter(F.col("assets").isNotNull())
        .groupBy((person_key() if key is None else key).alias("_key"), "state", "election_year")
        .agg(best.alias("b"))
    )
    tracked = (
        per_year.groupBy("_key", "state")
        .agg(
            F.max_by("b.name", "election_year").alias("name"),
            rows().alias("elections_contested"),
            count_true(F.col("b.is_winner")).alias("elections_won"),
            F.min("election_year").alias("first_year"),
            F.max("election_year").alias("last_year"),
            F.min_by("b.assets", "election_year").alias("min_assets"),
            F.max_by("b.assets", "election_year").alias("max_assets"),
            F.max("b.criminal_cases").alias("peak_cases"),
        )
        .filter(F.col("elections_contested") >= 2)
        .withColumn(
            "asset_growth_pct",
            ratio(F.col("max_assets") - F.col("min_assets"), F.col("min_assets"), 0, times=100),
        )
        .drop("_key")
    )
    if limit is None:
        return tracked
    return tracked.orderBy(F.col("asset_growth_pct").desc_nulls_last(), "name", "state").limit(limit)
