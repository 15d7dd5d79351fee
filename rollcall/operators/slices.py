"""Filter, search, sort and year-on-year queries over the marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import lookups
from ..functions.text import contains_any
from ..functions.values import ratio
from .marts import named_states
from .quality import distinct_values

WINNER_SEARCH = ["name", "party", "constituency", "state"]
FUND_SEARCH = ["mp_name", "winner_name", "constituency", "party", "state"]
SLICE_COLUMNS = [
    "election_year", "state", "constituency", "seat_category", "name", "party", "criminal_cases",
    "education", "age", "assets", "liabilities",
]


def trend_slice(series: DataFrame, cohort: str, state: str | None = None) -> DataFrame:
    """One cohort's series, out of the national mart, or with a state set out of the mart by state."""
    rows = series.filter(F.col("state") == state).drop("state") if state else series
    return rows.filter(F.col("cohort") == cohort).orderBy("election_year")


def search(df: DataFrame, needle: str | None, columns: list[str]) -> DataFrame:
    return df.filter(contains_any(needle, columns)) if needle else df


def winners_slice(
    winners: DataFrame,
    year: int,
    state: str | None = None,
    party_group: str | None = None,
    needle: str | None = None,
) -> DataFrame:
    rows = winners.filter(F.col("election_year") == year)
    if state:
        rows = rows.filter(F.col("state") == state)
    if party_group:
        rows = rows.filter(F.col("party_group") == party_group)
    return search(rows, needle, WINNER_SEARCH)


def sort_view(df: DataFrame, key: str, descending: bool = False, then: list[str] | None = None) -> DataFrame:
    """Sorted by one column in either direction, nulls last in both."""
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    return df.orderBy(first, *(then or []))


def slice_counts(df: DataFrame, shown: Column) -> DataFrame:
    """`Showing n of N` in one pass."""
    return df.agg(F.count_if(shown).alias("shown"), F.count(F.lit(1)).alias("total"))


def _top(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.limit(n)


def party_chart(parties: DataFrame, year: int, state: str | None = None, n: int | None = None) -> DataFrame:
    """Parties with seats, most seats first, the top `n` if given; `parties` is the national or the by-state mart."""
    rows = parties.filter((F.col("election_year") == year) & (F.col("seats_won") > 0))
    if state:
        rows = rows.filter(F.col("state") == state)
    return _top(rows.orderBy(F.col("seats_won").desc(), "party_group"), n)


def state_ranking(states: DataFrame, year: int, min_seats: int = 3, n: int | None = None) -> DataFrame:
    """States by share of winners with cases; small delegations are left out."""
    rows = states.filter((F.col("election_year") == year) & (F.col("seats") >= min_seats))
    return _top(rows.orderBy(F.coalesce(F.col("pct_criminal"), F.lit(0.0)).desc(), "state"), n)


def leaderboard_slice(boards: DataFrame, board: str, year: int) -> DataFrame:
    return boards.filter((F.col("board") == board) & (F.col("election_year") == year)).orderBy("rank")


def repeat_slice(
    repeats: DataFrame, state: str | None = None, needle: str | None = None, n: int | None = None
) -> DataFrame:
    rows = repeats.filter(F.col("state") == state) if state else repeats
    rows = search(rows, needle, ["name", "state"])
    return _top(rows.orderBy(F.col("asset_growth_pct").desc_nulls_last(), "name", "state"), n)


def funds_slice(funds: DataFrame, state: str | None = None, needle: str | None = None) -> DataFrame:
    rows = funds.filter(F.col("state") == state) if state else funds
    rows = search(rows, needle, FUND_SEARCH)
    share = F.coalesce(F.col("pct_spent"), F.lit(0.0))
    return rows.orderBy(share.desc(), "state", "constituency", "mp_id")


def year_spine(df: DataFrame, years: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct `keys` with every year of the one-row table `years`."""
    return df.select(*keys).distinct().withColumn("election_year", F.explode(years.scalar()))


def trend_spine(series: DataFrame, years: DataFrame, keys: list[str], field: str) -> DataFrame:
    """A series on the full list of years, null where there is no figure."""
    points = series.select(*keys, "election_year", field)
    return year_spine(series, years, keys).join(points, [*keys, "election_year"], "left")


def missing_slices(df: DataFrame, years: DataFrame) -> DataFrame:
    """(state, year) without any row, although the state has rows in other years."""
    present = named_states(df).select("state", "election_year").distinct()
    return year_spine(present, years, ["state"]).join(present, ["state", "election_year"], "left_anti")


def state_vs_all(
    national: DataFrame, by_state: DataFrame, years: DataFrame, cohort: str, field: str
) -> DataFrame:
    """Every state's series beside the national one, on the full list of years."""
    mine = by_state.filter(F.col("cohort") == cohort).select(
        "state", "election_year", F.col(field).alias("state_value")
    )
    every = national.filter(F.col("cohort") == cohort).select(
        "election_year", F.col(field).alias("all_value")
    )
    return (
        year_spine(mine, years, ["state"])
        .join(mine, ["state", "election_year"], "left")
        .join(every, "election_year", "left")
    )


def _series(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("election_year")


def kpi_delta(series: DataFrame, keys: list[str]) -> DataFrame:
    """Each year's figures and their change since the previous year present in the series."""
    before = _series(keys)

    def last(name: str) -> Column:
        return F.lag(name).over(before)

    def change(name: str) -> Column:
        return F.round(F.col(name) - last(name), 1)

    return series.select(
        *keys,
        "election_year",
        last("election_year").alias("previous_year"),
        "n",
        "pct_criminal",
        change("pct_criminal").alias("pct_criminal_change"),
        "pct_crorepati",
        change("pct_crorepati").alias("pct_crorepati_change"),
        "median_assets",
        last("median_assets").alias("previous_median_assets"),
        "avg_age",
        "pct_graduate_plus",
    )


def trend_insights(series: DataFrame, keys: list[str]) -> DataFrame:
    """First against last year of a series: direction of the share, multiple of the median."""
    ends = (
        series.filter("n > 0")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("years"),
            *[
                end(name, "election_year").alias(f"{prefix}_{name}")
                for prefix, end in (("first", F.min_by), ("last", F.max_by))
                for name in ("election_year", "pct_criminal", "median_assets")
            ],
        )
        .filter("years >= 2")
    )
    first, last = F.col("first_median_assets"), F.col("last_median_assets")
    usable = (first != 0) & (last != 0)
    multiple = F.when(last >= first * 10, ratio(last, first, 0)).otherwise(ratio(last, first, 1))
    direction = F.when(F.col("last_pct_criminal") > F.col("first_pct_criminal"), "up from").when(
        F.col("last_pct_criminal") <= F.col("first_pct_criminal"), "down from"
    )
    return ends.withColumns(
        {"direction": direction, "asset_multiple": F.when(usable, multiple)}
    ).drop("years")


def _latest_pair(series: DataFrame, keys: list[str], measure: str, prefix: str, told: Callable[[Column], Column]) -> DataFrame:
    """Winners in their latest year whose figure is told, beside the whole field in that year if its figure is."""
    sides = [
        F.max(F.when(F.col("cohort") == cohort, F.col(measure))).alias(side)
        for cohort, side in ((lookups.WINNERS, "won"), (lookups.ALL_CANDIDATES, "field"))
    ]
    held = series.groupBy(*keys, "election_year").agg(*sides).filter(told(F.col("won")))
    latest = F.max_by(F.struct("election_year", "won", "field"), "election_year")
    return (
        held.groupBy(*keys)
        .agg(latest.alias("p"))
        .filter(told(F.col("p.field")))
        .select(
            *keys,
            F.col("p.election_year").alias(f"{prefix}_year"),
            F.col("p.won").alias(f"winner_{prefix}"),
            F.col("p.field").alias(f"field_{prefix}"),
        )
    )


def cohort_premium(series: DataFrame, keys: list[str]) -> DataFrame:
    """Winners beside the whole field: medians with their ratio, and crorepati shares, each in its own latest year."""
    medians = _latest_pair(series, keys, "median_assets", "median", lambda m: F.coalesce(m, F.lit(0)) != 0)
    shares = _latest_pair(series, keys, "pct_crorepati", "pct_crorepati", lambda p: p.isNotNull())
    both = medians.unionByName(shares, allowMissingColumns=True)
    figures = [c for c in both.columns if c not in keys]
    held = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in figures]).filter("median_year IS NOT NULL OR pct_crorepati_year IS NOT NULL")
    return held.withColumn("premium", ratio(F.col("winner_median"), F.col("field_median"), 1))


def dist_matrix(
    dist: DataFrame, label: str, labels: list[str], measure: str = "candidates", years: DataFrame | None = None
) -> DataFrame:
    """Year by label, 0 where there are no rows; with `years`, every year of that one-row table has a row."""
    cells = dist.groupBy("election_year").pivot(label, labels).agg(F.sum(measure))
    if years is not None:
        cells = years.select(F.explode(years.columns[0]).alias("election_year")).join(cells, "election_year", "left")
    return cells.fillna(0, labels)


def filter_options(winners: DataFrame) -> DataFrame:
    """Values offered by the year, state and party filters."""
    return distinct_values(winners, ["election_year", "state", "party_group"])
