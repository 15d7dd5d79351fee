"""Grouped measures with an exact median: of one grouping, or of many from the same two scans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .ranks import View, cells, halfway, middle_ranks, ranked, same


@dataclass
class Mart(View):
    """A grouping with measures over the sums of its cells, its median's name, the sums it needs, and what is done with the result."""

    measures: dict[str, Column] | None = None
    median_name: str = "median"
    #: Names of the sums that the measures are made of; all if none are named.
    uses: tuple[str, ...] = ()
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows


def _with_median(totals: DataFrame, found: DataFrame, keys: list[str], name: str) -> DataFrame:
    medians = found.groupBy(*keys).agg(halfway(F.min("_value"), F.max("_value")).cast("bigint").alias(name))
    return totals.alias("a").join(medians.alias("m"), same("a", "m", keys), "left").select("a.*", f"m.{name}")


def lattice(
    df: DataFrame, base: list[str], sums: dict[str, Column], marts: dict[str, Mart], value: str, kind: str = "lower"
) -> dict[str, DataFrame]:
    """Every mart, from two scans of `df` in all.

    `sums` are aggregates that add up (counts, sums) over rows with one set of base keys; a mart's measures are aggregates over
    those. Marts are one table each, and share what is written down: the cells and the values at the middle ranks.
    """
    if all(m.uses for m in marts.values()):
        sums = {n: c for n, c in sums.items() if any(n in m.uses for m in marts.values())}
    made = cells(df, base, value, sums)
    found = ranked(df, made, base, {n: View(m.keys, m.of) for n, m in marts.items()}, value, middle_ranks(kind))
    if len(marts) > 1:
        found = stage(found, "middles")
    out = {}
    for name, mart in marts.items():
        totals = mart.of(made).groupBy(*mart.keys).agg(*(c.alias(n) for n, c in (mart.measures or {}).items()))
        out[name] = mart.then(_with_median(totals, found.filter(F.col("_view") == name), mart.keys, mart.median_name))
    return out


def summarise(
    df: DataFrame,
    keys: list[str],
    measures: dict[str, Column],
    median_of: str | None = None,
    median_name: str | None = None,
    kind: str = "lower",
) -> DataFrame:
    """One row per group: keys, measures and, if asked, the exact median of a whole-number column.

    `kind="lower"` takes the lower of two middle values, `"interp"` their mean, truncated. `df` should be a table: it is
    read for the measures, which may be any aggregates, and for the median.
    """
    totals = df.groupBy(*keys).agg(*(m.alias(name) for name, m in measures.items()))
    if median_of is None:
        return totals
    ranks = middle_ranks(kind)
    found = ranked(df, cells(df, keys, median_of), keys, {"all": View(keys)}, median_of, ranks)
    return _with_median(totals, found, keys, median_name or f"median_{median_of}")


def exact_median(df: DataFrame, keys: list[str], value: str, kind: str = "lower") -> DataFrame:
    ranks = middle_ranks(kind)
    made = cells(df, keys, value)
    found = ranked(df, made, keys, {"all": View(keys)}, value, ranks)
    return _with_median(made.select(*keys).distinct(), found, keys, "median")
