"""Exact values at asked ranks (medians, quantiles) of many groupings of one table, from two scans in all.

A rank needs the values of a group in order, and a group may hold a third of all rows, so a group's rows are never brought
together:

1. One scan makes *cells*: for the finest keys of all groupings and a bucket of the value (buckets are about 0.4 % wide), the
   number of values and their lowest and highest, beside any sums that the caller wants. Rows are combined before the shuffle.
2. Groupings are views of the cells, rolled up without touching the table again. Each gives the bucket that holds an asked
   rank. What is wanted of that bucket is known from a cell whose lowest and highest value are one. A second scan, of the
   range of values that they span, counts the distinct values of the other cells of such buckets.
3. Running counts over a bucket's distinct values give the value at the rank. Where the wanted buckets span more than
   2**PART_BITS whole numbers, they are first cut into that many equal parts of their range, on the counts.

What one task sees of a group is bounded by the number of buckets (22,000), then by 2**PART_BITS values or parts, then by the
whole numbers in one part: one for values below 2**32, 2**21 for values below 2**53.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.values import whole_div
from ..session import stage

# Buckets per factor of e, and bits of the number of equal parts that a bucket is cut into.
RESOLUTION = 2**8
PART_BITS = 24


@dataclass
class View:
    """A grouping: its keys, and what it makes of the cells before grouping (a filter, cohorts)."""

    keys: list[str]
    of: Callable[[DataFrame], DataFrame] = lambda cells: cells


def _bucket(value: Column) -> Column:
    """Never falls as `value` rises; null for null."""
    size = F.floor(F.ln(F.abs(value.cast("double")) + 1) * RESOLUTION)
    return (F.signum(value.cast("double")) * size).cast("int")


def _part(value: Column, lowest: Column, highest: Column) -> Column:
    """The equal part of lowest .. highest that the value is in; parts are a power of two wide."""
    wide = (highest.cast("decimal(20,0)") - lowest).cast("double")
    shift = F.greatest(F.ceil(F.log2(wide + 1)) - PART_BITS, F.lit(0))
    size = F.pow(F.lit(2.0), shift).cast("decimal(20,0)")
    return whole_div(value.cast("decimal(20,0)") - lowest, size).cast("bigint")


def same(left: str, right: str, keys: list[str], right_keys: list[str] | None = None) -> Column:
    tests = [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in zip(keys, right_keys or keys, strict=True)]
    return reduce(lambda a, b: a & b, tests)


def halfway(a: Column, b: Column) -> Column:
    """Mean of two whole numbers, truncated; their sum may be beyond a bigint."""
    return whole_div(a.cast("decimal(20,0)") + b.cast("decimal(20,0)"), F.lit(2).cast("decimal(1,0)"))


def middle_ranks(kind: str) -> Callable[[Column], Column]:
    """Ranks of the middle of `held` values: the lower one, or both that a mean is taken of."""
    if kind not in ("lower", "interp"):
        raise ValueError(f"unknown median kind {kind!r}")

    def ranks(held: Column) -> Column:
        lower = whole_div(held + 1, F.lit(2))
        return F.array(lower) if kind == "lower" else F.array_distinct(F.array(lower, whole_div(held, F.lit(2)) + 1))

    return ranks


def share_ranks(shares: list[float]) -> Callable[[Column], Column]:
    """Ranks of quantiles: the smallest rank that at least the share of the values does not pass."""
    if not all(0 <= s <= 1 for s in shares):
        raise ValueError("a share must be within 0 and 1")
    exact = [F.lit(str(s)).cast("decimal(18,17)") for s in shares]
    return lambda held: F.array_distinct(F.array(*(F.greatest(F.ceil(held.cast("decimal(19,0)") * s).cast("bigint"), F.lit(1).cast("bigint")) for s in exact)))


def cells(df: DataFrame, base: list[str], value: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Per base key and bucket: `_held`, `_lowest`, `_highest` and the sums. Written down, as every view reads it."""
    held = F.count(value).alias("_held")
    ends = [f(value).cast("bigint").alias(n) for f, n in ((F.min, "_lowest"), (F.max, "_highest"))]
    grouped = df.groupBy(*base, _bucket(F.col(value)).alias("_bucket"))
    return stage(grouped.agg(held, *ends, *(c.alias(n) for n, c in (sums or {}).items())), "cells")


def _locate(histogram: DataFrame, group: list[str], ranks: Column) -> DataFrame:
    """Per group: the bucket(s) that hold the asked ranks, and those ranks inside the bucket."""
    upto = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    inside = F.filter(
        F.transform("_ranks", lambda r: F.struct(r["asked"].alias("asked"), (r["left"] - F.col("_before")).alias("left"))),
        lambda r: (r["left"] >= 1) & (r["left"] <= F.col("_held")),
    )
    return (
        histogram.withColumn("_ranks", ranks)
        .withColumn("_before", F.sum("_held").over(upto) - F.col("_held"))
        .withColumn("_ranks", inside)
        .filter(F.size("_ranks") > 0)
        .drop("_before")
    )


def _cut(counted: DataFrame, within: list[str]) -> DataFrame:
    """Distinct values (`_value`, `_n`, `_ranks`, range) of the part that holds a rank; ranks are of that part."""
    parted = counted.withColumn("_bucket", _part(F.col("_value"), F.col("_lowest"), F.col("_highest")))
    held = parted.groupBy(*within, "_bucket", "_ranks").agg(F.sum("_n").alias("_held"))
    found = _locate(held, within, F.col("_ranks")).withColumnRenamed("_ranks", "_inner")
    both = parted.alias("r").join(found.alias("t"), same("r", "t", [*within, "_bucket"]))
    kept = both.select(*[f"r.{k}" for k in within], "r._value", "r._n", F.col("t._inner").alias("_ranks"), "r._bucket")
    # parts that hold several asked ranks go on apart
    return kept.withColumn("_place", F.concat_ws("/", "_place", "_bucket")).drop("_bucket")


def _through(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, `_rank` and the `_value` at it. All of a group is one partition by then, so later steps by group need no shuffle."""
    upto = Window.partitionBy(*keys, "_place").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.repartition(*keys).withColumn("_upto", F.sum("_n").over(upto))
    hit = F.filter("_ranks", lambda r: (r["left"] <= F.col("_upto")) & (r["left"] > F.col("_upto") - F.col("_n")))
    return placed.select(*keys, "_value", F.explode(hit).alias("_hit")).select(*keys, F.col("_hit.asked").alias("_rank"), "_value")


def ranked(df: DataFrame, made: DataFrame, base: list[str], views: dict[str, View], value: str, ranks: Callable[[Column], Column]) -> DataFrame:
    """`_view`, the keys of all views (null where a view has not), `_rank` and `_value`, a row for each asked rank.

    `made` is `cells(df, base, value)`; `df` should be a table, as it is read a second time. A group without values has no
    rows.
    """
    copies = [f"_at_{b}" for b in base]
    names = list(dict.fromkeys(k for v in views.values() for k in v.keys))

    def seen(name: str, view: View) -> DataFrame:
        # the cell's own keys first: a view may use the names for something else
        own = made.filter("_held > 0").select("*", *(F.col(b).alias(c) for b, c in zip(base, copies, strict=True)))
        return view.of(own).select(F.lit(name).alias("_view"), *view.keys, *copies, "_bucket", "_held", "_lowest", "_highest")

    listed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [seen(n, v) for n, v in views.items()])
    keys = ["_view", *names]
    histogram = listed.groupBy(*keys, "_bucket").agg(F.sum("_held").alias("_held"), F.min("_lowest").alias("_lowest"), F.max("_highest").alias("_highest"))
    held = F.sum("_held").over(Window.partitionBy(*keys))
    asked = F.transform(ranks(held), lambda r: F.struct(r.alias("asked"), r.alias("left")))
    targets = _locate(histogram, keys, asked)
    both = listed.alias("r").join(targets.alias("t"), same("r", "t", [*keys, "_bucket"]))
    several, seen_while_written = F.col("_low") != F.col("_high"), Observation()
    wide = F.max(F.col("_highest").cast("decimal(20,0)") - F.col("_lowest")).alias("wide")
    span = [F.min(F.when(several, F.col("_low"))).alias("low"), F.max(F.when(several, F.col("_high"))).alias("high")]
    aims = both.select(
        *(f"r.{k}" for k in keys), *(f"r.{c}" for c in copies), "r._bucket", "r._held", F.col("r._lowest").alias("_low"),
        F.col("r._highest").alias("_high"), "t._ranks", "t._lowest", "t._highest",
    )
    aims = stage(aims.observe(seen_while_written, wide, *span), "aims")
    facts = seen_while_written.get
    place = F.col("_bucket").cast("string").alias("_place")
    rest = ["_ranks", "_lowest", "_highest"]
    counted = aims.filter(~several).select(*keys, place, F.col("_low").alias("_value"), F.col("_held").alias("_n"), *rest)
    if facts["low"] is not None:  # else every value is known already
        mixed = aims.filter(several)
        wanted = mixed.select(*copies, "_bucket").distinct()
        rows = df.filter(F.col(value).between(facts["low"], facts["high"]))
        rows = rows.select(*base, F.col(value).cast("bigint").alias("_value"), _bucket(F.col(value)).alias("_bucket"))
        inside = rows.alias("r").join(wanted.alias("w"), same("r", "w", [*base, "_bucket"], [*copies, "_bucket"]), "left_semi")
        counts = inside.groupBy(*(F.col(b).alias(c) for b, c in zip(base, copies, strict=True)), "_bucket", "_value").agg(F.count(F.lit(1)).alias("_n"))
        loose = mixed.drop("_held").alias("m").join(counts.alias("c"), same("m", "c", [*copies, "_bucket"]))
        loose = loose.select(*(f"m.{k}" for k in keys), F.col("m._bucket").cast("string").alias("_place"), "c._value", "c._n", *(f"m.{c}" for c in rest))
        counted = counted.unionByName(loose)
    counted = counted.groupBy(*keys, "_place", "_value", *rest).agg(F.sum("_n").alias("_n"))
    if facts["wide"] is not None and facts["wide"] >= 1 << PART_BITS:
        counted = _cut(counted, [*keys, "_place"])
    return _through(counted, keys)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """Keys, `n` (values that are not null) and `quantiles`, an array of the value at each share, for whole-number columns.

    The quantile at share s of n values is the one at rank ceil(s * n), at least 1; null for a group without values.
    """
    made = cells(df, keys, value)
    found = ranked(df, made, keys, {"all": View(keys)}, value, share_ranks(shares))
    held = made.groupBy(*keys).agg(F.sum("_held").alias("n"))
    at = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))  # one entry a share
    both = held.alias("a").join(at.alias("m"), same("a", "m", keys), "left").select("a.*", "m._at")
    rank = [F.greatest(F.ceil(F.col("n").cast("decimal(19,0)") * F.lit(str(s)).cast("decimal(18,17)")).cast("bigint"), F.lit(1).cast("bigint")) for s in shares]
    return both.select(*keys, "n", F.array(*(F.try_element_at("_at", r) for r in rank)).alias("quantiles"))
