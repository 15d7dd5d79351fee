"""Numeric columns: exact rounding, guards, bands, ranks and display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import lookups


def whole_div(a: Column, b: Column) -> Column:
    """Integer division, truncated toward zero."""
    return F.call_function("div", a, b)


def ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """`times * num / den` rounded half up (away from zero) on the exact value; null unless den > 0.

    Whole-number arithmetic keeps the result independent of the order rows are added in, and
    decimals leave room for sums near the end of the bigint range.
    """
    wide = "decimal(38,0)"
    scaled = F.abs(num.cast(wide)) * F.lit(2 * times * 10**digits).cast("decimal(10,0)")
    den = den.cast(wide)
    rounded = whole_div(scaled + den, den * F.lit(2).cast("decimal(1,0)"))
    sign = F.signum(num.cast("double")).cast("bigint")
    return F.when(den > 0, rounded * sign / F.lit(float(10**digits)))


def non_negative(col: Column) -> Column:
    return F.when(col >= 0, col)


def null_outside(col: Column, low: int, high: int) -> Column:
    return F.when(col.between(low, high), col)


def threshold_flag(col: Column, threshold: int) -> Column:
    """True, false, or null where there is no figure."""
    return F.when(col.isNotNull(), col >= threshold)


def band(col: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the band `col` falls in: below the first edge, ..., from the last edge on.

    `labels` has one name per band and a last one for null.
    """
    if len(labels) != len(edges) + 2:
        raise ValueError("one label per band and one for null")
    chain = F.when(col.isNull(), labels[-1])
    for edge, name in zip(edges, labels):
        chain = chain.when(col < edge, name)
    return chain.otherwise(labels[-2])


def ordinal_rank(label: Column, ranks: dict[str, int]) -> Column:
    """Rank of a label, matched without regard to case; unknown gives null."""
    table = F.create_map(*[F.lit(part) for pair in ranks.items() for part in pair])
    return F.try_element_at(table, F.lower(F.trim(label)))


def education_group(rank: Column) -> Column:
    low, middle, high, unknown = lookups.EDUCATION_GROUPS
    return (
        F.when(rank >= 6, high)
        .when(rank >= 2, middle)
        .when(rank <= 1, low)
        .otherwise(unknown)
    )


def group_indian(col: Column) -> Column:
    """Whole number with Indian digit grouping: 30916833 -> 3,09,16,833; null -> a dash."""
    text = F.regexp_replace(col.cast("string"), r"(\d)(?=(\d\d)+\d$)", "$1,")
    return F.coalesce(text, F.lit("—"))


def _fixed(value: Column, unit: int, digits: int) -> Column:
    """Non-negative `value / unit` as text with `digits` decimals, a zero tail dropped."""
    hundredths = whole_div(value * (2 * 10**digits) + unit, F.lit(2 * unit))
    if digits == 0:
        return hundredths.cast("string")
    whole = whole_div(hundredths, F.lit(10**digits)).cast("string")
    tail = F.lpad((hundredths % 10**digits).cast("string"), digits, "0")
    return F.when(hundredths % 10**digits == 0, whole).otherwise(F.concat_ws(".", whole, tail))


def format_inr(col: Column) -> Column:
    """Rupees in crore, lakh or thousand units; null -> a dash."""
    v = col.cast("bigint")
    return (
        F.when(v.isNull(), "—")
        .when(v >= 100_000_000, F.concat(F.lit("₹"), _fixed(v, 10_000_000, 0), F.lit(" Cr")))
        .when(v >= 10_000_000, F.concat(F.lit("₹"), _fixed(v, 10_000_000, 2), F.lit(" Cr")))
        .when(v >= 1_000_000, F.concat(F.lit("₹"), _fixed(v, 100_000, 0), F.lit(" L")))
        .when(v >= 100_000, F.concat(F.lit("₹"), _fixed(v, 100_000, 1), F.lit(" L")))
        .when(v >= 1_000, F.concat(F.lit("₹"), _fixed(v, 1_000, 0), F.lit("K")))
        .otherwise(F.concat(F.lit("₹"), v.cast("string")))
    )


def format_percent(col: Column) -> Column:
    """One decimal and a percent sign; null -> a dash."""
    return F.when(col.isNull(), "—").otherwise(F.format_string("%.1f%%", col.cast("double")))
