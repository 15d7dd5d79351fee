"""Numbers and labels read out of page text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import lookups
from .text import clean_html, let


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def money_in(text: Column) -> Column:
    """`parse_money` of text that is already clean."""
    figure = F.replace(
        F.coalesce(
            _group(text, lookups.RUPEES, 1),
            _group(text, lookups.PLAIN_FIGURE, 1),
        ),
        F.lit(","),
        F.lit(""),
    )
    return (
        F.when(text.rlike(lookups.NIL), F.lit(0).cast("bigint"))
        .when(text.rlike(lookups.NO_FIGURE), F.lit(None).cast("bigint"))
        .otherwise(figure.try_cast("bigint"))
    )


def int_in(text: Column) -> Column:
    """`parse_int` of text that is already clean."""
    return F.regexp_extract(text, r"\d+", 0).try_cast("int")


def education_in(text: Column) -> Column:
    """`parse_education` of text that is already clean."""
    return F.when(text.rlike(lookups.NO_EDUCATION), "Not Given").otherwise(text)


def parse_money(cell: Column) -> Column:
    """Whole rupees. `Nil` is a declared 0; blank, dashes and `Not Given` are null."""
    return let(clean_html(cell), money_in)


def parse_int(cell: Column) -> Column:
    """First run of digits, or null."""
    return int_in(clean_html(cell))


def parse_education(cell: Column) -> Column:
    return let(clean_html(cell), education_in)


def parse_amount(text: Column) -> Column:
    """Digits and dot of a formatted amount, truncated to whole units; two dots give null."""
    return F.regexp_replace(text.cast("string"), r"[^0-9.]", "").try_cast("double").try_cast("bigint")


def parse_link_id(cell: Column, pattern: str) -> Column:
    """Id in the first matching link, or null."""
    return F.regexp_extract(cell, pattern, 1).try_cast("bigint")


def parse_link_ids(page: Column, pattern: str) -> Column:
    """Distinct linked ids in ascending order."""
    found = F.regexp_extract_all(page, F.lit(pattern), F.lit(1))
    ids = F.transform(found, lambda i: i.try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(ids, lambda i: i.isNotNull())))
