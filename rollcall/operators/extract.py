"""Typed rows out of page text and nested documents. All row-level: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lookups, parsing
from ..functions.text import clean_html, let
from ..functions.values import ratio


def page_header(page: Column) -> Column:
    """Struct of seat and state text of a page header, '' where there is none."""

    def found(header: Column) -> Column:
        """Both groups, read from the header alone: the page itself is searched once for each pattern."""

        def part(group: int) -> Column:
            main = F.regexp_extract(header["main"], lookups.HEADER, group)
            other = F.regexp_extract(header["other"], lookups.HEADER_ALTERNATE, group)
            return clean_html(F.when(header["main"] != "", main).otherwise(other))

        state = F.trim(F.regexp_replace(part(2), lookups.HEADER_TAIL, ""))
        return F.struct(part(1).alias("constituency"), state.alias("state"))

    def other(main: Column) -> Column:
        rest = F.when(main == "", F.regexp_extract(page, lookups.HEADER_ALTERNATE, 0)).otherwise("")
        return F.struct(main.alias("main"), rest.alias("other"))

    return let(let(F.regexp_extract(page, lookups.HEADER, 0), other), found)


def special_contest(state: Column) -> Column:
    """Struct of the bye-election flag and the state after the last colon, '' if none."""
    special = state.rlike(lookups.BYE_ELECTION)
    parts = F.filter(
        F.transform(F.split(state, ":"), lambda p: F.trim(p)), lambda p: p != ""
    )
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
    true_state = F.when(last.rlike(lookups.BYE_ELECTION), "").otherwise(last)
    return F.struct(
        special.alias("is_bye_election"),
        F.when(special, true_state).otherwise(state).alias("state"),
    )


def _largest(lists: Column, empty: str) -> Column:
    """The longest of several arrays, the first one on a tie; an empty array if there is none."""
    ranked = F.transform(
        lists,
        lambda held, i: F.struct(F.size(held).alias("n"), (-i).alias("first"), held.alias("held")),
    )
    return F.coalesce(F.array_max(ranked)["held"], F.array().cast(empty))


def best_block(page: Column, block: str, row: str) -> Column:
    """Rows of the block with the most rows, the first one on a tie."""
    rows = F.transform(
        F.regexp_extract_all(page, F.lit(block), F.lit(0)),
        lambda text: F.regexp_extract_all(text, F.lit(row), F.lit(1)),
    )
    return _largest(rows, "array<string>")


def best_table(page: Column, width: int = 8) -> Column:
    """Rows, as arrays of cells, of the table with the most rows of `width` cells."""

    def cells_of(row: Column) -> Column:
        return F.regexp_extract_all(row, F.lit(lookups.TABLE_CELL), F.lit(1))

    def rows_of(table: Column) -> Column:
        rows = F.regexp_extract_all(table, F.lit(lookups.TABLE_ROW), F.lit(1))
        return F.filter(F.transform(rows, cells_of), lambda cells: F.size(cells) == width)

    tables = F.regexp_extract_all(page, F.lit(lookups.TABLE), F.lit(0))
    return _largest(F.transform(tables, rows_of), "array<array<string>>")


#: Columns that `parse_pages` puts in the place of the page.
PARSED = ("_header", "_contest", "_rows", "_empty")


def parse_pages(pages: DataFrame, page: str = "html") -> DataFrame:
    """Each page read once: `_header`, `_contest`, `_rows` (cell texts of the candidate table) and `_empty` in its place."""
    kept = [c for c in pages.columns if c != page]

    def read_cells(cells: Column) -> Column:
        return F.struct(
            F.get(cells, F.lit(1)).alias("name_cell"), F.transform(cells, clean_html).alias("text")
        )

    read = pages.select(
        *kept,
        page_header(F.col(page)).alias("_header"),
        F.transform(best_table(F.col(page)), read_cells).alias("_rows"),
        (F.coalesce(F.trim(page), F.lit("")) == "").alias("_empty"),
    )
    return read.withColumn("_contest", special_contest(F.col("_header.state")))


def rejected_parsed(parsed: DataFrame) -> DataFrame:
    """Parsed pages without candidate rows, with the reason. `parsed` should be written down."""
    reason = F.when(F.col("_empty"), "empty page").otherwise("no rows")
    return parsed.filter(F.size("_rows") <= 0).withColumn("reason", reason).drop(*PARSED)


def explode_rows(pages: DataFrame, page: str = "html") -> DataFrame:
    """One record per candidate row of every page; other columns of `pages` are kept."""
    return explode_parsed(parse_pages(pages, page))


def explode_parsed(parsed: DataFrame) -> DataFrame:
    """One record per candidate row of pages read by `parse_pages`.

    The explode is an outer one because Catalyst guards an inner one with a filter that reads the
    cells a second time; pages without rows drop out with the rows that have no name.
    """
    kept = [c for c in parsed.columns if c not in PARSED]

    def cell(position: int) -> Column:
        return F.get(F.col("_row.text"), F.lit(position))

    name_cell = F.col("_row.name_cell")
    name = F.trim(F.regexp_replace(cell(1), lookups.WINNER_MARK, ""))
    return (
        parsed.select(*kept, "_header", "_contest", F.explode_outer("_rows").alias("_row"))
        .select(
            *kept,
            F.col("_contest.state").alias("state"),
            F.col("_header.constituency").alias("constituency"),
            parsing.parse_link_id(name_cell, lookups.CANDIDATE_LINK).alias("candidate_id"),
            name.alias("name"),
            F.coalesce(F.nullif(cell(2), F.lit("")), F.lit("Unknown")).alias("party"),
            parsing.int_in(cell(3)).alias("criminal_cases"),
            parsing.education_in(cell(4)).alias("education"),
            parsing.int_in(cell(5)).alias("age"),
            parsing.money_in(cell(6)).alias("assets"),
            parsing.money_in(cell(7)).alias("liabilities"),
            name_cell.rlike("(?i)winner").alias("is_winner"),
            F.col("_contest.is_bye_election").alias("is_bye_election"),
        )
        .filter(~F.lower("name").isin("", "candidate", "sno", "total"))
    )


def split_pages(
    pages: DataFrame, page: str = "html", rows: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Pages with rows, and rejected pages with the reason; a bad page never stops the others.

    `rows` is the array a page is judged by, the candidate table unless given.
    """
    found = best_table(F.col(page)) if rows is None else rows
    counted = pages.withColumn("n_rows", F.size(found))
    reason = F.when(F.coalesce(F.trim(page), F.lit("")) == "", "empty page").otherwise("no rows")
    return (
        counted.filter("n_rows > 0"),
        counted.filter("n_rows = 0").withColumn("reason", reason),
    )


def pivot_tiles(tiles: Column, spec: dict[str, tuple[str, str | None]] | None = None) -> list[Column]:
    """Columns out of a caption -> figures map; a missing caption or figure gives null."""
    columns = []
    for caption, names in (spec or lookups.FUND_TILES).items():
        figures = F.try_element_at(tiles, F.lit(caption))
        for position, name in enumerate(names, start=1):
            if name is not None:
                figure = F.try_element_at(figures, F.lit(position))
                columns.append(parsing.parse_amount(figure).alias(name))
    return columns


def flatten_hierarchy(states: DataFrame) -> DataFrame:
    """state -> seats -> members, nested, to one row per member with its tiles as columns.

    Input: tenure, state_id, state, seats array<struct<id, name, members array<struct<id, name,
    tiles map<string, array<string>>>>>>.
    """
    members = (
        states.select("tenure", "state", "state_id", F.explode("seats").alias("seat"))
        .select("tenure", "state", "state_id", "seat.id", "seat.name", F.explode("seat.members").alias("m"))
        .select(
            "tenure",
            F.trim("state").alias("state"),
            "state_id",
            F.trim("name").alias("constituency"),
            F.col("id").alias("constituency_id"),
            F.trim("m.name").alias("mp_name"),
            F.col("m.id").alias("mp_id"),
            *pivot_tiles(F.col("m.tiles")),
        )
    )
    return members.withColumn("pct_spent", pct_spent())


def pct_spent(spent: str = "expenditure", allocated: str = "allocated") -> Column:
    return ratio(F.col(spent), F.col(allocated), 1, times=100)
