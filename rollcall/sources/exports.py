"""Published files: JSON rows, JSON documents and CSV, and the run's meta row."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..operators.slices import SLICE_COLUMNS
from . import commits

# Columns and order of the flat file.
FLAT_COLUMNS = [
    "election_year", "state", "constituency", "seat_category", "name", "party", "party_group",
    "criminal_cases", "education", "age", "assets", "liabilities", "net_worth", "is_winner",
    "is_bye_election",
]
FLAT_ORDER = ["election_year", "state", "constituency"]


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinity become null, doubles get 2 decimals, times become ISO text."""

    def safe(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            bad = F.isnan(col) | (F.abs(col) == float("inf"))
            return F.when(~bad, F.round(col.cast("double"), 2)).alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        return col

    return df.select(*[safe(field) for field in df.schema])


def json_rows(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


Section = tuple[DataFrame, list[Column]]


def write_payload(sections: dict[str, Section], path: str) -> None:
    """One folder of ordered JSON lines per section; the sort is distributed."""
    for name, (df, order) in sections.items():
        safe = json_safe(df.orderBy(*order))
        safe.select(json_rows(safe).alias("body")).write.mode("overwrite").text(f"{path}/{name}")


def _digest(body: Column) -> list[Column]:
    """Rows counted and hashed, without regard to order, which follows from the content."""
    hashes = [F.coalesce(F.sum(F.xxhash64(F.lit(k), body).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(f"h{k}") for k in (1, 2)]
    return [F.count(body).alias("rows"), *hashes]


def _write_section(df: DataFrame, order: list[Column], path: str, as_csv: bool) -> dict:
    """Writes one section and returns its digest, taken from the rows as they are written: it is computed once."""
    told = Observation()
    safe = json_safe(df.orderBy(*order) if order else df)
    seen = safe.observe(told, *_digest(json_rows(safe)))
    if as_csv:
        write_csv(seen, path)
    else:
        seen.select(json_rows(safe).alias("body")).write.text(path)
    return told.get


def publish_changed(
    sections: dict[str, Section], path: str, csv: Iterable[str] = (), beside: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Publishes the sections as one payload and returns (section, status): new, updated, unchanged, removed.

    Every section is computed once, into a folder of this run's own. Then one commit (`commits`) names the folder of every
    section: the new one where the digest differs from the last run's, else the old one. So a reader has the old payload or
    the new one, also if a run stops anywhere. Folders that the new payload does not name, of removed and replaced sections and of
    runs that stopped, are then deleted; one run publishes at a time.

    Sections named in `csv` are written as CSV. Those of `beside` are small rows about the run, written if any other changed.
    """
    spark = next(iter(sections.values()))[0].sparkSession
    run, before = uuid.uuid4().hex, commits.newest(spark, path)
    now: dict[str, dict] = {}
    for name, (df, order) in sections.items():
        folder = f"{run}.{name.replace('/', '.')}"
        now[name] = {"folder": folder, **_write_section(df, order, f"{path}/data/{folder}", name in csv)}
    status, parts = {}, {}
    for name, part in now.items():
        old = before.parts.get(name)
        same = old is not None and all(old[k] == part[k] for k in ("rows", "h1", "h2"))
        status[name] = "unchanged" if same else "new" if old is None else "updated"
        parts[name] = old if same else part
    about = set(beside or {})
    status |= {name: "removed" for name in before.parts if name not in now and name not in about}
    changed = any(what != "unchanged" for what in status.values())
    for name, df in (beside or {}).items():
        if changed or name not in before.parts:
            folder = f"{run}.{name}"
            parts[name] = {"folder": folder, **_write_section(df, [], f"{path}/data/{folder}", False)}
        else:
            parts[name] = before.parts[name]
    if changed or parts != before.parts:
        if not commits.commit(spark, path, commits.Snapshot(before.number + 1, parts)):
            raise RuntimeError("another run has published meanwhile")
    commits.tidy(spark, path, keep=1, min_age_s=-60)
    return spark.createDataFrame(sorted(status.items()), "section string, status string")


def section_path(spark: SparkSession, path: str, name: str) -> str:
    """Where the payload has a section; KeyError if it has none of that name."""
    return f"{path}/data/{commits.newest(spark, path).parts[name]['folder']}"


def read_section(spark: SparkSession, path: str) -> DataFrame:
    """(position, body) of one published section; positions count from 0 in published order.

    Each split numbers its rows; a count per split (a few rows) tells where it begins.
    """
    number = F.monotonically_increasing_id()
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), number.alias("number")
    )
    splits = rows.groupBy("file", "block").agg(F.min("number").alias("first"), F.count("value").alias("n"))
    upto = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    return rows.join(begins, ["file", "block"]).select(
        (F.col("number") - F.col("first") + F.col("before")).alias("position"), F.col("value").alias("body")
    )


def run_meta(df: DataFrame, generated_at: str, source: str) -> DataFrame:
    """Years, rows, winners and excluded bye-election rows of all rows, in one pass."""
    special = F.coalesce(F.col("is_bye_election"), F.lit(False))
    years = F.sort_array(F.collect_set(F.when(~special, F.col("election_year"))))
    return df.agg(
        F.lit(generated_at).alias("generated_at"),
        F.lit(source).alias("source"),
        years.alias("election_years"),
        F.count_if(~special).alias("total_candidates"),
        F.count_if(~special & F.col("is_winner")).alias("total_winners"),
        F.count_if(special).alias("bye_election_rows_excluded"),
    )


def flat_export(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The tidy data set, winners first within a seat."""
    tail = [F.col("is_winner").desc_nulls_last(), F.col("candidate_id").asc_nulls_last(), F.col("name").asc_nulls_last()]
    return df.orderBy(*FLAT_ORDER, *tail).select(*(columns or FLAT_COLUMNS))


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header; quotes are doubled, null is an empty field and empty text is "".

    With `bom` every file starts with a byte order mark, for spreadsheet programs.
    """
    columns = df.columns
    if bom:
        columns = ["﻿" + columns[0], *columns[1:]]
    (
        df.toDF(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, record): the records of CSV files, also those that hold line breaks; `nth` counts from 1 in each file.

    Files are read in splits, by many tasks. A line begins a record if the quotes before it in its file are even in number.
    Each split counts its quotes, and its beginnings for either parity; the counts of the splits (one row each) tell the parity and the
    number of records that a split begins with. Lines of a broken record are then put together, in order; others are records as they are.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"), quotes.alias("quotes"),
    )
    split = Window.partitionBy("file", "block").orderBy("number")
    local = F.coalesce(F.sum("quotes").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("parity", local.cast("int"))
    begun = [F.count_if(F.col("parity") == k).over(split.rowsBetween(Window.unboundedPreceding, 0)).alias(f"begun{k}") for k in (0, 1)]
    lines = lines.select("*", *begun)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"), *(F.count_if(F.col("parity") == k).alias(f"n{k}") for k in (0, 1)))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("odd", (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).cast("int"))
    starts = F.coalesce(F.sum(F.when(F.col("odd") == 0, F.col("n0")).otherwise(F.col("n1"))).over(before), F.lit(0))
    known = lines.join(splits.select("file", "block", "odd", starts.alias("starts")), ["file", "block"])
    nth = F.col("starts") + F.when(F.col("odd") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    opened = (F.col("parity") + F.col("odd")) % 2
    known = known.select("file", "block", "number", "value", nth.alias("nth"), ((opened == 0) & (F.col("quotes") % 2 == 0)).alias("whole"))
    parts = F.sort_array(F.collect_list(F.struct("block", "number", "value")))  # the lines of one record
    broken = known.filter("not whole").groupBy("file", "nth").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record"))
    return known.filter("whole").select("file", "nth", F.col("value").alias("record")).unionByName(broken)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads what `write_csv` wrote, empty text and null kept apart; a file of any size is read by many tasks."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    row = F.from_csv("record", ddl, {"nullValue": "\u0000", "escape": '"'})
    # the first record of a file names the columns
    return csv_records(spark, path).filter("nth > 1").select(row.alias("row")).select("row.*")


def slice_csv(rows: DataFrame) -> DataFrame:
    """The downloaded columns of a winners slice."""
    return rows.select(*SLICE_COLUMNS)
