"""Page files -> typed rows as they land, and the pages that gave none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import extract
from ..session import scratch_scope, stage
from ..sources import files, schemas, tables


def rows_of_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate rows in the landing schema, and (source_url, election_year, constituency_id, reason) of rejected pages.

    A page that cannot be read never stops the others. Every page is parsed once: what was read of it is written down, and
    rows and rejects are both made from that.
    """
    parsed = stage(extract.parse_pages(pages), "parsed-pages")
    rows, bad = extract.explode_parsed(parsed), extract.rejected_parsed(parsed)
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CANDIDATE])
    return typed, bad.select("source_url", "election_year", "constituency_id", "reason")


def land_pages(spark: SparkSession, folder: str, source: str, at: str, name_pattern: str | None = None) -> None:
    """All pages of a folder into the landing table, rejected ones into a table beside it."""
    pages = files.read_pages(spark, folder, name_pattern) if name_pattern else files.read_pages(spark, folder)
    with scratch_scope(spark):
        rows, rejects = rows_of_pages(pages)
        tables.save_table(tables.with_lineage(rows, source, at), "bronze_candidates")
        tables.save_table(tables.with_lineage(rejects, source, at), "bronze_rejects")
