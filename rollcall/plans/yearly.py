"""Year-by-year upkeep of the marts: only years whose rows have changed are made again.

The marts of a target are a commit log (`commits`). A part is one year of one mart, or of the changes since the year before; the
commit also keeps, for every year, a digest of the conformed rows that it was made from. A refresh takes the digests in one
scan, combined before the shuffle, and makes the marts of the years that differ, from those years' partitions alone. Parts of
the other years stay where they are. All of a refresh is one commit, so readers see the old marts or the new ones.

The change since the year before also depends on that year. A series may lack years, so the year that follows a changed one is
looked up in every series, as it was and as it is now.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators import changes, marts, slices
from ..session import scratch_scope
from ..sources import commits

#: Marts whose rows are made from rows of one year, beside those of `marts.median_marts`.
SIMPLE = {
    "gold_education_dist": marts.education_dist,
    "gold_age_dist": marts.age_dist,
    "gold_education_state": marts.education_by_state,
    "gold_age_state": marts.age_by_state,
}
#: Series -> the marts of its changes, and the keys of one series.
DELTAS = {
    "gold_national_trends": ("gold_national_changes", ["cohort"]),
    "gold_state_trends": ("gold_state_changes", ["state", "cohort"]),
}
_DIGEST = "digest"


def _year_name(year: Column) -> Column:
    return F.coalesce(year.cast("string"), F.lit("none"))


def _digests(silver: DataFrame) -> dict[str, dict]:
    """Digest of every year's rows, but for the columns that tell when they were made: a row for each year."""
    found = changes.content_hash(silver.select(*(c for c in silver.columns if not c.startswith("_"))), ["election_year"]).select(_year_name(F.col("election_year")).alias("year"), "n", "h1", "h2")
    return {r["year"]: {"n": r["n"], "h1": str(r["h1"]), "h2": str(r["h2"])} for r in found.collect()}


def _write(df: DataFrame, target: str, mart: str) -> dict[str, dict]:
    """Writes rows by year into a folder of their own; the parts that this gives."""
    folder = f"{uuid.uuid4().hex}.{mart}"
    df.withColumn("_year", _year_name(F.col("election_year"))).repartition("_year").write.partitionBy("_year").parquet(f"{target}/data/{folder}")
    years = [n.split("=", 1)[1] for n in commits.listed(df.sparkSession, f"{target}/data/{folder}") if n.startswith("_year=")]
    return {f"{mart}/{y}": {"folder": folder, "schema": df.schema.json()} for y in years}


def _scan(spark: SparkSession, target: str, parts: dict[str, dict], mart: str) -> DataFrame | None:
    held = {n.split("/", 1)[1]: p for n, p in parts.items() if n.startswith(f"{mart}/")}
    if not held:
        return None
    schema = T.StructType.fromJson(json.loads(next(iter(held.values()))["schema"]))
    paths = [f"{target}/data/{p['folder']}/_year={y}" for y, p in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)


def _followers(series: list[DataFrame], keys: list[str], years: list[str]) -> list[str]:
    """`years`, and the years that come right after one of them in a series."""
    touched = _year_name(F.col("_before")).isin(years) & F.col("_before").isNotNull()
    before = F.lag("election_year").over(Window.partitionBy(*keys).orderBy("election_year"))
    placed = [s.select(*keys, "election_year", before.alias("_before")).filter(touched).select("election_year") for s in series]
    found = reduce(DataFrame.union, placed).distinct() if placed else None
    return sorted({*years, *(str(r[0]) for r in (found.collect() if found is not None else []))})  # a row for each year


def refresh_years(spark: SparkSession, silver: DataFrame, target: str) -> DataFrame:
    """Brings the marts of `target` up to `silver`; (mart, year, status) of the parts that were made again or removed.

    `silver` should be a table partitioned by year, as it is read for the digests and again for the changed years. A year that
    is gone loses its parts. One run refreshes at a time; the later of two fails and changes nothing.
    """
    before = commits.newest(spark, target)
    was = {n.split("/", 1)[1]: p for n, p in before.parts.items() if n.startswith(f"{_DIGEST}/")}
    now = _digests(silver)
    changed = sorted(y for y, d in now.items() if {k: was.get(y, {}).get(k) for k in d} != d)
    gone = sorted(set(was) - set(now))
    report: list[tuple[str, str, str]] = []
    if changed or gone:
        parts = {n: p for n, p in before.parts.items() if n.split("/", 1)[1] not in {*changed, *gone}}
        with scratch_scope(spark):
            if changed:
                rows = silver.filter(_same_year(changed))
                made = {**marts.median_marts(rows), **{name: build(rows) for name, build in SIMPLE.items()}}
                for name, df in made.items():
                    parts |= _write(df, target, name)
            for mart, (delta, keys) in DELTAS.items():
                held = [_scan(spark, target, p, mart) for p in (before.parts, parts)]
                years = _followers([s for s in held if s is not None], keys, [*changed, *gone])
                parts = {n: p for n, p in parts.items() if not (n.startswith(f"{delta}/") and n.split("/", 1)[1] in years)}
                if held[1] is not None:
                    figures = slices.kpi_delta(held[1], keys).filter(_same_year(years))
                    parts |= _write(figures, target, delta)
        parts |= {f"{_DIGEST}/{y}": {"folder": "", **d} for y, d in now.items()}
        if not commits.commit(spark, target, commits.Snapshot(before.number + 1, parts)):
            raise RuntimeError("another run has refreshed meanwhile")
        shown = lambda p: {n: v["folder"] for n, v in p.items() if not n.startswith(f"{_DIGEST}/")}
        old, new = shown(before.parts), shown(parts)
        for name in sorted({*old, *new}):
            if old.get(name) != new.get(name):
                status = "new" if name not in old else "removed" if name not in new else "updated"
                report.append((*name.split("/", 1), status))
    return spark.createDataFrame(report, "mart string, year string, status string")


def _same_year(years: list[str]) -> Column:
    """Rows of the named years, as a filter that prunes partitions."""
    known = [int(y) for y in years if y != "none"]
    test = F.col("election_year").isin(known) if known else F.lit(False)
    return test | F.col("election_year").isNull() if "none" in years else test


def read_mart(spark: SparkSession, target: str, mart: str) -> DataFrame:
    """All years of a mart as of the newest commit; KeyError if it has none."""
    found = _scan(spark, target, commits.newest(spark, target).parts, mart)
    if found is None:
        raise KeyError(mart)
    return found
