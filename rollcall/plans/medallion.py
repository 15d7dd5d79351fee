"""The whole run: raw rows -> silver -> marts -> published files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import conform, dedupe, marts, quality
from ..session import scratch_scope, stage
from ..sources import exports, tables


def conformed_rows(raw: DataFrame, keep_special: bool = False) -> DataFrame:
    """Row-level steps and the party group. Bye-election rows never help a party qualify."""
    rows = conform.conform(raw if keep_special else conform.general_only(raw))
    return conform.party_group(rows, conform.qualifying_labels(conform.general_only(rows)))


def build_silver(raw: DataFrame, keep_special: bool = False) -> DataFrame:
    """One conformed row per candidate, seat and year. Columns that no row is chosen by are made of the chosen rows alone, so
    that they are neither sorted nor shuffled."""
    judged = conform.conform_judged(raw if keep_special else conform.general_only(raw))
    rows = conform.conform_rest(dedupe.dedupe_candidates(judged))
    return conform.party_group(rows, conform.qualifying_labels(conform.general_only(judged)))


MARTS = {
    "gold_national_trends": marts.national_trends,
    "gold_party_summary": marts.party_summary,
    "gold_state_summary": marts.state_summary,
    "gold_education_dist": marts.education_dist,
    "gold_age_dist": marts.age_dist,
    "gold_winners": marts.winners_view,
    "gold_leaderboards": marts.leaderboards,
    "gold_repeat_candidates": marts.repeat_entities,
    "gold_state_trends": marts.state_trends,
    "gold_party_state": marts.party_by_state,
    "gold_education_state": marts.education_by_state,
    "gold_age_state": marts.age_by_state,
}


def mart_order() -> dict[str, list[Column]]:
    """Published order of every mart."""

    def up(*names: str) -> list[Column]:
        return [F.col(n).asc_nulls_last() for n in names]

    def down(name: str) -> Column:
        return F.col(name).desc_nulls_last()

    return {
        "gold_national_trends": up("cohort", "election_year"),
        "gold_party_summary": [*up("election_year"), down("seats_won"), *up("party_group")],
        "gold_state_summary": [*up("election_year"), down("seats"), *up("state")],
        "gold_education_dist": up("election_year", "education_group"),
        "gold_age_dist": up("election_year", "age_band"),
        "gold_winners": up("election_year", "state", "constituency", "candidate_id", "name"),
        "gold_leaderboards": up("board", "election_year", "rank"),
        "gold_repeat_candidates": [down("asset_growth_pct"), *up("name", "state")],
        "gold_state_trends": up("state", "cohort", "election_year"),
        "gold_party_state": [*up("state", "election_year"), down("seats_won"), *up("party_group")],
        "gold_education_state": up("state", "election_year", "education_group"),
        "gold_age_state": up("state", "election_year", "age_band"),
    }


def build_marts(silver: DataFrame) -> dict[str, DataFrame]:
    """All marts; those with a median share their two scans."""
    medians = marts.median_marts(silver)
    return {name: medians[name] if name in medians else build(silver) for name, build in MARTS.items()}


# Published section names and the marts they hold.
PAYLOADS = {
    "summary": {
        "national_trends": "gold_national_trends",
        "party_summary": "gold_party_summary",
        "state_summary": "gold_state_summary",
        "education_dist": "gold_education_dist",
        "age_dist": "gold_age_dist",
    },
    "winners": {"winners": "gold_winners"},
    "leaderboards": {"entries": "gold_leaderboards"},
    "repeat_candidates": {"candidates": "gold_repeat_candidates"},
    "states": {
        "state_trends": "gold_state_trends",
        "party_by_state": "gold_party_state",
        "education_by_state": "gold_education_state",
        "age_by_state": "gold_age_state",
    },
}
PUBLISHED_REPEATS = 500


def payload_sections(payload: str, built: dict[str, DataFrame]) -> dict[str, exports.Section]:
    order = mart_order()
    sections = {}
    for section, mart in PAYLOADS[payload].items():
        df = built[mart]
        if mart == "gold_repeat_candidates":
            df = df.orderBy(*order[mart]).limit(PUBLISHED_REPEATS)
        sections[section] = (df, order[mart])
    return sections


def ingest(raw: DataFrame, source: str, at: str, full_run: bool = True) -> None:
    """Land the raw rows; a full run that looks truncated stops here."""
    tables.save_table(tables.with_lineage(raw, source, at), "bronze_candidates")
    if full_run:
        landed = tables.read_table(raw.sparkSession, "bronze_candidates")
        quality.require(quality.completeness_violations(landed), "ingest looks truncated")


def refresh(spark: SparkSession, schema: str) -> None:
    """Silver and marts out of the landed rows, as tables of `schema`."""
    tables.ensure_schema(spark, schema)
    with scratch_scope(spark):
        silver = build_silver(tables.read_table(spark, "bronze_candidates"))
        tables.save_table(tables.with_processed_at(silver), "silver_candidates", "election_year")
        for name, df in build_marts(tables.read_table(spark, "silver_candidates")).items():
            tables.save_table(df, name)


def publish(spark: SparkSession, folder: str, generated_at: str, source: str) -> DataFrame:
    """JSON rows per section, the meta row and the flat CSV out of the tables; (section, status) of this run.

    One payload: readers see all of it change at once, and find its sections by `exports.section_path`. The time of
    generation in the meta row does not count as a change.
    """
    built = {name: tables.read_table(spark, name) for name in MARTS}
    sections = {f"{payload}/{name}": section for payload in PAYLOADS for name, section in payload_sections(payload, built).items()}
    with scratch_scope(spark):
        everything = stage(build_silver(tables.read_table(spark, "bronze_candidates"), keep_special=True), "everything")
        sections["candidates"] = (exports.flat_export(everything), [])
        return exports.publish_changed(sections, folder, ["candidates"], {"meta": exports.run_meta(everything, generated_at, source)})
