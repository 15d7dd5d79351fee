"""The fund tables: deduplicated, joined to seat holders, reconciled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import ratio
from ..operators import dedupe, extract, matching, reconcile
from ..session import scratch_scope, stage
from ..sources import exports, files

# Columns of the joined fund rows.
FUND_COLUMNS = [
    "state", "constituency", "mp_id", "mp_name", "allocated", "expenditure", "pct_spent",
    "works_recommended", "works_sanctioned", "works_completed", "party", "party_group",
    "criminal_cases", "assets", "candidate_id", "winner_name", "match_kind", "similarity",
    "name_similarity", "holder_differs", "fund_seat",
]


def conform_funds(raw: DataFrame) -> DataFrame:
    """One conformed state spelling; the share spent where the source gives none."""
    rows = raw.withColumn("state", matching.conform_fund_state(F.col("state")))
    return rows.withColumn("pct_spent", extract.pct_spent())


def joined_funds(raw: DataFrame, silver: DataFrame, metric: str = "ratcliff") -> DataFrame:
    """One row per seat with its holder's attributes and how the match was made."""
    funds = matching.with_place_key(dedupe.dedupe_funded(conform_funds(raw)))
    holders = matching.seat_holders(silver)
    return matching.join_holders(
        stage(funds, "funds"), stage(holders, "holders"), metric=metric
    ).select(*FUND_COLUMNS)


def unmatched(joined: DataFrame) -> DataFrame:
    """Seats for which no holder was found."""
    return joined.filter("match_kind IS NULL").select("state", "constituency", "mp_name")


def fund_sections(joined: DataFrame, compared: DataFrame) -> dict[str, exports.Section]:
    """Published sections: every seat, state shares, and all that needs a reader's eye."""
    share = F.coalesce(F.col("pct_spent"), F.lit(0.0)).desc()
    seat = [F.asc("state"), F.asc("constituency")]
    return {
        "mps": (joined, [share, *seat, F.asc("mp_id")]),
        "state_utilization": (reconcile.state_utilisation(joined), [F.desc("pct_spent"), F.asc("state")]),
        "mp_changed": (matching.holder_changes(joined), seat),
        "unmatched": (unmatched(joined), [*seat, F.asc("mp_name")]),
        "fuzzy_joins": (matching.fuzzy_matches(joined), [F.asc("state"), F.asc("fund_seat")]),
        "comparisons": (compared, [F.asc("metric")]),
    }


def publish_funds(
    raw: DataFrame,
    silver: DataFrame,
    theirs: DataFrame,
    metrics: dict[str, tuple[str, str]],
    folder: str,
    documents: DataFrame | None = None,
) -> DataFrame:
    """The fund payload, the match report and the other source's audit as JSON rows; (section, status) of this run.

    With the other source's document (`documents`, one row of JSON text in `value`), also our totals beside its own
    (`reconciliation`) and what it says about itself (`reconciliation_about`). Sections that did not change since the last run are
    left as they are.
    """
    with scratch_scope(raw.sparkSession):
        return _publish_funds(raw, silver, theirs, metrics, folder, documents)


def _publish_funds(
    raw: DataFrame, silver: DataFrame, theirs: DataFrame, metrics: dict[str, tuple[str, str]], folder: str, documents: DataFrame | None
) -> DataFrame:
    funds = conform_funds(raw)
    joined = stage(joined_funds(raw, silver), "joined-funds")
    compared = reconcile.reconcile(joined, reconcile.comparable(theirs), metrics)
    report = matching.match_report(joined, dedupe.dedupe_report(funds, dedupe.SEAT_KEY))
    if "tenure" in raw.columns:
        report = report.withColumn("tenure", raw.agg(F.min("tenure").alias("tenure")).scalar())
    sections = fund_sections(joined, compared) | {
        "meta": (report, [F.asc("seats")]),
        "national": (national_totals(joined), [F.asc("allocated")]),
        "audit": (reconcile.consistency_audit(theirs), [F.asc("records_total")]),
    }
    if documents is not None:
        beside = crosscheck(joined, documents)
        sections["reconciliation"] = (beside.drop(*ABOUT), [F.asc("metric")])
        sections["reconciliation_about"] = (about_document(documents), [F.asc("records_total")])
    return exports.publish_changed(sections, folder)


def national_totals(joined: DataFrame) -> DataFrame:
    """One row: sums over all seats."""
    names = ["allocated", "expenditure", "works_recommended", "works_sanctioned", "works_completed"]
    sums = joined.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return sums.withColumn("pct_spent", extract.pct_spent())


# Compared totals -> (our column, name in the other source's audit, what a difference means).
AUDIT_TOTALS = {
    "Allocated to Lok Sabha MPs": ("allocated", "ls_allocated", "Equal totals show that both sources read the portal alike."),
    "Expenditure": ("expenditure", "ls_expenditure", "The portal is live; snapshots of different days differ a little."),
    "Works completed": ("works_completed", "ls_works_completed", "The sources may count different terms."),
    "Works recommended": ("works_recommended", "ls_works_recommended", "The portal's tile and a sum over members are defined differently."),
}

#: What the document says about itself: name -> (part, its key, type).
ABOUT = {
    "their_last_updated": ("sync", "lastUpdated", "string"),
    "their_update_frequency": ("sync", "updateFrequency", "string"),
    "their_quality_claim": ("sync", "dataQuality", "string"),
    "records_total": ("audit", "records_total", "bigint"),
    "records_lok_sabha": ("audit", "records_lok_sabha", "bigint"),
    "records_rajya_sabha": ("audit", "records_rajya_sabha", "bigint"),
    "inconsistent_records": ("audit", "records_completed_exceeds_recommended", "bigint"),
    "inconsistent_pct": ("audit", "pct_inconsistent", "double"),
}


def _said(name: str, text: str) -> Column:
    part, key, kind = ABOUT[name]
    found = F.get_json_object(files.unwrap(F.get_json_object(text, f"$.{part}")), f"$.{key}")
    return (found if kind == "string" else found.try_cast(kind)).alias(name)


def about_document(documents: DataFrame, text: str = "value") -> DataFrame:
    """Update time and frequency, the claim of quality, members of both houses, and rows that contradict themselves."""
    return documents.select(*(_said(name, text) for name in ABOUT))


def crosscheck(joined: DataFrame, documents: DataFrame, text: str = "value") -> DataFrame:
    """Our totals beside those of the other source's document (one row, JSON text with the keys audit and sync).

    Both parts may stand in an envelope. One row per total that both sides have and that is not 0: metric, ours, theirs,
    delta, pct_delta, a note on what a difference means, and what the document says about itself.
    """
    audit = files.unwrap(F.get_json_object(text, "$.audit"))
    totals = []
    for metric, (_, key, note) in AUDIT_TOTALS.items():
        figure = F.get_json_object(audit, f"$.{key}").try_cast("decimal(28,4)")
        totals += [F.lit(metric), F.lit(note), F.round(figure, 0).cast("bigint")]
    theirs = documents.select(*(_said(name, text) for name in ABOUT), F.stack(F.lit(len(AUDIT_TOTALS)), *totals).alias("metric", "note", "theirs"))
    sums = joined.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"m{i}") for i, (c, *_) in enumerate(AUDIT_TOTALS.values())])
    pairs = [p for i, m in enumerate(AUDIT_TOTALS) for p in (F.lit(m), F.col(f"m{i}"))]
    ours = sums.select(F.stack(F.lit(len(AUDIT_TOTALS)), *pairs).alias("metric", "ours"))
    both = ours.join(theirs, "metric").filter("ours <> 0 AND theirs <> 0").withColumn("delta", F.col("ours") - F.col("theirs"))
    return both.withColumn("pct_delta", ratio(F.col("delta"), F.col("theirs"), 2, times=100))
