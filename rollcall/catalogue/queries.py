"""Every operator as a query over the shared test tables."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import lookups, parsing, similarity, text, values
from ..functions.measures import count_true, mean, rows, share, share_ge, total
from ..operators import (
    changes, conform, dedupe, extract, marts, matching, quality, reconcile, slices,
)
from ..operators.ranks import exact_quantiles
from ..operators.summary import exact_median, summarise
from ..plans import funds as fund_plan, medallion, pages as pages_plan, yearly
from ..session import stage
from ..sources import commits, exports, files, schemas, tables
from ..streaming import ingest, ledger, merge
from . import samples
from .samples import candidates, silver, table, wide_table

FIRST, LATEST = 1995, 2001
STATE = "Goa"
NEEDLE = "chi"


# ---- sources and sinks

def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = samples.written(spark, "jsonl")
    rows = candidates(spark, folder)
    files.write_jsonl(rows, path, by="election_year")
    return files.read_jsonl(spark, path, rows.schema).select(*rows.columns)


def scan_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One file per page, many to a folder; the year and a number out of the file's path."""
    path = samples.written(spark, "pages")
    pages = table(spark, folder, "pages").select((F.col("page_id") % 5 + 2000).alias("year"), "html")
    pages.write.partitionBy("year").option("maxRecordsPerFile", 1).text(path)
    read = files.read_pages(spark, path, r"year=(\d+)/part-(\d+)-")
    body = F.regexp_replace("html", r"\n$", "")
    return read.filter(F.col("constituency_id").isNotNull()).select(
        "election_year", F.length(body).alias("n_chars"), F.md5(body).alias("digest")
    )


def lineage_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.with_lineage(table(spark, folder, "orders"), "orders feed", "2024-08-01 10:30:00")
    return rows.select("o_orderkey", "_source", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss").alias("_ingested_at"))


def table_roundtrip(spark: SparkSession, folder: str, partition_by: str | None = None) -> DataFrame:
    path = samples.written(spark, "table")
    name = "rollcall_" + path.rsplit("-", 1)[1]
    tables.save_table(candidates(spark, folder), name, partition_by, path)
    return tables.read_table(spark, name)


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return table_roundtrip(spark, folder, "election_year")


def schema_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Marts made from silver in a schema of its own, listed by name with their rows; a table that is no mart is not listed."""
    before = spark.catalog.currentDatabase()
    schema = "rollcall_" + samples.written(spark, "schema").rsplit("-", 1)[1]
    tables.ensure_schema(spark, schema)
    rows = silver(spark, folder)
    made = {"gold_winners": marts.winners_view, "gold_education_state": marts.education_by_state, "gold_age_dist": marts.age_dist, "silver_years": lambda df: df.select("election_year").distinct()}
    for name, build in made.items():
        tables.save_table(build(rows), name)
    listed = [r["tableName"] for r in tables.list_marts(spark, schema=schema).collect()]  # names
    counts = [tables.read_table(spark, f"{schema}.{n}").agg(F.lit(n).alias("mart"), F.count(F.lit(1)).alias("n_rows")) for n in listed]
    spark.sql(f"USE {before}")
    return functools.reduce(DataFrame.union, counts)


def typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Fund rows given as literals, with a fixed schema, beside what the orders of their seat numbers came to."""
    literal = [
        {"state": "Goa", "constituency": "one", "mp_id": 1, "allocated": 500, "pct_spent": 12.5},
        {"state": "Kerala", "constituency": "two", "mp_id": 2, "works_completed": 7},
        {"constituency": None, "mp_id": 4},
        {"state": "Goa", "mp_id": -1},
    ]
    given = tables.from_rows(spark, literal, schemas.FUND).select("state", "mp_id", "allocated", "pct_spent", "works_completed")
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").cast("int").alias("mp_id"))
    held = orders.agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    return given.join(held, "mp_id", "left")


def document_read(spark: SparkSession, folder: str) -> DataFrame:
    """A section read back in published order, and the run's meta document beside it."""
    path = samples.written(spark, "document")
    dist = marts.age_dist(silver(spark, folder))
    exports.write_payload({"age_dist": (dist, [F.col("election_year"), F.col("age_band")])}, path)
    meta = exports.run_meta(candidates(spark, folder), "2024-08-01T00:00:00Z", "orders")
    meta.write.json(f"{path}/meta")
    source = files.read_document(spark, f"{path}/meta").select("source")
    row = F.from_json("body", "election_year int, age_band string, candidates long, winners long").alias("row")
    return exports.read_section(spark, f"{path}/age_dist").select(F.col("position").cast("int").alias("position"), row).select(
        "position", "row.*", source.scalar().alias("source")
    )


def envelope_unwrap(spark: SparkSession, folder: str) -> DataFrame:
    props = F.col("props")
    body = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"success":true,"data":'), props, F.lit("}")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"other":1,"data":'), props, F.lit("}")))
        .when(F.col("event_id") % 4 == 2, F.lit('{"success":false,"data":null,"cached":true}'))
        .otherwise(props)
    )
    inner = files.unwrap(body)
    return table(spark, folder, "events").select(
        "event_id",
        F.get_json_object(inner, "$.k").cast("int").alias("k"),
        F.array_join(F.json_object_keys(inner), ",").alias("keys"),
    )


def export_json_safe(spark: SparkSession, folder: str) -> DataFrame:
    value = (
        F.when(F.col("event_id") % 5 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 7 == 0, F.lit(float("inf")))
        .otherwise(F.col("value") / 3)
    )
    return exports.json_safe(
        table(spark, folder, "events").select("event_id", "ts", value.alias("value"), "event_type")
    )


def export_payload(spark: SparkSession, folder: str) -> DataFrame:
    """All published sections, read back with the place of every row."""
    path = samples.written(spark, "payload")
    built = medallion.build_marts(silver(spark, folder))
    sections = {f"{p}/{n}": x for p in medallion.PAYLOADS for n, x in medallion.payload_sections(p, built).items()}
    exports.write_payload(sections, path)
    parts = [
        exports.read_section(spark, f"{path}/{name}").select(F.lit(name).alias("section"), F.col("position").cast("int").alias("position"), "body")
        for name in sections
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def publish_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of the publishing plan over tables of a schema of their own; between them one year's winners lose their cases
    in the two marts that list people. Also the rows that the second payload has of each section, read back.
    """
    path, schema = samples.written(spark, "published"), "rollcall_" + samples.written(spark, "schema").rsplit("-", 1)[1]
    before = spark.catalog.currentDatabase()
    rows = silver(spark, folder)
    fewer = rows.withColumn(
        "criminal_cases", F.when((F.col("election_year") == LATEST) & F.col("is_winner"), 0).otherwise(F.col("criminal_cases"))
    )
    tables.ensure_schema(spark, schema)
    tables.save_table(candidates(spark, folder), "bronze_candidates")

    def publish(built: dict[str, DataFrame], at: str) -> DataFrame:
        for name, df in built.items():
            tables.save_table(df, name)
        return medallion.publish(spark, path, at, "orders")

    first = publish(medallion.build_marts(rows), "2024-08-01T00:00:00Z").withColumnRenamed("status", "first_run")
    listing = {n: medallion.MARTS[n](fewer) for n in ("gold_winners", "gold_leaderboards")}
    second = publish(listing, "2024-08-02T00:00:00Z").withColumnRenamed("status", "second_run")
    spark.sql(f"USE {before}")
    parts = commits.newest(spark, path).parts
    counted = [spark.read.text(exports.section_path(spark, path, n)).agg(F.lit(n).alias("section"), F.count("value").alias("n_rows")) for n in sorted(parts) if n not in ("meta", "candidates")]
    flat = exports.read_csv(spark, exports.section_path(spark, path, "candidates"), exports.flat_export(rows).schema)
    counted.append(flat.agg(F.lit("candidates").alias("section"), F.count(F.lit(1)).alias("n_rows")))
    return first.join(second, "section").join(functools.reduce(DataFrame.union, counted), "section")


def export_flat(spark: SparkSession, folder: str) -> DataFrame:
    path = samples.written(spark, "flat")
    flat = exports.flat_export(medallion.build_silver(candidates(spark, folder), keep_special=True))
    exports.write_csv(flat, path)
    return exports.read_csv(spark, path, flat.schema)


def slice_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = samples.written(spark, "slice")
    rows = exports.slice_csv(slices.winners_slice(marts.winners_view(silver(spark, folder)), LATEST))
    exports.write_csv(rows, path, bom=True)
    return exports.read_csv(spark, path, rows.schema)


def run_meta(spark: SparkSession, folder: str) -> DataFrame:
    meta = exports.run_meta(candidates(spark, folder), "2024-08-01T00:00:00Z", "orders")
    return meta.withColumn("election_years", F.array_join("election_years", ","))


def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots of a window that moved on by a year, urgent orders priced anew; some keys are null."""
    key = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    orders = table(spark, folder, "orders").withColumns({"order_year": F.year("o_orderdate"), "o_custkey": key})
    raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    old = orders.filter(F.col("order_year") < LATEST).withColumn("o_totalprice", raised)
    new = orders.filter(F.col("order_year") > FIRST)
    return changes.snapshot_diff(new, old, ["o_custkey", "order_year"])


# ---- extraction

def html_clean(spark: SparkSession, folder: str) -> DataFrame:
    return wide_table(spark, folder, "pages").select("page_id", text.clean_html(F.col("html")).alias("text"))


def page_header(spark: SparkSession, folder: str) -> DataFrame:
    pages = samples.candidate_pages(spark, folder)
    return pages.select("entry_id", extract.page_header(F.col("html")).alias("h")).select("entry_id", "h.*")


def page_special_flag(spark: SparkSession, folder: str) -> DataFrame:
    pages = samples.candidate_pages(spark, folder)
    return (
        pages.select("entry_id", extract.page_header(F.col("html"))["state"].alias("state"))
        .select("entry_id", extract.special_contest(F.col("state")).alias("c"))
        .select("entry_id", "c.*")
    )


LIST_BLOCK = {"block": r"(?is)<ul.*?</ul>", "row": r"(?is)<li>(.*?)</li>"}


SCARCE_BLOCK = {
    "block": r"(?is)<ul.*?</ul>",
    "row": r'(?is)<li><a href="/[a-z]{11,}">(.*?)</a>',
}


def best_block(spark: SparkSession, folder: str) -> DataFrame:
    rows = extract.best_block(F.col("html"), **LIST_BLOCK)
    return wide_table(spark, folder, "pages").select(
        "page_id", F.size(rows).alias("n_rows"), F.array_join(rows, "|").alias("rows")
    )


def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    return extract.explode_rows(samples.candidate_pages(spark, folder))


def link_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Seat links of index pages, one page per state and year."""
    link = F.concat(F.lit('<a href="index.php?action=show&constituency_id='), F.col("constituency_id").cast("string"), F.lit('">seat 7</a>'))
    pages = candidates(spark, folder).groupBy("state", "election_year").agg(F.array_join(F.collect_set(link), " 12 ").alias("html"))
    found = pages.select("state", "election_year", "html", parsing.parse_link_ids(F.col("html"), lookups.SEAT_LINK).alias("ids"))
    return found.select(
        "state", "election_year", (parsing.parse_link_id(F.col("html"), lookups.SEAT_LINK).isNotNull()).alias("has_first"),
        F.size("ids").alias("n_ids"), F.array_join("ids", ",").alias("ids"), quality.is_scarce("ids", 3).alias("is_scarce"),
    )


def bronze_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a whole seat to typed rows in the landing schema."""
    return pages_plan.rows_of_pages(samples.seat_pages(spark, folder))[0]


def bronze_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return pages_plan.rows_of_pages(samples.seat_pages(spark, folder))[1]


def seats_not_named(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of pages whose seat is not the one that the page's link names."""
    rows = bronze_from_pages(spark, folder)
    named = F.regexp_replace("source_url", r"^.*#", "")
    return quality.seats_not_named(rows, named).select("source_url", "constituency", "name")


def parse_money(spark: SparkSession, folder: str) -> DataFrame:
    cells = samples.money_cells(spark, folder)
    return cells.select("o_orderkey", "cell", parsing.parse_money(F.col("cell")).alias("figure"))


def parse_int(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", parsing.parse_int(F.col("props")).alias("k"))


def parse_amount(spark: SparkSession, folder: str) -> DataFrame:
    cell = F.concat(F.lit("₹ "), F.col("value").cast("string"))
    return table(spark, folder, "events").select("event_id", parsing.parse_amount(cell).alias("amount"))


def _fund_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One nested document per fund row: state -> seat -> member -> tiles."""

    def money(name: str) -> Column:
        shown = F.concat(F.lit("₹"), values.group_indian(F.col(name)), F.lit(".11"))
        return F.when(F.col(name).isNull(), "—").otherwise(shown)

    captions = list(lookups.FUND_TILES)
    works = [
        F.array(F.col(f"works_{kind}").cast("string"), money("expenditure"), F.lit("pretty"))
        for kind in ("recommended", "sanctioned", "completed")
    ]
    known = F.map_from_arrays(
        F.array(*[F.lit(c) for c in captions]),
        F.array(F.array(money("allocated")), F.array(money("expenditure")), *works),
    )
    tiles = F.map_filter(known, lambda c, _: (c != captions[3]) | (F.col("mp_id") % 7 != 0))
    def member(more: int) -> Column:
        return F.struct((F.col("mp_id") + more).alias("id"), F.concat(F.col("mp_name"), F.lit(" ")).alias("name"), tiles.alias("tiles"))

    def seat(more: int, *members: Column) -> Column:
        return F.struct((F.col("mp_id") + 1 + more).alias("id"), F.col("constituency").alias("name"), F.array(*members).alias("members"))

    seats = F.array(seat(0, member(0), member(10**6)), seat(10**7, member(2 * 10**6)))
    return samples.funds(spark, folder).select(
        F.lit("18th term").alias("tenure"), "state", (F.col("mp_id") % 25).alias("state_id"), seats.alias("seats")
    )


def flatten_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    return extract.flatten_hierarchy(_fund_documents(spark, folder))


def tile_columns(spark: SparkSession, folder: str) -> DataFrame:
    members = F.flatten(F.transform("seats", lambda s: s["members"]))
    each = _fund_documents(spark, folder).select(F.explode(members).alias("member"))
    return each.select(F.col("member.id").alias("mp_id"), *extract.pivot_tiles(F.col("member.tiles")))


# ---- conformed rows

def general_only(spark: SparkSession, folder: str) -> DataFrame:
    return conform.general_only(candidates(spark, folder))


def tidy_text(spark: SparkSession, folder: str) -> DataFrame:
    return wide_table(spark, folder, "documents").select(
        "doc_id", text.tidy(F.col("text")).alias("text"), text.label(F.col("source")).alias("label")
    )


def title_case(spark: SparkSession, folder: str) -> DataFrame:
    return wide_table(spark, folder, "documents").select("doc_id", text.title_case(F.col("text")).alias("text"))


def conform_state(spark: SparkSession, folder: str) -> DataFrame:
    return (
        candidates(spark, folder)
        .groupBy("state", text.conform_state(F.col("state")).alias("conformed"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def seat_category(spark: SparkSession, folder: str) -> DataFrame:
    seat = text.tidy(F.col("constituency"))
    return (
        candidates(spark, folder)
        .groupBy(
            "constituency",
            text.seat_category(seat).alias("category"),
            text.strip_seat_tag(seat).alias("seat"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def education_rank(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).withColumn("raw", F.col("education"))
    return (
        conform.rank_education(rows)
        .groupBy("raw", "education", "education_rank", "education_group")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def derive_measures(spark: SparkSession, folder: str) -> DataFrame:
    return conform.derive_measures(candidates(spark, folder)).select(
        "election_year", "candidate_id", "name", "assets", "liabilities", "net_worth", "is_crorepati",
        "criminal_cases", "has_criminal_case", "age",
    )


def age_band(spark: SparkSession, folder: str) -> DataFrame:
    return (
        conform.derive_measures(candidates(spark, folder))
        .groupBy("age_band")
        .agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("youngest"), F.max("age").alias("oldest"))
    )


def party_group(spark: SparkSession, folder: str) -> DataFrame:
    return (
        medallion.conformed_rows(candidates(spark, folder))
        .groupBy("party", "party_group")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe_first(table(spark, folder, "events"), ["user_id", "event_type"], "event_id").select(
        "user_id", "event_type", "event_id", "value"
    )


def dedupe_report(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe_report(
        conform.conform(conform.general_only(candidates(spark, folder))), dedupe.CANDIDATE_KEY
    )


# ---- funds

def _holders(spark: SparkSession, folder: str) -> DataFrame:
    return matching.seat_holders(silver(spark, folder))


def _keyed_funds(spark: SparkSession, folder: str) -> DataFrame:
    rows = fund_plan.conform_funds(samples.funds(spark, folder))
    return matching.with_place_key(dedupe.dedupe_funded(rows))


def norm_key_join(spark: SparkSession, folder: str) -> DataFrame:
    holders = _holders(spark, folder).select("block", "key", F.col("name").alias("winner"), "candidate_id", "party_group")
    return matching.norm_key_join(_keyed_funds(spark, folder), holders).select(
        "mp_id", "block", "key", "winner", "candidate_id", "party_group", F.coalesce("_matched", F.lit(False)).alias("matched")
    )


def unmatched_rows(spark: SparkSession, folder: str) -> DataFrame:
    return matching.unmatched_rows(_keyed_funds(spark, folder), _holders(spark, folder)).select(
        "mp_id", "state", "constituency", "mp_name"
    )


def fuzzy_join(spark: SparkSession, folder: str, metric: str = "ratcliff") -> DataFrame:
    return matching.fuzzy_join(
        stage(_keyed_funds(spark, folder), "funds"), stage(_holders(spark, folder), "holders"), metric=metric
    )


def fuzzy_join_levenshtein(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_join(spark, folder, "levenshtein")


def name_match(spark: SparkSession, folder: str, metric: str = "ratcliff") -> DataFrame:
    pairs = samples.run_sql(spark, folder, samples.NAME_PAIRS)
    return similarity.with_name_similarity(pairs, "a", "b", "similarity", metric)


def name_match_levenshtein(spark: SparkSession, folder: str) -> DataFrame:
    return name_match(spark, folder, "levenshtein")


def joined_funds(spark: SparkSession, folder: str, metric: str = "ratcliff") -> DataFrame:
    return fund_plan.joined_funds(samples.funds(spark, folder), silver(spark, folder), metric)


def holder_changed(spark: SparkSession, folder: str) -> DataFrame:
    return matching.holder_changes(joined_funds(spark, folder))


def holder_changed_levenshtein(spark: SparkSession, folder: str) -> DataFrame:
    return matching.holder_changes(joined_funds(spark, folder, "levenshtein"))


def match_report(spark: SparkSession, folder: str) -> DataFrame:
    copies = dedupe.dedupe_report(fund_plan.conform_funds(samples.funds(spark, folder)), dedupe.SEAT_KEY)
    return matching.match_report(joined_funds(spark, folder), copies)


RECONCILED = {
    "Allocated": ("allocated", "allocatedAmount"),
    "Expenditure": ("expenditure", "totalExpenditure"),
    "Works completed": ("works_completed", "completedWorksCount"),
    "Works recommended": ("works_recommended", "recommendedWorksCount"),
}


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    ours = dedupe.dedupe_funded(fund_plan.conform_funds(samples.funds(spark, folder)))
    theirs = reconcile.comparable(samples.run_sql(spark, folder, samples.CROSS_CHECK))
    return reconcile.reconcile(ours, theirs, RECONCILED)


def published_comparisons(spark: SparkSession, folder: str) -> DataFrame:
    """What the fund plan wrote, given both houses."""
    path = samples.written(spark, "funds")
    theirs = samples.run_sql(spark, folder, samples.CROSS_CHECK)
    fund_plan.publish_funds(samples.funds(spark, folder), silver(spark, folder), theirs, RECONCILED, path)
    schema = "metric string, ours long, theirs long, delta long, pct_delta double"
    return exports.read_section(spark, exports.section_path(spark, path, "comparisons")).select(F.from_json("body", schema).alias("c")).select("c.*")


def _crosscheck_document(spark: SparkSession, folder: str, wrapped: bool) -> DataFrame:
    """A document of the other source, its parts in envelopes or plain."""
    audit = reconcile.consistency_audit(samples.run_sql(spark, folder, samples.CROSS_CHECK))
    renamed = audit.withColumnsRenamed(
        {f"subset_{n}": f"ls_{n}" for n in ("allocated", "expenditure", "works_completed", "works_recommended")}
        | {"records_subset": "records_lok_sabha", "records_other": "records_rajya_sabha"}
    )
    body = exports.json_rows(renamed)
    sync = F.lit('{"lastUpdated":"2024-08-01","updateFrequency":"daily","dataQuality":"as published"}')
    if wrapped:
        body = F.concat(F.lit('{"success":true,"data":'), body, F.lit(',"cached":false}'))
        sync = F.concat(F.lit('{"data":'), sync, F.lit("}"))
    path = samples.written(spark, "crosscheck")
    renamed.select(F.concat(F.lit('{"audit":'), body, F.lit(',"sync":'), sync, F.lit("}")).alias("value")).write.text(path)
    return spark.read.text(path, wholetext=True)


def crosscheck_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Our totals beside the other source's document, and what that says of itself, as the fund plan has published them."""
    path = samples.written(spark, "funds")
    theirs = samples.run_sql(spark, folder, samples.CROSS_CHECK)
    document = _crosscheck_document(spark, folder, wrapped=True)
    fund_plan.publish_funds(samples.funds(spark, folder), silver(spark, folder), theirs, RECONCILED, path, document)
    kinds = {
        "reconciliation": "metric string, ours long, note string, theirs long, delta long, pct_delta double",
        "reconciliation_about": ", ".join(f"{n} {kind}" for n, (_, _, kind) in fund_plan.ABOUT.items()),
    }
    read = [exports.read_section(spark, exports.section_path(spark, path, n)).select(F.from_json("body", kind).alias("c")).select("c.*") for n, kind in kinds.items()]
    about = read[1].select(F.struct("*").alias("about")).scalar()  # one row about the document
    return read[0].select("*", about.alias("about")).select(*read[0].columns, "about.*")


def crosscheck_plain(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a document without envelopes, unpublished."""
    ours = dedupe.dedupe_funded(fund_plan.conform_funds(samples.funds(spark, folder)))
    return fund_plan.crosscheck(ours, _crosscheck_document(spark, folder, wrapped=False))


# ---- slices

def _trends(spark: SparkSession, folder: str) -> DataFrame:
    return marts.national_trends(silver(spark, folder))


def _state_trends(spark: SparkSession, folder: str) -> DataFrame:
    return marts.state_trends(silver(spark, folder))


def refreshed_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Year-on-year changes kept up by year: made from a table that lacks one year and has another with old figures, then
    brought up to the whole one, which leaves the other years' parts alone."""
    target, rows = samples.written(spark, "yearly"), silver(spark, folder)
    old = rows.filter(F.col("election_year") != 1997)
    old = old.withColumn("assets", F.when(F.col("election_year") == 1994, F.col("assets") + 5).otherwise(F.col("assets")))
    for version in (old, rows):
        yearly.refresh_years(spark, version, target)
    return yearly.read_mart(spark, target, "gold_state_changes")


def trend_slice(spark: SparkSession, folder: str) -> DataFrame:
    mine = silver(spark, folder).filter(F.col("state") == STATE)
    return slices.trend_slice(marts.state_trends(mine), lookups.WINNERS, STATE)


def ordered_marts(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of two marts in published order: mixed directions, and falling with nulls last."""
    rows = silver(spark, folder)
    order = medallion.mart_order()
    path = samples.written(spark, "ordered")
    parts = {"party": (marts.party_summary(rows), order["gold_party_summary"]), "repeat": (marts.repeat_entities(rows), order["gold_repeat_candidates"])}
    exports.write_payload(parts, path)
    read = [exports.read_section(spark, f"{path}/{n}").select(F.lit(n).alias("mart"), F.col("position").cast("int").alias("position"), "body") for n in parts]
    return functools.reduce(DataFrame.unionByName, read).select(
        "mart", "position",
        F.coalesce(F.get_json_object("body", "$.party_group"), F.get_json_object("body", "$.name")).alias("label"),
        F.coalesce(F.get_json_object("body", "$.election_year"), F.get_json_object("body", "$.state")).alias("scope"),
    )


def _winners(spark: SparkSession, folder: str) -> DataFrame:
    return marts.winners_view(silver(spark, folder))


def slice_counts(spark: SparkSession, folder: str) -> DataFrame:
    this_year = _winners(spark, folder).filter(F.col("election_year") == LATEST)
    return slices.slice_counts(this_year, text.contains_any(NEEDLE, slices.WINNER_SEARCH))


def state_vs_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver(spark, folder)
    return slices.state_vs_all(
        marts.national_trends(rows), marts.state_trends(rows), quality.election_years(rows), lookups.WINNERS, "pct_criminal"
    )


def trend_spine(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver(spark, folder)
    return slices.trend_spine(
        marts.state_trends(rows), quality.election_years(rows), ["state", "cohort"], "median_assets"
    )


def missing_slices(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that lacks some states in some years."""
    rows = silver(spark, folder).filter((F.col("election_year") + F.length("state")) % 3 != 0)
    return slices.missing_slices(rows.filter("is_winner"), quality.election_years(silver(spark, folder)))


def dist_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """A year without rows has a row of zeros."""
    rows = silver(spark, folder)
    dist = marts.age_dist(rows.filter(F.col("election_year") != 1998))
    return slices.dist_matrix(dist, "age_band", lookups.AGE_BANDS, "winners", quality.election_years(rows))


def cohort_premium(spark: SparkSession, folder: str) -> DataFrame:
    """In the latest year, winners of some states have no median, and the field of others no crorepati share."""
    latest, odd = F.col("election_year") == LATEST, F.length("state") % 2 == 0
    won = F.col("cohort") == lookups.WINNERS
    series = _state_trends(spark, folder).withColumns(
        {
            "median_assets": F.when(~(latest & odd & won), F.col("median_assets")),
            "pct_crorepati": F.when(~(latest & ~odd & ~won), F.col("pct_crorepati")),
        }
    )
    return slices.cohort_premium(series, ["state"])


def measures(spark: SparkSession, folder: str) -> DataFrame:
    """The measure library over order lines: shares, averages and the exact median."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_tax") > 0, F.col("l_discount") > 0.05).alias("deep"),
    )
    return summarise(
        lines,
        ["l_returnflag", "l_linestatus"],
        {
            "n": rows(),
            "pct_deep": share(F.col("deep")),
            "pct_deep_of_all": share(F.col("deep"), null_as_false=True),
            "pct_large": share_ge(F.col("quantity"), 25),
            "n_deep": count_true(F.col("deep")),
            "avg_quantity": mean(F.col("quantity"), 2),
            "cents": total(F.col("cents")),
        },
        "cents",
        "median_cents",
    )


def measures_two_pass(spark: SparkSession, folder: str) -> DataFrame:
    """The mean of the two middle values."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    return exact_median(lines, ["l_returnflag"], "cents", "interp")


def quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quartiles and the first and last percent of order lines' prices."""
    shares = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    found = exact_quantiles(lines, ["l_returnflag", "l_linestatus"], "cents", list(shares.values()))
    return found.select("l_returnflag", "l_linestatus", "n", *(F.col("quantiles")[i].alias(n) for i, n in enumerate(shares)))


def format_money(spark: SparkSession, folder: str) -> DataFrame:
    figure = F.col("figure")
    figures = samples.run_sql(spark, folder, samples.FIGURES, orders=wide_table(spark, folder, "orders"))
    return figures.select(
        "o_orderkey",
        values.format_inr(figure).alias("short"),
        values.group_indian(figure).alias("grouped"),
        values.format_percent(figure % 1000 / 10).alias("percent"),
    )


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders taken in as a file stream, twice; the second run finds nothing new."""
    target = samples.written(spark, "ingested")
    checkpoint = samples.written(spark, "ingest-checkpoint")

    def prepare(orders: DataFrame) -> DataFrame:
        return samples.run_sql(spark, folder, samples.CANDIDATES, orders=orders)

    schema = table(spark, folder, "orders").schema
    for _ in range(2):
        ingest.ingest_new(
            spark, f"{folder}/orders.parque[t]", schema, target, checkpoint, "parquet", prepare
        )
    return spark.read.parquet(target)


def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The highest event per user and type, merged from files that arrive in waves, the last of which restates old rows.

    The third wave is taken in by a stream with a new checkpoint, which begins with batch 0 again and reads all waves so far;
    then the first batch of rows comes once more by hand.
    """
    source, target, first, second = (samples.written(spark, n) for n in ("arriving", "merged", "merge-checkpoint", "merge-restart"))
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    restated = events.filter("event_id % 10 = 3").withColumn("value", F.col("value") + 5)
    keys = ["user_id", "event_type"]

    def best(rows: DataFrame) -> DataFrame:
        order = [F.col("value").desc_nulls_last(), F.col("event_id").asc()]
        return dedupe.keep_best(rows, keys, order)

    for k, wave in enumerate([*(events.filter(F.col("event_id") % 3 == k) for k in range(3)), restated]):
        wave.write.parquet(f"{source}/wave={k}")
        checkpoint = first if k < 2 else second
        merge.stream_best(spark, f"{source}/wave=*", events.schema, target, checkpoint, best, keys, "parquet", max_files=64)
    merge.merge_best(events.filter(F.col("event_id") % 3 == 0), 0, target, best, keys)
    return merge.read_best(spark, target, events.schema).select("user_id", "event_type", "event_id", "value")


#: Page files that a folder of `restated_pages` holds, about.
SHELF_FILES = 500


def restated_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of pages taken in as files: then some come again unchanged under new names, and some with another text."""
    source, target = samples.written(spark, "page-files"), samples.written(spark, "page-ledger")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = table(spark, folder, "pages")
    shelves = n * math.ceil(pages.count() / (n * SHELF_FILES)) or n
    # dealt out by page, as every row becomes a file and the table may be one row group; rows of one page stay in order on one shelf
    shelf = F.pmod(F.xxhash64(F.coalesce("page_id", F.xxhash64("html"))), F.lit(shelves)).cast("int")
    pages = pages.withColumn("shelf", shelf).repartitionById(n, F.col("shelf") % n)
    pages = pages.select("page_id", "shelf", F.concat_ws("\n", F.col("page_id").cast("string"), "html").alias("value"))
    again = pages.filter("page_id % 3 = 0")
    restated = pages.filter("page_id % 5 = 0").withColumn("value", F.concat("value", F.lit("<!-- restated -->")))
    key = F.nullif(F.regexp_extract("body", r"^(\d+)\n", 1), F.lit(""))
    for k, wave in enumerate((pages, again, restated)):
        arriving = wave.select("value", F.format_string("%d-%d", F.lit(k), "shelf").alias("shelf")).write.mode("append").partitionBy("shelf")
        # version 2: tasks move their files into place, not the driver one by one
        arriving.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(source)
        ledger.take_in(spark, source, target, key, "part-*")
    body = F.regexp_replace("body", r"\n$", "")
    return ledger.versions(spark, target).select(F.col("key").cast("bigint").alias("page_id"), "version", F.md5(body.cast("binary")).alias("digest"))


def _on_silver(build):
    return lambda spark, folder: build(silver(spark, folder))


QUERIES = {
    "bronze_from_pages": bronze_from_pages,
    "bronze_rejects": bronze_rejects,
    "seats_not_named": seats_not_named,
    "schema_tables": schema_tables,
    "typed_rows": typed_rows,
    "publish_changes": publish_changes,
    "published_comparisons": published_comparisons,
    "crosscheck_payload": crosscheck_payload,
    "crosscheck_plain": crosscheck_plain,
    "ordered_marts": ordered_marts,
    "jsonl_roundtrip": jsonl_roundtrip,
    "scan_pages": scan_pages,
    "lineage_columns": lineage_columns,
    "table_roundtrip": table_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "document_read": document_read,
    "envelope_unwrap": envelope_unwrap,
    "export_json_safe": export_json_safe,
    "export_payload": export_payload,
    "export_flat": export_flat,
    "slice_csv": slice_csv,
    "run_meta": run_meta,
    "snapshot_diff": snapshot_diff,
    "html_clean": html_clean,
    "page_header": page_header,
    "page_special_flag": page_special_flag,
    "best_block": best_block,
    "page_rows": page_rows,
    "link_ids": link_ids,
    "parse_money": parse_money,
    "parse_int": parse_int,
    "parse_amount": parse_amount,
    "education_rank": education_rank,
    "tile_columns": tile_columns,
    "flatten_hierarchy": flatten_hierarchy,
    "general_only": general_only,
    "tidy_text": tidy_text,
    "title_case": title_case,
    "conform_state": conform_state,
    "seat_category": seat_category,
    "derive_measures": derive_measures,
    "age_band": age_band,
    "party_group": party_group,
    "winners_view": _on_silver(marts.winners_view),
    "norm_key_join": norm_key_join,
    "unmatched_rows": unmatched_rows,
    "fuzzy_join": fuzzy_join,
    "fuzzy_join_levenshtein": fuzzy_join_levenshtein,
    "name_match": name_match,
    "name_match_levenshtein": name_match_levenshtein,
    "joined_funds": joined_funds,
    "holder_changed": holder_changed,
    "holder_changed_levenshtein": holder_changed_levenshtein,
    "match_report": match_report,
    "reconcile": reconciliation,
    "consistency_audit": lambda spark, folder: reconcile.consistency_audit(
        samples.run_sql(spark, folder, samples.CROSS_CHECK)
    ),
    "state_utilisation": lambda spark, folder: reconcile.state_utilisation(joined_funds(spark, folder)),
    "funds_kpis": lambda spark, folder: reconcile.funds_kpis(
        slices.funds_slice(joined_funds(spark, folder), needle=NEEDLE)
    ),
    "funds_slice": lambda spark, folder: slices.funds_slice(joined_funds(spark, folder), needle=NEEDLE),
    "measures": measures,
    "measures_two_pass": measures_two_pass,
    "quantiles": quantiles,
    "national_trends": _on_silver(marts.national_trends),
    "party_summary": _on_silver(marts.party_summary),
    "state_summary": _on_silver(marts.state_summary),
    "education_dist": _on_silver(marts.education_dist),
    "age_dist": _on_silver(marts.age_dist),
    "state_trends": _on_silver(marts.state_trends),
    "party_by_state": _on_silver(marts.party_by_state),
    "education_by_state": _on_silver(marts.education_by_state),
    "age_by_state": _on_silver(marts.age_by_state),
    "repeat_entities": _on_silver(marts.repeat_entities),
    "repeat_top": _on_silver(lambda rows: marts.repeat_entities(rows, limit=500)),
    "leaderboards": _on_silver(marts.leaderboards),
    "dedupe_candidates": silver,
    "dedupe_first": dedupe_first,
    "dedupe_funded": lambda spark, folder: dedupe.dedupe_funded(samples.funds(spark, folder)),
    "dedupe_report": dedupe_report,
    "ingest_profile": lambda spark, folder: quality.ingest_profile(candidates(spark, folder)),
    "silver_profile": _on_silver(quality.silver_profile),
    "completeness_violations": lambda spark, folder: quality.completeness_violations(
        candidates(spark, folder), 160, 2240
    ),
    "one_winner_per_seat": lambda spark, folder: quality.not_one_winner(
        candidates(spark, folder), ["election_year", "constituency_id"]
    ),
    "rejected_pages": lambda spark, folder: extract.split_pages(
        wide_table(spark, folder, "pages"), rows=extract.best_block(F.col("html"), **SCARCE_BLOCK)
    )[1].select("page_id", "n_rows", "reason"),
    "kpi_delta": lambda spark, folder: slices.kpi_delta(_state_trends(spark, folder), ["state", "cohort"]),
    "refreshed_changes": refreshed_changes,
    "trend_insights": lambda spark, folder: slices.trend_insights(_state_trends(spark, folder), ["state", "cohort"]),
    "cohort_premium": cohort_premium,
    "state_vs_all": state_vs_all,
    "dist_matrix": dist_matrix,
    "trend_slice": trend_slice,
    "winners_slice": lambda spark, folder: slices.winners_slice(
        _winners(spark, folder), LATEST, party_group="Independent", needle=NEEDLE
    ),
    "text_search": lambda spark, folder: slices.search(_winners(spark, folder), NEEDLE, slices.WINNER_SEARCH),
    "slice_counts": slice_counts,
    "sorted_view": lambda spark, folder: slices.sort_view(
        slices.winners_slice(_winners(spark, folder), LATEST), "assets", True, ["constituency", "candidate_id", "name"]
    ),
    "party_chart": _on_silver(lambda rows: slices.party_chart(marts.party_summary(rows), LATEST, n=12)),
    "party_chart_state": _on_silver(
        lambda rows: slices.party_chart(marts.party_by_state(rows), LATEST, STATE, n=12)
    ),
    "state_ranking": _on_silver(lambda rows: slices.state_ranking(marts.state_summary(rows), LATEST, n=36)),
    "leaderboard_slice": _on_silver(
        lambda rows: slices.leaderboard_slice(marts.leaderboards(rows), lookups.MOST_CASES, LATEST)
    ),
    "repeat_slice": _on_silver(lambda rows: slices.repeat_slice(marts.repeat_entities(rows), needle=NEEDLE, n=200)),
    "missing_slices": missing_slices,
    "trend_spine": trend_spine,
    "filter_options": lambda spark, folder: slices.filter_options(_winners(spark, folder)),
    "format_money": format_money,
    "stream_ingest": stream_ingest,
    "stream_merge": stream_merge,
    "restated_pages": restated_pages,
}
