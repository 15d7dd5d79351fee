"""Files, tables, exports."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F, types as T

from rollcall.operators import marts
from rollcall.plans import medallion
from rollcall.catalogue import samples
from rollcall.session import scratch_root, scratch_scope, stage
from rollcall.sources import commits, exports, files, schemas, tables as named


def test_jsonl_skips_blank_lines_and_keeps_bad_ones(spark, tmp_path):
    good = json.dumps({"election_year": 2004, "name": "A", "assets": 5, "is_winner": True})
    (tmp_path / "candidates_2004.jsonl").write_text(f"{good}\n\n   \nnot json\n")
    (tmp_path / "candidates_2009.jsonl").write_text(good + "\n")
    (tmp_path / "other.jsonl").write_text(good + "\n")
    glob = f"{tmp_path}/candidates_[0-9]*.jsonl"
    rows = files.read_jsonl(spark, glob, schemas.CANDIDATE, keep_bad=True).cache()
    assert rows.filter(F.col(files.BAD_LINE).isNull()).count() == 2
    assert [r[0] for r in rows.filter(F.col(files.BAD_LINE).isNotNull()).select(files.BAD_LINE).collect()] == ["not json"]
    assert rows.columns[:-1] == schemas.CANDIDATE.names
    with pytest.raises(Exception):
        files.read_jsonl(spark, glob, schemas.CANDIDATE).collect()


def test_pages(spark, tmp_path):
    (tmp_path / "c_2024_17.html").write_text("<p>a\nb</p>")
    (tmp_path / "c_2004_3.html").write_text("x")
    (tmp_path / "home_2024.html").write_text("index")
    found = {(r.election_year, r.constituency_id): r.html for r in files.read_pages(spark, str(tmp_path)).collect()}
    assert found == {(2024, 17): "<p>a\nb</p>", (2004, 3): "x", (None, None): "index"}


ENVELOPES = [
    ('{"success":true,"data":{"a":1}}', '{"a":1}'),
    ('{"success":true,"data":null}', "{}"),
    ('{"data":{"a":1},"more":2}', '{"data":{"a":1},"more":2}'),
    ('{"a":1}', '{"a":1}'),
    ('{"success":false,"data":{},"cached":true,"cache_timestamp":1}', "{}"),
    (None, "{}"),
]


def test_unwrap(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ENVELOPES)], "i int, t string")
    got = [r[1] for r in rows.select("i", files.unwrap(F.col("t"))).orderBy("i").collect()]
    assert got == [w for _, w in ENVELOPES]


def test_document_spanning_lines(spark, tmp_path):
    (tmp_path / "totals.json").write_text('{\n "tenure": "18",\n "allocated": 5\n}')
    schema = T.StructType([T.StructField("tenure", T.StringType()), T.StructField("allocated", T.LongType())])
    assert tuple(files.read_document(spark, f"{tmp_path}/totals.json", schema).first()) == ("18", 5)


def test_json_safe(spark):
    rows = spark.createDataFrame(
        [(math.nan, 1), (math.inf, 2), (-math.inf, 3), (1.005, 4), (2.344, 5), (None, 6)], "v double, i int"
    ).withColumn("t", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    got = [tuple(r) for r in exports.json_safe(rows).orderBy("i").select("v", "t").collect()]
    assert [v for v, _ in got] == [None, None, None, 1.01, 2.34, None]
    assert got[0][1] == "2024-01-02T03:04:05"


def test_csv_keeps_quotes_and_nulls(spark, tmp_path):
    schema = "a string, b string, n long"
    rows = spark.createDataFrame([('say "hi", x', "two\nlines", 1), ("", None, None), ("ü", " d ", 3)], schema)
    for bom in (False, True):
        path = f"{tmp_path}/csv{bom}"
        exports.write_csv(rows, path, bom)
        back = exports.read_csv(spark, path, rows.schema)
        assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    part = next((tmp_path / "csvTrue").glob("*.csv"))
    assert part.read_text(encoding="utf-8").startswith("﻿a,b,n")
    assert '"say ""hi"", x"' in "".join(p.read_text() for p in (tmp_path / "csvFalse").glob("*.csv"))


@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path, split):
    """Line breaks, quotes and empty lines inside fields, wherever the splits fall."""
    rng = random.Random(split)
    texts = ["plain", 'say "hi"', "two\nlines", '"\n"\n\n"', "", None, " pad ", "a,b", "\n", "é\nü,\"x\""]
    rows = [(i, rng.choice(texts), rng.choice(texts), rng.choice([None, i * 7])) for i in range(120)]
    df = spark.createDataFrame(rows, "i int, a string, b string, n long")
    path = str(tmp_path / "csv")
    exports.write_csv(df.coalesce(1), path, bom=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        back = exports.read_csv(spark, path, df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
        if split == 37:
            assert spark.read.text(path).rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_only_changed_sections_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", 0.123), (1, "a", None)], "k int, s string, v double")
    path, order = str(tmp_path), [F.col("k")]
    run = lambda **sections: dict(map(tuple, exports.publish_changed({n: (d, order) for n, d in sections.items()}, path).collect()))
    assert run(rows=rows, none=rows.limit(0)) == {"rows": "new", "none": "new"}
    at = lambda name: exports.section_path(spark, path, name)
    assert [r.body for r in exports.read_section(spark, at("rows")).orderBy("position").collect()] == [
        '{"k":1,"s":"a","v":null}', '{"k":2,"s":"b","v":0.12}',
    ]
    before = at("rows")
    assert run(rows=rows.orderBy("k"), none=rows.limit(1)) == {"rows": "unchanged", "none": "updated"}
    assert at("rows") == before
    number = commits.newest(spark, path).number
    assert run(rows=rows, none=rows.limit(1)) == {"rows": "unchanged", "none": "unchanged"}
    assert commits.newest(spark, path).number == number
    assert run(rows=rows) == {"rows": "unchanged", "none": "removed"}
    # what is removed or replaced is off the disk
    assert [p.name for p in (tmp_path / "data").iterdir()] == [before.rsplit("/", 1)[1]]
    with pytest.raises(KeyError):
        at("none")


def test_a_stopped_run_leaves_the_old_payload(spark, tmp_path):
    path, order = str(tmp_path), [F.col("k")]
    rows = spark.range(5).select(F.col("id").alias("k"))
    publish = lambda **sections: exports.publish_changed({n: (d, order) for n, d in sections.items()}, path)
    publish(a=rows, b=rows)
    bad = rows.select(F.when(F.col("k") < 9, F.raise_error(F.lit("lost"))).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        publish(a=rows.limit(2), b=bad)
    read = lambda name: exports.read_section(spark, exports.section_path(spark, path, name)).count()
    assert (read("a"), read("b")) == (5, 5)
    assert {r.section: r.status for r in publish(a=rows.limit(2), b=rows).collect()} == {"a": "updated", "b": "unchanged"}
    assert (read("a"), read("b"), len(list((tmp_path / "data").iterdir()))) == (2, 5, 2)


def test_sections_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            seen.add(1)
            yield r

    rows = spark.createDataFrame(spark.range(7).rdd.mapPartitions(counted), "id long")
    exports.publish_changed({"rows": (rows, [])}, str(tmp_path))
    assert seen.value == 7


def test_payload_files_are_ordered(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    exports.write_payload({"rows": (rows, [F.col("k").desc()])}, str(tmp_path))
    lines = [line for p in sorted((tmp_path / "rows").glob("part-*")) for line in p.read_text().splitlines()]
    assert [json.loads(line)["k"] for line in lines] == list(range(999, -1, -1))
    read = exports.read_section(spark, f"{tmp_path}/rows").collect()
    assert {r.position: json.loads(r.body)["k"] for r in read} == {i: 999 - i for i in range(1000)}


def test_stage_uses_the_named_folder(spark):
    rows = stage(spark.range(3), "check")
    assert rows.count() == 3
    assert scratch_root(spark) in rows.inputFiles()[0]


def test_scratch_is_deleted_once_a_plan_has_run(spark):
    from pathlib import Path

    with scratch_scope(spark) as paths:
        assert stage(spark.range(3), "check").count() == 3
    assert len(paths) == 1 and not Path(paths[0].removeprefix("file:")).exists()


def test_whole_run(spark, tables, tmp_path):
    named.ensure_schema(spark, "rollcall_test")
    raw = samples.candidates(spark, tables)
    with pytest.raises(ValueError, match="truncated"):
        medallion.ingest(raw, "orders", "2024-08-01 00:00:00")
    medallion.ingest(raw, "orders", "2024-08-01 00:00:00", full_run=False)
    medallion.refresh(spark, "rollcall_test")
    assert named.list_marts(spark, schema="rollcall_test").count() == len(medallion.MARTS)
    silver = named.read_table(spark, "silver_candidates")
    assert silver.count() == samples.silver(spark, tables).count()
    assert "_processed_at" in silver.columns
    first = medallion.publish(spark, str(tmp_path), "2024-08-01T00:00:00Z", "orders")
    assert {r.status for r in first.collect()} == {"new"}
    again = medallion.publish(spark, str(tmp_path), "2024-08-02T00:00:00Z", "orders")
    assert {r.status for r in again.collect()} == {"unchanged"} and again.count() == 13
    at = lambda name: exports.section_path(spark, str(tmp_path), name)
    meta = spark.read.json(at("meta")).first()
    assert meta.generated_at == "2024-08-01T00:00:00Z" and meta.total_candidates == silver.count() and meta.election_years == sorted(meta.election_years)
    repeats = spark.read.text(at("repeat_candidates/candidates"))
    assert repeats.count() == min(500, marts.repeat_entities(silver).count())
    flat = spark.read.option("header", True).option("escape", '"').csv(at("candidates"))
    assert flat.columns == exports.FLAT_COLUMNS and flat.count() == meta.total_candidates + meta.bye_election_rows_excluded


def test_typed_rows(spark):
    row = {"tenure": "18", "state": "Goa", "allocated": 5}
    rows = named.from_rows(spark, [row], schemas.FUND)
    assert rows.schema == schemas.FUND
    assert (rows.first().allocated, rows.first().expenditure) == (5, None)
