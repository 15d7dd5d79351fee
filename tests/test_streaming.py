"""Incremental ingest and merge over files that arrive in waves."""

import json

from pyspark.sql import functions as F, types as T

from rollcall.operators import dedupe
from rollcall.streaming import ingest, merge

SCHEMA = T.StructType(
    [T.StructField("k", T.IntegerType()), T.StructField("v", T.LongType()), T.StructField("who", T.StringType())]
)


def drop(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(dict(zip(SCHEMA.names, r))) + "\n" for r in rows))


def best(rows):
    return dedupe.keep_best(rows, ["k"], [F.col("v").desc_nulls_last(), F.col("who").asc()])


def test_only_new_files_are_taken_in(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    drop(source, "a.jsonl", [(1, 5, "a"), (2, 6, "b")])
    run = lambda: ingest.ingest_new(spark, str(source), SCHEMA, target, checkpoint, max_files=1)
    run()
    run()
    assert spark.read.parquet(target).count() == 2
    drop(source, "b.jsonl", [(1, 7, "c")])
    drop(source, "c.jsonl", [(3, 8, "d")])
    run()
    assert sorted(r.who for r in spark.read.parquet(target).collect()) == ["a", "b", "c", "d"]


def test_merge_keeps_the_best_and_survives_a_replay(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    waves = [[(1, 5, "a"), (1, 4, "b"), (2, None, "c")], [(1, 9, "d"), (2, 1, "e")], [(3, 1, "f"), (1, 9, "z")]]
    for i, wave in enumerate(waves):
        drop(source, f"{i}.jsonl", wave)
        merge.stream_best(spark, str(source), SCHEMA, target, checkpoint, best, ["k"])
    want = {(1, 9, "d"), (2, 1, "e"), (3, 1, "f")}
    read = lambda where: {tuple(r) for r in merge.read_best(spark, where, SCHEMA).collect()}
    assert read(target) == want
    plan = merge.read_best(spark, target, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    merge.merge_best(spark.createDataFrame(waves[2], SCHEMA), 2, target, best, ["k"])  # the last batch once more
    assert read(target) == want
    merge.merge_best(spark.createDataFrame([(2, 7, "late")], SCHEMA), 3, target, best, ["k"])
    assert read(target) == {(1, 9, "d"), (2, 7, "late"), (3, 1, "f")}
    merge.merge_best(spark.createDataFrame([], SCHEMA), 4, target, best, ["k"])
    assert read(target) == {(1, 9, "d"), (2, 7, "late"), (3, 1, "f")}
