"""The pipeline's stages, each on its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from rollcall.llm import compression, linededup, rules, simhash, stages


def test_stages_and_run(spark, tables, docs):
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.quality_rules, stages.quality_classifier, stages.line_dedup, stages.near_dedup, stages.packed,
    ]
    packed = corpus_pipeline.run(spark, tables)
    assert 0 < packed.select("doc_id").distinct().count() < docs.count()


def test_each_stage_against_its_operator(spark, tables, docs, labels, tmp_path):
    kept = stages.quality_rules(spark, docs, tables)
    verdict = {r.doc_id for r in rules.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    kept.write.parquet(str(tmp_path / "1"))
    docs = spark.read.parquet(str(tmp_path / "1"))
    kept = stages.quality_classifier(spark, docs, tables)
    verdict = {r.doc_id for r in compression.score(docs, compression.fit(docs, labels)).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    kept.write.parquet(str(tmp_path / "2"))
    docs = spark.read.parquet(str(tmp_path / "2"))
    lines = stages.line_dedup(spark, docs, tables)
    want = {r.doc_id: r.kept_text for r in linededup.line_dedup(docs).collect()}
    rows = lines.collect()
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows if r.text != want)
    lines.write.parquet(str(tmp_path / "3"))
    docs = spark.read.parquet(str(tmp_path / "3"))
    left = [r.doc_id for r in stages.near_dedup(spark, docs, tables).collect()]
    assert sorted(left) == sorted(r.component_id for r in simhash.near_duplicates(docs).select("component_id").distinct().collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_odd_and_empty_tables(spark, tables, odd_docs, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for table in (odd_docs, no_docs):
        out = stage(spark, table, tables)
        assert out.schema.simpleString() == table.schema.simpleString() and out.count() <= table.count()


def test_one_of_each_group_stays(spark, tables):
    body = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, body), (None, body), (5, body), (5, body), (9, body), (None, "other words here"), (None, "other words here"), (3, "x y z"), (3, "p q r"), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted((r.doc_id or 0, r.text) for r in stages.near_dedup(spark, docs, tables).collect())
    assert left == [(0, "other words here"), (3, "p q r"), (3, "x y z"), (4, ""), (5, body)]


def test_packed_last(spark, tables, docs):
    out = stages.packed(spark, docs, tables)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
