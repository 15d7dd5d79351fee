"""Training corpus from `documents`: quality rules, quality classifier, line dedup, near-duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import stages
from rollcall.llm.inputs import read
from rollcall.session import scratch_path

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("quality_classifier", stages.quality_classifier),
    ("line_dedup", stages.line_dedup),
    ("simhash_near_dedup", stages.near_dedup),
    ("best_fit_packing", stages.packed),
]

#: The classifier is trained and the fingerprints hash words, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; each is written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
