"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame; all but the last give back the columns of documents.

A text's verdict is made beside its row, so rows with null or repeated ids and extra columns go through each stage as
they are. Null texts are judged as empty. An empty table gives an empty table.
"""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage
from . import compression, linededup, packing, rules, simhash
from .inputs import read, texts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return rules.kept(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Documents whose score is at least `threshold`; the classifier learns from the labelled ones among them."""
    model = compression.fit(docs, read(spark, sf_dir, "labels"))

    @F.pandas_udf("boolean")
    def good(bodies: pd.Series) -> pd.Series:
        return pd.Series([model.score(t or "") >= threshold for t in bodies], dtype=bool)

    return docs.filter(good(F.col("text")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated chunks and passages; n_chars follows the text."""
    found = linededup.without_repeats(docs)
    changed = F.col("n_removed") > 0

    def column(name: str) -> Column:
        own = F.col(f"row.`{name}`")
        if name == "text":
            return F.when(changed, F.col("kept_text")).otherwise(own).alias(name)
        if name == "n_chars":
            return F.when(changed, F.length("kept_text").cast("long")).otherwise(own).alias(name)
        return own

    return found.select(*map(column, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (of several with that id, or without any, one)."""
    found = simhash.near_duplicates(docs)
    groups = found.groupBy("root").agg(F.min("component_id").alias("kept_id"))
    kept = groups.filter("kept_id IS NOT NULL").select("kept_id").distinct()
    # ids that are null or not one row's alone; written down, so that their number decides how they are joined
    odd = stage(docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("odd_id")), "odd-ids")
    once = docs.join(odd, docs.doc_id.eqNullSafe(odd.odd_id), "left_anti")
    once = once.join(kept, once.doc_id == kept.kept_id, "left_semi")
    # their rows are told apart by fingerprint; one of each group that has no other stays
    several = stage(docs.join(odd, docs.doc_id.eqNullSafe(odd.odd_id), "left_semi"), "rows-of-odd-ids")
    fps = simhash.fingerprints(texts(several)).distinct()
    place = fps.join(found.select("fp", "root").distinct(), "fp").join(groups, "root").filter(F.col("kept_id").eqNullSafe(F.col("doc_id")))
    chosen = place.groupBy("root").agg(F.min("doc_id").alias("id"), F.min("fp").alias("fp"))
    fp = simhash.fingerprint_udf()(F.coalesce("text", F.lit("")))
    named = several.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), fp.alias("own_fp"))
    met = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_fp") == F.col("fp"))
    fit = named.join(chosen, met, "left_semi").dropDuplicates(["own_id", "own_fp"])
    return once.unionByName(fit.select("row.*"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
