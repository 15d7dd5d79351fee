"""The operators as queries over whole tables, with the parameters used in production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, centroids, compression, knn, licenses, linededup, lm, multiset, packing, rules, simhash, toxicity
from .inputs import read


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_license_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


def op3_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest_documents(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op4_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return compression.score(docs, compression.fit(docs, read(spark, folder, "labels")))


def op5_voronoi_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return knn.top_k(knn.whole_vectors(read(spark, folder, "embeddings")), F.col("vec_id") % 100 == 0)


def op6_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(read(spark, folder, "documents")).select("doc_id", *rules.BASE, "base_failed", "kept")


def op7_string_kernel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, folder, "labels")))


def op8_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.line_dedup(read(spark, folder, "documents"), windows=False)  # as its SQL has it
    kept = F.coalesce("kept_text", F.lit(""))
    return found.select(
        "doc_id", "n_chunks", "n_removed", F.length(kept).alias("n_chars_kept"), F.md5(kept.cast("binary")).alias("kept_md5")
    )


def op10_elias_fano_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(read(spark, folder, "documents"))


def op11_multiset_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return multiset.edited_documents(read(spark, folder, "documents"))


def op12_vantage_point_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, folder, "embeddings"))


def op13_spill_counted_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(read(spark, folder, "documents"), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_license_paragraphs, op3_prefix_bpe, op4_compression_quality, op5_voronoi_top_k,
        op6_divergence_rules, op7_string_kernel_toxicity, op8_simhash_pigeonring, op9_line_chunks,
        op10_elias_fano_lm, op11_multiset_fingerprints, op12_vantage_point_clusters, op13_spill_counted_alignment,
    )
}

#: SQL for the queries that it can express.
ORACLES: dict[str, str] = {
    "op5_voronoi_top_k": """
        WITH ints AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM ints q JOIN ints c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op6_divergence_rules": rules.SQL,
    "op9_line_chunks": linededup.SQL,
    "op11_multiset_fingerprints": multiset.SQL,
    "op12_vantage_point_clusters": centroids.SQL,
}
