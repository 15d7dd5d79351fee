"""Which keys of a snapshot changed since the last one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _row_hash(columns: list[str], seed: int) -> Column:
    """Hash of a row's content; the null flags keep a moved null from hashing alike."""
    parts = [F.lit(seed)] + [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def content_hash(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: row count and two order-free sums of row hashes, combined before the shuffle."""
    columns = sorted(df.columns)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_row_hash(columns, 1)).alias("h1"),
        F.sum(_row_hash(columns, 2)).alias("h2"),
    )


def snapshot_diff(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """keys, status (unchanged, updated, new, removed), rows before and after."""
    now = content_hash(new, keys).withColumnsRenamed({"n": "n_new", "h1": "a1", "h2": "a2"})
    was = content_hash(old.select(*new.columns), keys).withColumnsRenamed(
        {"n": "n_old", "h1": "b1", "h2": "b2"} | {k: f"_old_{k}" for k in keys}
    )
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
    # a missing side is told by its count; its key columns are null, as a key itself may be
    named = [F.when(F.col("n_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    same = (F.col("n_new") == F.col("n_old")) & (F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2"))
    status = (
        F.when(F.col("n_old").isNull(), "new")
        .when(F.col("n_new").isNull(), "removed")
        .when(same, "unchanged")
        .otherwise("updated")
    )
    return now.join(was, met, "full").select(*named, status.alias("status"), "n_old", "n_new")


def changed_partitions(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose published content has to be rewritten or removed."""
    return snapshot_diff(new, old, keys).filter("status <> 'unchanged'")
