"""Named tables and small typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def from_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Small typed table from literal rows."""
    return spark.createDataFrame(rows, schema)


def with_lineage(df: DataFrame, source: str, at: str) -> DataFrame:
    """Adds when and from where the rows were taken in."""
    return df.withColumns(
        {"_ingested_at": F.lit(at).cast("timestamp"), "_source": F.lit(source)}
    )


def with_processed_at(df: DataFrame) -> DataFrame:
    return df.withColumn("_processed_at", F.current_timestamp())


def save_table(
    df: DataFrame, name: str, partition_by: str | None = None, path: str | None = None
) -> None:
    """Full refresh; columns may differ from the last version."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create the schema if needed and make it current."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def list_marts(spark: SparkSession, pattern: str = "gold_*", schema: str | None = None) -> DataFrame:
    scope = f"IN {schema} " if schema else ""
    return spark.sql(f"SHOW TABLES {scope}LIKE '{pattern}'")
