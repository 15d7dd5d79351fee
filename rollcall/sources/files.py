"""JSON lines, pages and JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import lookups

BAD_LINE = "_corrupt_record"


def read_jsonl(spark: SparkSession, glob: str, schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """JSON lines of every file the glob names, in a fixed schema; blank lines are skipped.

    `keep_bad` adds the text of lines that are not JSON as `_corrupt_record`; otherwise such a
    line stops the read.
    """
    reader = spark.read
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE).option("mode", "PERMISSIVE")
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).json(glob)


def write_jsonl(df: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> None:
    """JSON lines, nulls kept, in one folder per value of `by` if given."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if by:
        writer = writer.partitionBy(by)
    writer.json(path)


def read_pages(spark: SparkSession, folder: str, name_pattern: str = lookups.PAGE_NAME) -> DataFrame:
    """One row per page file: year and seat id out of the file name, path, whole text."""
    path = F.col("_metadata.file_path")
    return spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(path, name_pattern, 1).try_cast("int").alias("election_year"),
        F.regexp_extract(path, name_pattern, 2).try_cast("bigint").alias("constituency_id"),
        path.alias("source_url"),
        F.col("value").alias("html"),
    )


def read_document(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON documents that span lines, one row per document."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


ENVELOPE_KEYS = ["success", "data", "cached", "cache_timestamp"]


def unwrap(document: Column) -> Column:
    """JSON text inside a `{success, data, ...}` envelope, or the text itself; `{}` if empty."""
    keys = F.json_object_keys(document)
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in ENVELOPE_KEYS]))
    wrapped = F.array_contains(keys, "data") & (F.size(extra) == 0)
    inner = F.when(F.coalesce(wrapped, F.lit(False)), F.get_json_object(document, "$.data")).otherwise(document)
    empty = inner.isin("", "null", "[]", "0", "false")
    return F.when(inner.isNull() | empty, "{}").otherwise(inner)
