"""What the operators share: reading tables, folds, word splitting, and state that outlives one task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and whole text of every row; a null text is read as empty. Other columns are left out."""
    return texts(read(spark, folder, "documents"))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that text operators work on, under fixed names, so that others cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts, F.lit(0))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8. bytes.split() splits at space and tab to carriage return."""
    return text.encode().lower().split()


def map_texts(docs: DataFrame, fn: Callable[[list, list[str]], dict], schema: str) -> DataFrame:
    """Runs `fn(ids, texts)` on slices of each batch; it returns columns by name.

    A slice holds at most 256 texts, so the working set follows the texts and not the batch.
    """
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = fn(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def worker_store() -> dict:
    """A dictionary of this Python worker, kept from task to task; for tables that are costly to build."""
    return vars(sys.modules.setdefault("rollcall_worker_store", types.ModuleType("rollcall_worker_store")))
