"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own_scratch: dict[str, str] = {}
#: The innermost open scope of this thread or task.
_scope: ContextVar[list[str] | None] = ContextVar("rollcall_scope", default=None)


def build_session(app: str = "rollcall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` keys use `_` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`, which every executor can reach.

    Only a local master may go without one; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="rollcall-")
    return _own_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/rollcall/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes the scratch folders that were begun inside, once the plan that reads them has run."""
    paths: list[str] = []
    before = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(before)
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` once to the scratch area and return the written table.

    Later reads do not recompute it and survive lost executors. Its size is then known from
    its files, so joins with it are broadcast only when it is under
    `spark.sql.autoBroadcastJoinThreshold` and shuffled otherwise; no hint is needed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
