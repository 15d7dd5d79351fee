"""Folders of many files, a bounded number of files at a time.

Whoever reads files through Spark makes the driver hold the name, the place and the task of each. So folders are put together into
groups that are read one after the other. Counts are the file system's own and name no file. A folder is listed as a whole: one that
alone holds more files than a group should makes a group of its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Entries of a folder that are looked at one by one before it is counted.
FEW_ENTRIES = 5_000
#: How many bytes of listings Spark keeps.
LISTINGS_KEPT = "spark.sql.hive.filesourcePartitionFileCacheSize"
#: Files and bytes that one task reads.
TASK_FILES, TASK_BYTES = 256, 32 << 20


@dataclass
class Group:
    """`paths`, of folders or files, are for Spark's readers, with all that is below them; `files` is how many there were when counted."""

    paths: list[str]
    files: int


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))) or name.endswith("._COPYING_")


def _plain(path) -> str:
    """A path that is not taken for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path.toString())


def _unless_gone(look, at):
    """What `look` says of a folder; None if it, or something in it, went away meanwhile."""
    try:
        return look(at)
    except Exception as error:
        if "FileNotFound" in str(error):
            return None
        raise


def _pieces(fs, at, entries, at_a_time: int) -> list[Group]:
    """Groups that share no file and are a folder with all below it, or single files beside large folders."""
    if len(entries) > FEW_ENTRIES:
        held = _unless_gone(fs.getContentSummary, at)
        if held is not None and held.getDirectoryCount() == 1:
            return [Group([_plain(at)], len(entries))]
    files, folders = [], []
    for entry in entries:
        path = entry.getPath()
        if not _hidden(path.getName()):
            (folders if entry.isDirectory() else files).append(path)
    if not folders:
        return [Group([_plain(at)], len(files))]
    found = [Group([_plain(f)], 1) for f in files]
    for folder in folders:
        held = _unless_gone(fs.getContentSummary, folder)
        if held is not None and held.getFileCount() <= at_a_time:
            found.append(Group([_plain(folder)], held.getFileCount()))
        elif (inside := _unless_gone(fs.listStatus, folder)) is not None:
            found += _pieces(fs, folder, inside, at_a_time)
    total = sum(p.files for p in found)
    return found if total > at_a_time else [Group([_plain(at)], total)]


def groups(spark: SparkSession, folder: str, at_a_time: int) -> list[Group]:
    """All files of a folder and those below it, in groups of about `at_a_time` files."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pieces = [p for s in fs.globStatus(pattern) or [] for p in _pieces(fs, s.getPath(), fs.listStatus(s.getPath()), at_a_time)]
    packed: list[Group] = []
    for piece in pieces:
        if packed and packed[-1].files + piece.files <= at_a_time:
            packed[-1].paths += piece.paths
            packed[-1].files += piece.files
        else:
            packed.append(piece)
    return packed or [Group([folder], 0)]  # Spark's reader says what is wrong with it


@contextmanager
def not_kept(spark: SparkSession) -> Iterator[None]:
    """What readers list inside is not kept beyond them; Spark keeps up to 250 MB of listings that no later reader can use."""
    before = spark.conf.get(LISTINGS_KEPT)
    spark.conf.set(LISTINGS_KEPT, "0")
    try:
        yield
    finally:
        spark.conf.set(LISTINGS_KEPT, before)


def tasks(files: int, length: int = 0, of_each: int = TASK_FILES) -> int:
    """How many tasks should read files of that many bytes in all; Spark by itself makes one for every few small files."""
    return max(1, math.ceil(files / of_each), math.ceil(length / TASK_BYTES))
