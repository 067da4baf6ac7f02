"""Folders that appear whole.

A result is written beside its place, under a name that Spark's readers pass over,
and renamed when all of it is there. What a failed attempt leaves is never read, and
two writers of one place can't both succeed. The rename is atomic on file systems
with real folders, such as HDFS.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_ATTEMPT = "_attempt-"


class PlaceTaken(RuntimeError):
    """Another writer has put a folder in this place."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; nothing if it is absent."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def numbered(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Values of the partition folders ``column=value`` in a folder, and their names."""
    found = [n for n in names(spark, path) if n.startswith(f"{column}=")]
    return {n.partition("=")[2]: n for n in found}


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that must be free."""
    _system(spark, target).mkdirs(_path(spark, target).getParent())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _system(spark, target).getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        if exists(spark, target):
            raise PlaceTaken(target) from error
        raise


def attempt(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> str:
    """Write rows inside ``folder`` where no reader finds them, and return the path."""
    path = f"{folder}/{_ATTEMPT}{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def land(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write rows as the new folder ``folder/name``; all of them appear or none."""
    spark = df.sparkSession
    written = attempt(df, folder, partition_by)
    try:
        rename(spark, written, f"{folder}/{name}")
    except PlaceTaken:
        remove(spark, written)
        raise


def make(spark: SparkSession, path: str) -> None:
    """An empty folder."""
    _system(spark, path).mkdirs(_path(spark, path))


def swap(spark: SparkSession, written: str, target: str) -> None:
    """Move a written folder to a place, instead of what is there; none written is an empty one.

    The old folder stands until the new one is whole; between the two renames
    there is none, and a job that fails there is run again.
    """
    if not exists(spark, written):
        make(spark, written)
    if exists(spark, target):
        old = f"{target.rpartition('/')[0]}/{_ATTEMPT}{uuid.uuid4().hex}"
        rename(spark, target, old)
        rename(spark, written, target)
        remove(spark, old)
    else:
        rename(spark, written, target)


def replace(df: DataFrame, folder: str, name: str) -> None:
    """Write rows as ``folder/name``, in the place of what is there."""
    swap(df.sparkSession, attempt(df, folder), f"{folder}/{name}")


def clear_attempts(spark: SparkSession, folder: str) -> None:
    """Remove what failed attempts have left; only while nobody writes."""
    for name in names(spark, folder):
        if name.startswith(_ATTEMPT):
            remove(spark, f"{folder}/{name}")
