"""Tables laid out in buckets of a key, so that joins and sums on it need no shuffle.

A layout is a folder ``by=<key>/buckets=<n>`` of Parquet files, optionally parted by
other columns. It is written once and read by any session: the folder's name says how
it is dealt, and the reader tells Spark. Tables read together must agree in key type
and number of buckets; Spark would otherwise shuffle one of them without a word.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedloom import commits


_MANAGED = "spark.sql.hive.manageFilesourcePartitions"


@dataclass(frozen=True)
class Layout:
    key: str
    buckets: int
    folder: str


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> Layout:
    """Lay a table out; it appears as a whole. Each bucket is sorted by the key.

    Rows are dealt to their buckets before the write, so a bucket is one file, or one
    for each combination of ``partition_by``.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    if layouts(spark, root):
        raise ValueError(f"{root} holds a layout already")
    name, attempt = _name(), f"{root}/_attempt-{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", attempt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.format("parquet").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    found = Layout(key, buckets, f"{root}/by={key}/buckets={buckets}")
    commits.rename(spark, attempt, found.folder)
    return found


def _name() -> str:
    return f"feedloom_{uuid.uuid4().hex}"


def layouts(spark: SparkSession, path: str) -> list[Layout]:
    root = path.rstrip("/")
    found = []
    for key, name in commits.numbered(spark, root, "by").items():
        for n, inner in commits.numbered(spark, f"{root}/{name}", "buckets").items():
            found.append(Layout(key, int(n), f"{root}/{name}/{inner}"))
    return found


def layout_of(spark: SparkSession, path: str) -> Layout:
    found = layouts(spark, path)
    if len(found) != 1:
        raise ValueError(f"{path} holds {len(found)} layouts instead of one")
    return found[0]


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table, known to Spark as dealt by its key."""
    layout = layout_of(spark, path)
    schema = spark.read.parquet(layout.folder).schema
    parted = [n.partition("=")[0] for n in commits.names(spark, layout.folder) if "=" in n]
    parts = f"PARTITIONED BY (`{parted[0]}`)" if parted else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    name, managed = _name(), spark.conf.get(_MANAGED)
    # Days are found in the folder, not in a catalog: the name only serves to describe the layout.
    spark.conf.set(_MANAGED, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parts} CLUSTERED BY (`{layout.key}`) "
            f"SORTED BY (`{layout.key}`) INTO {layout.buckets} BUCKETS LOCATION '{layout.folder}'"
        )
        return spark.table(name)
    finally:
        spark.conf.set(_MANAGED, managed)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_together(spark: SparkSession, *paths: str) -> list[DataFrame]:
    """Tables that are dealt alike; refuses those whose joins would be shuffled."""
    found = [layout_of(spark, p) for p in paths]
    frames = [read_bucketed(spark, p) for p in paths]
    alike = {(x.buckets, f.schema[x.key].dataType.simpleString()) for x, f in zip(found, frames, strict=True)}
    if len(alike) > 1:
        raise ValueError(f"tables are dealt differently: {[(x.key, x.buckets) for x in found]}")
    return frames
