"""A store of keyed values on a shared file system, written in transactions.

A batch is a set of key-sorted Parquet segments, each written by one task under a name
of its own, and a list of those that count, which appears when every task is done. A
task that fails or runs twice leaves a segment that no list names; a batch that fails
leaves no list, and what its finished tasks wrote is removed. Values have a time to
live from the batch's clock. The last batch that has a key decides, also when its value
has expired since; hash entries are keys with a field.

Paths are those that every executor sees: a mounted folder, or an address that
``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "feedloom_store"
SCHEMA = "key string, field string, value string, expires_at long"
_BATCHES, _SEGMENTS = "batches", "segments"
_ROW_GROUP = 64 << 10


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _batches(system: fs.FileSystem, root: str) -> list[str]:
    """Lists of the committed batches, first to last."""
    found = system.get_file_info(fs.FileSelector(f"{root}/{_BATCHES}", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


@dataclass
class Segment(WriterCommitMessage):
    """What a task has written; empty tasks write nothing."""

    name: str | None
    rows: int


class SegmentWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segment:
        system, root = _open(self.path)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    system.create_dir(f"{root}/{_SEGMENTS}", recursive=True)
                    out = pq.ParquetWriter(f"{root}/{_SEGMENTS}/{name}", batch.schema, filesystem=system)
                out.write_batch(batch, row_group_size=_ROW_GROUP)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Segment(name if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _open(self.path)
        system.create_dir(f"{root}/{_BATCHES}", recursive=True)
        last = [int(p.rsplit("/", 1)[1].split("-")[0]) for p in _batches(system, root)][-1:]
        name = f"{last[0] + 1 if last else 0:012d}-{uuid.uuid4().hex}"
        segments = sorted(m.name for m in messages if m is not None and m.name)
        said = {"segments": segments, "rows": sum(m.rows for m in messages if m is not None)}
        with system.open_output_stream(f"{root}/{_BATCHES}/{name}.building") as file:
            file.write(json.dumps(said).encode())
        system.move(f"{root}/{_BATCHES}/{name}.building", f"{root}/{_BATCHES}/{name}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _open(self.path)
        for message in messages:
            if message is not None and message.name:
                system.delete_file(f"{root}/{_SEGMENTS}/{message.name}")


class StoreSource(DataSource):
    """``df.write.format("feedloom_store").mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> SegmentWriter:
        if overwrite:
            raise ValueError("a batch is added; a later one replaces the values of its keys")
        names = [f.name for f in schema.fields]
        if names != ["key", "field", "value", "expires_at"]:
            raise ValueError(f"the columns of a batch are {SCHEMA}, not {names}")
        return SegmentWriter(self.options["path"])


def publish(rows: DataFrame, path: str, as_of: int) -> None:
    """Commit (key, [field,] value, ttl_sec) rows, unique by key and field, as one batch.

    ``as_of`` is the clock of the batch in seconds. Rows are dealt by ranges of key and
    field, so a key with very many fields is written by many tasks.
    """
    spark = rows.sparkSession
    spark.dataSource.register(StoreSource)
    field = F.col("field") if "field" in rows.columns else F.lit(None)
    batch = rows.select(
        "key", field.cast("string").alias("field"), "value", (F.lit(as_of) + F.col("ttl_sec")).cast("long").alias("expires_at")
    )
    dealt = batch.repartitionByRange("key", "field").sortWithinPartitions("key", "field")
    dealt.write.format(FORMAT).mode("append").save(path)


def read(spark: SparkSession, path: str, as_of: int, wanted: Column | None = None) -> DataFrame:
    """(key, field, value, expires_at) that are alive at ``as_of``.

    ``wanted`` is a condition on key and field that the scan of the segments takes
    over: they are sorted, so few of their row groups are read.
    """
    system, root = _open(path)
    named: list[tuple[int, list[str]]] = []
    for number, place in enumerate(_batches(system, root)):
        with system.open_input_stream(place) as file:
            named.append((number, json.loads(file.read())["segments"]))
    rows = spark.createDataFrame([], f"{SCHEMA}, batch int")
    for number, segments in named:
        if segments:
            found = spark.read.schema(SCHEMA).parquet(*[f"{path}/{_SEGMENTS}/{s}" for s in segments])
            found = found if wanted is None else found.where(wanted)
            rows = rows.unionByName(found.withColumn("batch", F.lit(number)))
    last = rows.groupBy("key", "field").agg(F.max_by(F.struct("value", "expires_at"), "batch").alias("last"))
    return last.select("key", "field", "last.value", "last.expires_at").where(F.col("expires_at") > as_of)


def compact(spark: SparkSession, path: str, as_of: int) -> None:
    """Write what is alive as one batch that stands for all before it; only while nobody writes."""
    system, root = _open(path)
    old = _batches(system, root)
    alive = read(spark, path, as_of)
    spark.dataSource.register(StoreSource)
    dealt = alive.repartitionByRange("key", "field").sortWithinPartitions("key", "field")
    dealt.write.format(FORMAT).mode("append").save(path)
    for place in old:
        system.delete_file(place)


def vacuum(path: str) -> int:
    """Remove segments that no batch names, and return their number; only while nobody reads or writes."""
    system, root = _open(path)
    named: set[str] = set()
    for place in _batches(system, root):
        with system.open_input_stream(place) as file:
            named |= set(json.loads(file.read())["segments"])
    found = system.get_file_info(fs.FileSelector(f"{root}/{_SEGMENTS}", allow_not_found=True))
    dead = [f.path for f in found if f.base_name not in named]
    for place in dead:
        system.delete_file(place)
    return len(dead)
