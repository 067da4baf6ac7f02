"""Where results go: delimited folders, ledgers, tables and user-given stores."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import commits
from feedloom.operators.keyed_lists import NULL_FIELD


class Writer(Protocol):
    def write(self, row: Row) -> None: ...

    def close(self) -> None: ...


def _as_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.ArrayType):
        column = F.array_join(column, "\u0002")
    return F.coalesce(column.cast("string"), F.lit(NULL_FIELD))


def counted(df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, Any]]]:
    """The same rows, and a function that gives their measures once they have been written.

    Measures are aggregates over the rows as they are written: they cost no pass of
    their own. What stands above the last shuffle runs in the tasks whose results
    Spark takes once, so a repeated task does not count twice: put nothing between this and the write
    but projections.
    """
    seen = Observation()
    rows = df.observe(seen, *[column.alias(name) for name, column in measures.items()])
    return rows, lambda: dict(seen.get)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    mode: str = "overwrite",
    order: Sequence[Column] = (),
    measures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Rows as text without header or quotes, NULL as ``\\N``; returns ``measures`` of what was written.

    With ``order`` the parts, read by name, are in that order: one sort, here.
    """
    line = F.concat_ws(sep, *[_as_text(f) for f in df.schema])
    rows, measured = df.orderBy(*order) if order else df, dict
    if measures:
        rows, measured = counted(rows, measures)
    rows.select(line.alias("value")).write.mode(mode).text(path)
    return measured()


def merge_parts(spark: SparkSession, folder: str, target: str, chunk: int = 4 << 20) -> int:
    """The parts of a landed folder, in order, as one file; returns its number of bytes.

    Bytes are copied part by part through a buffer of the driver's file system client:
    nothing holds the rows. It takes as long as copying a file does, so it is for
    results that one reader wants as one file. The file appears when it is whole and
    replaces one of the same name.
    """
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    source = hadoop.fs.Path(folder)
    system = source.getFileSystem(conf)
    parts = [p for p in commits.names(spark, folder) if p.startswith("part-")]
    place = hadoop.fs.Path(target)
    to = place.getFileSystem(conf)
    building = hadoop.fs.Path(place.getParent(), f"_attempt-{uuid.uuid4().hex}")
    out = to.create(building, False)
    try:
        for part in parts:
            read = system.open(hadoop.fs.Path(source, part))
            try:
                hadoop.io.IOUtils.copyBytes(read, out, chunk, False)
            finally:
                read.close()
    finally:
        out.close()
    size = to.getFileStatus(building).getLen()
    if to.exists(place):
        to.delete(place, False)
    if not to.rename(building, place):
        raise OSError(f"could not move the merged parts to {target}")
    return size


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_keyed(df: DataFrame, open_writer: Callable[[], Writer]) -> None:
    """Hand every row to a store client, opened once per partition.

    Writes must be idempotent (set with expiry), as a lost executor's partition
    is written again.
    """

    def put(rows: Iterator[Any]) -> None:
        writer = open_writer()
        try:
            for row in rows:
                writer.write(row)
        finally:
            writer.close()

    df.foreachPartition(put)
