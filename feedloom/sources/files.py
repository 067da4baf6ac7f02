"""Partitioned tables, delimited text and JSON lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions import flag, stripped
from feedloom.staging import stage

FLAGS = ("joined", "checked", "clicked", "shared", "thumbed_up")


def partitioned_table(
    spark: SparkSession, path: str, first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """Parquet partitioned by ``pdate``; absent days simply add no rows."""
    table = spark.read.parquet(path)
    if first_day is not None:
        table = table.where(F.col("pdate") >= F.lit(first_day))
    if last_day is not None:
        table = table.where(F.col("pdate") <= F.lit(last_day))
    return table


def with_int_flags(interactions: DataFrame) -> DataFrame:
    """0/1 integer flags, whether the table stores integers or booleans."""
    fields = {f.name: f.dataType for f in interactions.schema}
    return interactions.withColumns(
        {name: flag(F.col(name), fields[name]) for name in FLAGS if name in fields}
    )


def delimited_text(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Plain delimited rows without quoting; ``\\N`` reads as NULL."""
    return spark.read.csv(
        path, schema=schema, sep=sep, quote="", nullValue="\\N", ignoreTrailingWhiteSpace=False
    )


def ragged_fields(line: Column, sep: str = "\t") -> Column:
    """The fields of a line whose number is part of its meaning.

    The line is stripped first, so an empty last field of a tab text does not count.
    """
    return F.split(stripped(line), sep)


def numbered_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """(value, file, file_line, line_no) of text lines, beside the columns of partition folders.

    ``file_line`` counts the lines of a file from 1, ``line_no`` those of all files in
    the order of their paths. Both are dense, whatever blocks the files are read in:
    lines are counted per block, and the sums of the blocks before give each block's
    first number. Lines are written while the plan is built, with their place.
    """
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    read = reader.text(path)
    folders = [c for c in read.columns if c != "value"]
    lines = stage(
        read.select(
            "value",
            *folders,
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            # Rises by one from line to line of a block.
            F.monotonically_increasing_id().alias("_at"),
        ),
        "lines",
    )
    of_file = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # A row per block of the input.
    blocks = lines.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    blocks = blocks.withColumn("_in_file", F.coalesce(F.sum("_n").over(of_file), F.lit(0)))
    sizes = blocks.groupBy("file").agg(F.sum("_n").alias("_lines"))
    sizes = sizes.select("file", F.coalesce(F.sum("_lines").over(files), F.lit(0)).alias("_before"))
    firsts = stage(blocks.join(sizes, "file").drop("_n"), "line-blocks")
    file_line = F.col("_in_file") + F.col("_at") - F.col("_first") + 1
    return lines.join(firsts, ["file", "_block"]).select(
        *folders, "value", "file", file_line.alias("file_line"), (F.col("_before") + file_line).alias("line_no")
    )


def zip_lines(left: DataFrame, right: DataFrame, sep: str = "\t") -> DataFrame:
    """(line_no, value, paired): lines of equal number side by side, like columns that are pasted.

    Where one text is shorter, its part of the line is empty and ``paired`` is false.
    """
    a = left.select("line_no", F.col("value").alias("_left"))
    b = right.select("line_no", F.col("value").alias("_right"))
    empty = F.lit("")
    line = F.concat(F.coalesce("_left", empty), F.lit(sep), F.coalesce("_right", empty))
    paired = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    return a.join(b, "line_no", "full").select("line_no", line.alias("value"), paired.alias("paired"))


def zip_counts(zipped: DataFrame) -> DataFrame:
    """One row: lines of a zip, and lines that only one text has."""
    return zipped.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("paired")).alias("unpaired"))


def ragged_text(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(fields, width, line_no) of text lines, beside the columns of partition folders."""
    read = numbered_lines(spark, path)
    kept = [c for c in read.columns if c not in ("value", "file", "file_line")]
    return read.select(*kept, ragged_fields(F.col("value"), sep).alias("fields")).withColumn("width", F.size("fields"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema)
