"""Exact distinct counts that can be kept per day and merged over trailing windows.

Whole-number ids are parted into buckets of 32,768 neighbours. The state of a group
has one row a bucket: the places of its ids as a list where they are few, a bitmap of
4 KB where they are many, and sums beside them. States of days and of groups merge by
putting bitmaps together, so a window of any length reads each day's facts once, when
the day is over, and no id is counted twice. A row never holds more than a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import commits

#: From this many ids of a bucket on, a bitmap is smaller than a list of two bytes each.
DENSE_IDS = 2048
BUCKET, PLACES, BITS = "id_bucket", "id_places", "id_bits"


def distinct_states(
    rows: DataFrame, keys: Sequence[str], id_col: str, sums: Sequence[Column], dense: int = DENSE_IDS
) -> DataFrame:
    """States of the distinct ``id_col`` per group, with ``sums`` of its rows beside them.

    A null id counts in the sums only. ``sums`` must be additive: a group's totals
    are those of its states.
    """
    place = F.bitmap_bit_position(id_col).cast("smallint")
    grouped = rows.groupBy(*keys, F.bitmap_bucket_number(id_col).alias(BUCKET)).agg(
        *sums, F.collect_set(place).alias(PLACES), F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS)
    )
    many = F.size(PLACES) >= dense
    return grouped.withColumns(
        {PLACES: F.when(~many, F.col(PLACES)), BITS: F.when(many, F.col(BITS))}
    )


def merged_counts(states: DataFrame, keys: Sequence[str], sums: Sequence[str], name: str) -> DataFrame:
    """Number of distinct ids per group as ``name``, and totals of ``sums``.

    Lists are set into bitmaps and bitmaps put together, a bucket of a group at a
    time, partly before the shuffle.
    """
    kept = [*keys, BUCKET]
    spread = states.select(*kept, *sums, BITS, F.posexplode_outer(PLACES).alias("_nth", "_place"))
    # A state's sums count with its first id only.
    first = F.coalesce(F.col("_nth"), F.lit(0)) == 0
    halves = spread.groupBy(*kept).agg(
        *[F.sum(F.when(first, F.col(s))).alias(s) for s in sums],
        F.bitmap_or_agg(BITS).alias("_dense"),
        F.bitmap_construct_agg(F.col("_place").cast("long")).alias("_sparse"),
    )
    whole = (
        halves.select(*kept, *sums, F.explode(F.array("_dense", "_sparse")).alias(BITS))
        .groupBy(*kept)
        .agg(*[F.max(s).alias(s) for s in sums], F.bitmap_count(F.bitmap_or_agg(BITS)).alias(name))
    )
    return whole.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums], F.sum(name).alias(name))


class DailyStates:
    """States of one folder a day; a day appears as a whole and may be computed again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def days(self) -> list[date]:
        return sorted(map(date.fromisoformat, commits.numbered(self.spark, self.path, "day")))

    def open_days(self, first: date, last: date) -> list[date]:
        """Days of a window that are to be computed: those that are absent, and those whose facts
        may still have been arriving when they were, the last one and the one before."""
        known = set(self.days())
        window = [first + timedelta(days=k) for k in range((last - first).days + 1)]
        return [d for d in window if d not in known or d >= last - timedelta(days=1)]

    def put(self, states: DataFrame, day: date) -> None:
        commits.replace(states, self.path, f"day={day.isoformat()}")

    def window(self, first: date, last: date) -> DataFrame:
        """States of the days of a window that are there."""
        found = [f"{self.path}/day={d.isoformat()}" for d in self.days() if first <= d <= last]
        if not found:
            raise ValueError(f"no states from {first} to {last} in {self.path}")
        return self.spark.read.option("basePath", self.path).parquet(*found)
