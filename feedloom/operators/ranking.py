"""Ranks and caps that do not need one task per key.

``top_k`` keeps a bounded list per key: Spark prunes to k rows per key before
the shuffle. ``spread_rank`` numbers *every* row of a key, also when one key
holds most of the data: rows are range partitioned into ordered slices, each
slice is numbered on its own and shifted by the size of the slices before it.
``ordered_cap`` is a global ORDER BY ... LIMIT n on the same footing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.staging import stage

_LIMIT_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"
_SLICE = "_slice"
_SIZE = "_slice_rows"
_BEFORE = "_rows_before"


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rk",
) -> DataFrame:
    """First ``k`` rows per key, numbered from 1.

    Spark cuts each key to k rows before the shuffle as long as k is within
    its window-limit threshold; a longer list is numbered slice by slice. Both
    ways give the same rows: ``order`` must be total within a key up to equal
    rows.
    """
    if k > int(df.sparkSession.conf.get(_LIMIT_THRESHOLD, "1000")):
        ranked = spread_rank(df, keys, order, rank, label="top-k")
        return ranked.where(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("int"))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def _ordered_slices(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    # The slice number is only meaningful for one sampling of the range bounds,
    # hence the written table: every later read sees the same slices.
    ranged = df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id())
    return stage(ranged, label)


def _slice_offsets(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    # One row per (key, slice): at most the number of shuffle partitions per key.
    running = (
        Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        slices.groupBy(*keys, _SLICE)
        .agg(F.count(F.lit(1)).alias(_SIZE))
        .withColumn(_BEFORE, F.coalesce(F.sum(_SIZE).over(running), F.lit(0)))
    )


def _join_offsets(slices: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    left, right = slices.alias("l"), offsets.alias("r")
    on = F.col(f"l.{_SLICE}") == F.col(f"r.{_SLICE}")
    for key in keys:
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, on).select("l.*", f"r.{_BEFORE}")


def spread_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rk",
    label: str = "ranked",
) -> DataFrame:
    """Number all rows of every key, 1..n, without collecting a key in a task.

    ``order`` must be total within a key, so that slices can split any key.
    """
    slices = _ordered_slices(df, [F.col(k) for k in keys] + list(order), label)
    placed = _join_offsets(slices, _slice_offsets(slices, keys), keys)
    window = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    return placed.withColumn(
        rank, F.row_number().over(window).cast("long") + F.col(_BEFORE)
    ).drop(_SLICE, _BEFORE)


def ordered_cap(
    df: DataFrame, order: Sequence[Column], limit: int | None, label: str = "capped"
) -> DataFrame:
    """First ``limit`` rows of the whole frame in ``order``, sorted.

    An explicit cap only: without a limit all rows come out. The frame is
    written while the plan is built; slices past the cap are skipped and only
    the slice on the boundary is cut by rank. ``order`` must be total.
    """
    if limit is None:
        return df.orderBy(*order)
    return _first_rows(df, order, limit, label).orderBy(*order)


def _first_rows(df: DataFrame, order: Sequence[Column], limit: int, label: str) -> DataFrame:
    slices = _ordered_slices(df, order, f"{label}-slices")
    offsets = _slice_offsets(slices, []).where(F.col(_BEFORE) < limit)
    placed = _join_offsets(slices, offsets, [])
    window = Window.partitionBy(_SLICE).orderBy(*order)
    return (
        placed.withColumn("_row", F.row_number().over(window) + F.col(_BEFORE))
        .where(F.col("_row") <= limit)
        .drop("_row", _SLICE, _BEFORE)
    )
