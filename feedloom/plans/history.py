"""Long-term reading history per user."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.itemsets import ItemSets
from feedloom.plans.geo import FEED_CHANNELS
from feedloom.staging import stage

MIN_DWELL_MS = 2000
LONG_LIVED = ("current", "evergreen")


def user_history(
    interactions: DataFrame,
    doc_static_daily: DataFrame,
    first_day: date,
    last_day: date,
    first_publish: date,
    last_publish: date,
    snapshot: date,
    part_size: int = 100_000,
    output_partitions: int | None = None,
) -> DataFrame:
    """(user_id, part, n_parts, doc_items): distinct ``doc|ts`` items joined by tab, sorted.

    A user with more than ``part_size`` items is written in several parts, each
    item in exactly one of them, so no task ever holds a whole heavy reader.
    Everybody else has part 0 of 1. Items and heavy users are written while the
    plan is built.
    """
    seen = read_items(interactions, doc_static_daily, first_day, last_day, first_publish, last_publish, snapshot)
    return in_parts(seen.select("user_id", "item").distinct(), part_size, output_partitions)


def read_items(
    interactions: DataFrame,
    doc_static_daily: DataFrame,
    first_day: date,
    last_day: date,
    first_publish: date,
    last_publish: date,
    snapshot: date,
) -> DataFrame:
    """(user_id, item, day) of what users read, repeated as the facts repeat it."""
    published = F.to_date("publish_time").between(F.lit(first_publish), F.lit(last_publish))
    docs = doc_static_daily.where((F.col("pdate") == F.lit(snapshot)) & published).select(
        "doc_id",
        F.col("timeliness_type").isin(*LONG_LIVED).alias("long_lived"),
        (F.col("is_news_score") < 0.5).alias("non_news"),
    )
    facts = interactions.where(
        F.col("pdate").between(F.lit(first_day), F.lit(last_day))
        & (F.col("joined") == 1)
        & (F.col("checked") == 1)
        & (F.col("cv_time") >= MIN_DWELL_MS)
        & F.col("channel_name").isin(*FEED_CHANNELS)
        & (F.col("user_id") > 0)
    ).select("user_id", "doc_id", "ts", "nr_condition", F.col("pdate").alias("day"))
    wanted = F.col("long_lived") | F.col("non_news") | F.col("nr_condition").contains("evergreen")
    return (
        facts.join(docs, "doc_id")
        .where(wanted)
        .select("user_id", F.concat("doc_id", F.lit("|"), F.col("ts").cast("string")).alias("item"), "day")
        .where(F.col("item").isNotNull())
    )


def kept_history(
    sets: ItemSets,
    first_day: date,
    last_day: date,
    part_size: int = 100_000,
    output_partitions: int | None = None,
    changed_on: date | None = None,
) -> DataFrame:
    """``user_history`` from item sets that took its days one by one.

    ``changed_on`` gives only the users that this landed day touched, each with all of
    the parts, as a user that grows is parted anew.
    """
    items = sets.read(first_day, last_day)
    if items is not None and changed_on is not None:
        users = sets.touched(changed_on)
        items = None if users is None else items.join(users, sets.owner, "left_semi")
    if items is None:
        return sets.spark.createDataFrame([], "user_id long, part long, n_parts long, doc_items string")
    return in_parts(items.select("user_id", "item"), part_size, output_partitions)


def in_parts(items: DataFrame, part_size: int, output_partitions: int | None = None) -> DataFrame:
    """Distinct items (user_id, item) as sorted lists of parts."""
    parts = _parts(stage(items, "history-items"), part_size)
    # Partitioned by user *and* part: grouping by the join key alone would put
    # all parts of a heavy reader into one task.
    keys = ("user_id", "part", "n_parts")
    spread = parts.repartition(output_partitions, *keys) if output_partitions else parts.repartition(*keys)
    return spread.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("item")), "\t").alias("doc_items")
    )


def _parts(items: DataFrame, part_size: int) -> DataFrame:
    """Number the part of each item; only heavy users have more than part 0.

    The heavy users are written first, so their number decides how to join them.
    """
    heavy = (
        items.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > part_size)
        .select("user_id", F.ceil(F.col("n") / F.lit(part_size)).cast("long").alias("n_parts"))
    )
    spread: Column = F.pmod(F.xxhash64("item"), F.col("n_parts"))
    return items.join(stage(heavy, "history-heavy"), "user_id", "left").select(
        "user_id",
        "item",
        F.coalesce(spread, F.lit(0)).cast("long").alias("part"),
        F.coalesce("n_parts", F.lit(1)).cast("long").alias("n_parts"),
    )
