"""User samples and the grid of experiment arms they are crawled under."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_SIZE = 200
CONTROL_ARM = "online"


def feed_users(interactions: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Distinct (user_id, nr_zip) seen on the feed."""
    return (
        interactions.where(
            F.col("pdate").between(F.lit(first_day), F.lit(last_day))
            & (F.col("channel_name") == "foryou")
        )
        .select("user_id", "nr_zip")
        .distinct()
    )


def user_sample(users: DataFrame, n: int = SAMPLE_SIZE, seed: int | None = None) -> DataFrame:
    """``n`` users in random order."""
    return users.orderBy(F.rand(seed)).limit(n)


def sample_check(sample: DataFrame, users: DataFrame) -> DataFrame:
    """One row: users of the sample, distinct ones, and those that are in the pool."""
    pool = users.distinct().withColumn("known", F.lit(1))
    same = sample["user_id"].eqNullSafe(pool["user_id"]) & sample["nr_zip"].eqNullSafe(pool["nr_zip"])
    return sample.join(pool, same, "left").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_distinct(F.struct(sample["user_id"], sample["nr_zip"])).alias("distinct_users"),
        F.count("known").alias("in_pool"),
    )


def _draw(seed: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "nr_zip")]
    return F.md5(F.concat_ws("|", *parts, F.lit(seed)))


def user_sample_hashed(users: DataFrame, n: int = SAMPLE_SIZE, seed: str = "0") -> DataFrame:
    """``n`` users in the order of a salted digest: repeatable for one seed."""
    draw = _draw(seed)
    return users.orderBy(draw, "user_id", "nr_zip").limit(n)


def sample_arm_grid(
    users: DataFrame,
    labels: Sequence[str],
    buckets: Sequence[str],
    max_users: int | None = None,
) -> DataFrame:
    """Every user under the control arm and under every (label, bucket) arm.

    Labels and buckets pair by position; lists of unequal length run the
    control arm alone. ``max_users`` keeps the first users by id.
    """
    arms = [(CONTROL_ARM, "")]
    if len(labels) == len(buckets):
        arms += list(zip(labels, buckets))
    grid = F.array(*[F.struct(F.lit(a).alias("arm"), F.lit(b).alias("bucket")) for a, b in arms])
    if max_users is not None:
        users = users.orderBy("user_id", "nr_zip").limit(max_users)
    return users.select("user_id", "nr_zip", F.inline(grid))
