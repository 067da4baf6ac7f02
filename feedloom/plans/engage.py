"""Most commented and most liked documents per category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import starts_local, within
from feedloom.operators.keyed_lists import hash_publish
from feedloom.operators.ranking import top_k
from feedloom.plans.geo import FEED_CHANNELS

# List sizes and hash names.
LOCAL_LIST_SIZE = 500
NONLOCAL_LIST_SIZE = 300
HASH_NAMES = {
    ("local", "cmts"): "localTopCmts",
    ("local", "likes"): "localTopLikes",
    ("nonlocal", "cmts"): "nonLocalTopCmts",
    ("nonlocal", "likes"): "nonLocalTopLikes",
}
CATEGORY_LEVELS = ("first_cat", "second_cat", "third_cat")


def _counters(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(
        F.max("doc_comment_cnt").alias("cmts"), F.max("doc_thumb_up_cnt").alias("likes")
    )


def local_engagement(interactions: DataFrame, as_of: date, days: int = 2) -> DataFrame:
    """(doc_id, cmts, likes) of local impressions; a counter never seen is 0."""
    rows = interactions.where(
        within(F.col("pdate"), as_of, days, closed=True)
        & (F.col("joined") == 1)
        & F.col("channel_name").isin(*FEED_CHANNELS)
        & starts_local(F.col("nr_condition"))
    )
    return _counters(rows).select(
        "doc_id",
        F.coalesce("cmts", F.lit(0)).cast("double").alias("cmts"),
        F.coalesce("likes", F.lit(0)).cast("double").alias("likes"),
    )


def nonlocal_engagement(
    interactions: DataFrame, as_of: date, days: int = 2, min_comments: int = 10
) -> DataFrame:
    """(doc_id, cmts, likes) of other impressions with more than ``min_comments``.

    A NULL condition is neither local nor non-local and is dropped, and so is a
    document whose likes were never seen.
    """
    rows = interactions.where(
        within(F.col("pdate"), as_of, days, closed=True)
        & (F.col("joined") == 1)
        & (F.col("channel_name") == "foryou")
        & ~starts_local(F.col("nr_condition"))
    )
    return (
        _counters(rows)
        .where((F.col("cmts") > min_comments) & F.col("likes").isNotNull())
        .select("doc_id", F.col("cmts").cast("double").alias("cmts"), F.col("likes").cast("double").alias("likes"))
    )


def all_categories(text_category: str = "text_category_v2") -> Column:
    """Names of all three levels, concatenated; a name at two levels stays twice."""
    empty = F.lit(None).cast("map<string,double>")
    names = [
        F.coalesce(F.map_keys(F.coalesce(F.col(f"{text_category}.{level}"), empty)), F.array().cast("array<string>"))
        for level in CATEGORY_LEVELS
    ]
    return F.concat(*names)


def top_engaged(
    engagement: DataFrame, doc_static: DataFrame, by: str, list_size: int
) -> DataFrame:
    """(category, rk, doc_id, cmts, likes): the first ``list_size`` by one counter."""
    if by not in ("cmts", "likes"):
        raise ValueError(f"rank by 'cmts' or 'likes', not {by!r}")
    docs = doc_static.select(F.col("_id").alias("doc_id"), all_categories().alias("names"))
    listed = engagement.join(docs, "doc_id").select(
        F.explode("names").alias("category"), "doc_id", "cmts", "likes"
    )
    return top_k(listed, ["category"], [F.col(by).desc(), F.col("doc_id")], list_size)


def engagement_lists(
    interactions: DataFrame,
    doc_static: DataFrame,
    as_of: date,
    days: int = 2,
    min_comments: int = 10,
) -> DataFrame:
    """(list_name, category, rk, doc_id, cmts, likes): all four lists in one pass.

    Counters of both scopes come out of one aggregate over the fact, categories
    are joined once, and the rows of all lists are ranked by one window.
    """
    local, other = starts_local(F.col("nr_condition")), ~starts_local(F.col("nr_condition"))
    foryou = F.col("channel_name") == "foryou"
    cmts, likes = F.col("doc_comment_cnt"), F.col("doc_thumb_up_cnt")
    totals = (
        interactions.where(
            within(F.col("pdate"), as_of, days, closed=True)
            & (F.col("joined") == 1)
            & F.col("channel_name").isin(*FEED_CHANNELS)
        )
        .groupBy("doc_id")
        .agg(
            F.count_if(local).alias("local_rows"),
            F.max(F.when(local, cmts)).alias("local_cmts"),
            F.max(F.when(local, likes)).alias("local_likes"),
            F.max(F.when(other & foryou, cmts)).alias("nonlocal_cmts"),
            F.max(F.when(other & foryou, likes)).alias("nonlocal_likes"),
        )
    )
    listed = {
        "local": F.col("local_rows") > 0,
        "nonlocal": (F.col("nonlocal_cmts") > min_comments) & F.col("nonlocal_likes").isNotNull(),
    }

    def entry(scope: str, by: str) -> Column:
        counters = {c: F.coalesce(f"{scope}_{c}", F.lit(0)).cast("double") for c in ("cmts", "likes")}
        size = LOCAL_LIST_SIZE if scope == "local" else NONLOCAL_LIST_SIZE
        fields = F.struct(
            F.lit(HASH_NAMES[scope, by]).alias("list_name"),
            F.lit(size).alias("list_size"),
            counters[by].alias("score"),
            *[c.alias(name) for name, c in counters.items()],
        )
        return F.when(listed[scope], fields)

    entries = F.filter(F.array(*[entry(*name) for name in HASH_NAMES]), lambda e: e.isNotNull())
    docs = doc_static.select(F.col("_id").alias("doc_id"), all_categories().alias("names"))
    rows = (
        totals.select("doc_id", entries.alias("entries"))
        .where(F.size("entries") > 0)
        .join(docs, "doc_id")
        .select("doc_id", "entries", F.explode("names").alias("category"))
        .select("doc_id", "category", F.inline("entries"))
    )
    longest = max(LOCAL_LIST_SIZE, NONLOCAL_LIST_SIZE)
    ranked = top_k(rows, ["list_name", "category"], [F.col("score").desc(), F.col("doc_id")], longest)
    return ranked.where(F.col("rk") <= F.col("list_size")).select(
        "list_name", "category", "rk", "doc_id", "cmts", "likes"
    )


def engagement_hash(ranked: DataFrame, hash_key: str | Column) -> DataFrame:
    """Hash rows category → JSON array of ``{docId, likes, cmts}``."""
    element = F.struct(F.col("doc_id").alias("docId"), "likes", "cmts")
    return hash_publish(ranked, hash_key, "category", element)
