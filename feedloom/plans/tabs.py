"""Per-tab document ranking and per-tab metrics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import day_epoch, ratio, within
from feedloom.operators.keyed_lists import hash_publish
from feedloom.operators.ranking import spread_rank

# Tab ids and their names, for the hot lists and for the metrics.
HOT_TAB_NAMES = {
    "k122516": "crime",
    "k122515": "entertain(celebrity,tv,movie,music)",
    "k122521": "sport(nfl,nba,mlb,nhl,wwe)",
    "k122522": "lifestyle(food,travel)",
    "k122551": "pet",
    "k122524": "society",
    "k122525": "tech",
    "k122519": "health",
    "k122552": "science",
    "k122564": "vehicles",
    "k122567": "food",
    "k122565": "travel",
    "k122563": "fitness",
    "k122562": "beauty",
    "k122571": "animal",
    "k122572": "military",
    "k122573": "games",
    "k122574": "comics",
    "k122575": "horoscope",
}
METRIC_TAB_NAMES = {
    "k122516": "crime",
    "k122515": "entertain",
    "k122521": "sport",
    "k122522": "lifestyle",
    "k122551": "pet",
    "k122524": "society",
    "k122525": "tech",
    "k122519": "health",
    "k122552": "science",
    "k122564": "vehicles",
    "k122567": "food",
    "k122565": "travel",
    "k122563": "fitness",
    "k122562": "beauty",
    "k122566": "home_garden",
    "k122571": "animal",
    "k122572": "military",
    "k122573": "games",
    "k122574": "comics",
    "k122575": "horoscope",
    "k122561": "outdoor",
    "k122586": "finance",
    "k26164": "headline",
}
HEADLINE_TAB = "k26164"
SHORT_EXPIRY_TABS = ("k122521", "k122525")
HOT_TAB_HASH = "tabHotDocs#2d"
TOTAL_TAB = "tot"
# Metric names in publishing order.
TAB_METRICS = (
    "dau", "clicks", "checks", "shares", "ctr", "str1", "str2",
    "click_pu", "check_pu", "share_pu", "up_pu",
)


def tab_name(channel_id: Column, names: Mapping[str, str]) -> Column:
    """Name of a tab id, NULL for an unmapped one."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), channel_id)


def tab_doc_ctr(interactions: DataFrame, as_of: date, days: int = 2) -> DataFrame:
    """(tab, doc_id, channel_id) → ctr, checks, clicks; unmapped tabs are kept.

    A group whose clicks were never recorded has no ctr and is left out.
    """
    return (
        interactions.where(
            within(F.col("pdate"), as_of, days, closed=True)
            & (F.col("channel_name") == "channelnew")
            & (F.col("joined") == 1)
            & (F.col("checked") == 1)
        )
        .groupBy("doc_id", "channel_id")
        .agg(F.sum("checked").alias("checks"), F.sum("clicked").alias("clicks"))
        .where(F.col("clicks").isNotNull())
        .select(
            tab_name(F.col("channel_id"), HOT_TAB_NAMES).alias("tab"),
            "doc_id",
            "channel_id",
            ratio(F.col("clicks"), F.col("checks")).alias("ctr"),
            "checks",
            "clicks",
        )
    )


def tab_smoothed_ctr(
    tab_docs: DataFrame, doc_profile: DataFrame, use_2d_click: bool = False
) -> DataFrame:
    """Adds acc_check, acc_click and acc_ctr from the 1-day and 2-day profile.

    Half the weight of the 2-day clicks goes to the 1-day clicks, as the
    published lists have it; ``use_2d_click`` weighs the 2-day clicks instead.
    """

    def counter(profile: str, field: str) -> Column:
        cell = F.try_element_at(F.col(profile), F.col("channel_id"))
        return F.coalesce(cell[field].cast("double"), F.lit(0.0))

    joined = tab_docs.join(
        doc_profile.select("doc_id", "tab_cfb_1d", "tab_cfb_2d"), "doc_id", "left"
    )
    half = counter("tab_cfb_2d" if use_2d_click else "tab_cfb_1d", "click") * 0.5
    checks = counter("tab_cfb_1d", "view") + counter("tab_cfb_2d", "view") * 0.5 + F.lit(30)
    clicks = counter("tab_cfb_1d", "click") + half + F.lit(1)
    return joined.select(
        *tab_docs.columns,
        clicks.alias("acc_click"),
        checks.alias("acc_check"),
        (clicks / checks).alias("acc_ctr"),
    )


def fresh_docs(
    tab_docs: DataFrame,
    doc_static: DataFrame,
    as_of_epoch: int,
    days: float = 7,
    short_days: float = 2,
) -> DataFrame:
    """Keeps documents up to 7 days old, 2 for short-expiry tabs; adds age_days.

    A document without an epoch counts as published at 0 and drops out.
    """
    epochs = doc_static.select(F.col("_id").alias("doc_id"), "epoch")
    age = (F.lit(as_of_epoch) - F.coalesce("epoch", F.lit(0))) / F.lit(86400.0)
    limit = F.when(F.col("channel_id").isin(*SHORT_EXPIRY_TABS), float(short_days)).otherwise(float(days))
    return (
        tab_docs.join(epochs, "doc_id", "left")
        .withColumn("age_days", age)
        .where(F.col("age_days") <= limit)
        .drop("epoch")
    )


def hot_tab_docs(smoothed: DataFrame, min_check: int = 60) -> DataFrame:
    """All documents of a tab ranked by smoothed ctr, low-volume ones behind.

    The list is not capped, so the numbering is spread over slices of a tab.
    """
    keyed = smoothed.withColumn("low_check", F.col("checks") < min_check)
    order = [F.col("low_check"), F.col("acc_ctr").desc(), F.col("doc_id")]
    return spread_rank(keyed, ["channel_id"], order, label="hot-tab-docs").drop("low_check")


def hot_tab_hash(ranked: DataFrame, part_size: int = 1000) -> DataFrame:
    """Hash rows tab id → JSON arrays of ``{docId, tabId, ctr, click, check}``."""
    element = F.struct(
        F.col("doc_id").alias("docId"),
        F.col("channel_id").alias("tabId"),
        F.col("acc_ctr").alias("ctr"),
        F.col("acc_click").alias("click"),
        F.col("acc_check").alias("check"),
    )
    return hash_publish(ranked, HOT_TAB_HASH, "channel_id", element, part_size=part_size)


def tab_reports(interactions: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Metrics per (day, tab, os), and per (day, os) under the tab ``tot``.

    The fact is summed once to (day, os, tab id, channel, user); each sum then
    counts for its tab, and for the total if it is of the new tabs, unmapped ones
    included. A daily run passes the same day twice.
    """
    new_tab = F.col("channel_name") == "channelnew"
    headline = (F.col("channel_name") == "channel") & (F.col("channel_id") == HEADLINE_TAB)
    counters = ("clicked", "checked", "shared", "thumbed_up")
    per_user = (
        interactions.where(
            F.col("pdate").between(F.lit(first_day), F.lit(last_day))
            & (F.col("joined") == 1)
            & (F.col("checked") == 1)
            & (new_tab | headline)
        )
        .groupBy("pdate", "os", "channel_id", "channel_name", "user_id")
        .agg(*[F.sum(c).alias(c) for c in counters])
    )
    reports = F.array(
        tab_name(F.col("channel_id"), METRIC_TAB_NAMES), F.when(new_tab, F.lit(TOTAL_TAB))
    )
    rows = per_user.select(
        "pdate", "os", "user_id", *counters, F.explode(reports).alias("tab")
    ).where(F.col("tab").isNotNull())
    totals = rows.groupBy("pdate", "tab", "os").agg(
        F.count_distinct("user_id").alias("dau"),
        F.sum("clicked").alias("clicks"),
        F.sum("checked").alias("checks"),
        F.sum("shared").alias("shares"),
        F.sum("thumbed_up").alias("ups"),
    )
    c = F.col
    return totals.select(
        "pdate",
        "tab",
        "os",
        "dau",
        "clicks",
        "checks",
        "shares",
        ratio(c("clicks"), c("checks")).alias("ctr"),
        ratio(c("shares"), c("clicks")).alias("str1"),
        ratio(c("shares"), c("checks")).alias("str2"),
        ratio(c("clicks"), c("dau")).alias("click_pu"),
        ratio(c("checks"), c("dau")).alias("check_pu"),
        ratio(c("shares"), c("dau")).alias("share_pu"),
        ratio(c("ups"), c("dau")).alias("up_pu"),
    )


def tab_metrics(interactions: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Metrics per (day, tab, os)."""
    return tab_reports(interactions, first_day, last_day).where(F.col("tab") != TOTAL_TAB)


def tab_metrics_total(interactions: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Metrics per (day, os) over all ``channelnew`` rows, unmapped tabs included."""
    return tab_reports(interactions, first_day, last_day).where(F.col("tab") == TOTAL_TAB)


def tab_metric_points(metrics: DataFrame, host: str) -> DataFrame:
    """(metric, ts, value, tags) points ``tabmetric.<metric>.<os>.<tab>``.

    A row with any NULL metric, or no os, publishes nothing at all.
    """
    complete = metrics.dropna(subset=["tab", "os", *TAB_METRICS])
    wide = complete.select(
        "pdate", "tab", "os", *[F.col(m).cast("double").alias(m) for m in TAB_METRICS]
    )
    return wide.unpivot(["pdate", "tab", "os"], list(TAB_METRICS), "name", "value").select(
        F.concat_ws(".", F.lit("tabmetric"), "name", "os", "tab").alias("metric"),
        day_epoch(F.col("pdate")).alias("ts"),
        "value",
        F.create_map(F.lit("host"), F.lit(host)).alias("tags"),
    )


def epoch_of(moment: datetime) -> int:
    """Epoch seconds of a UTC wall-clock moment."""
    return int((moment - datetime(1970, 1, 1)).total_seconds())
