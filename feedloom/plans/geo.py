"""Click-through by city, category and geotag, and the lists built on it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import rounded_ctr, within
from feedloom.operators.distinct_states import distinct_states, merged_counts
from feedloom.operators.facets import doc_facets, latest_snapshot, list_keys
from feedloom.operators.keyed_lists import kv_fold, kv_parts
from feedloom.operators.ranking import ordered_cap, top_k
from feedloom.staging import stage

FEED_CHANNELS = ("foryou", "local")


def local_impressions(interactions: DataFrame, as_of: date, cjv_days: int) -> DataFrame:
    """Checked impressions that a local recall condition brought into the feed."""
    return interactions.where(
        within(F.col("pdate"), as_of, cjv_days)
        & (F.col("joined") == 1)
        & (F.col("checked") == 1)
        & F.col("channel_name").isin(*FEED_CHANNELS)
        & F.col("nr_condition").contains("local")
    )


def city_doc_user(
    interactions: DataFrame, zip_geo: DataFrame, as_of: date, cjv_days: int = 3, zip_days: int = 2
) -> DataFrame:
    """Sums per (city, doc, user): all the city metrics need of the fact.

    Repeat impressions fold here, before categories and geotags fan out. Stage
    it once and every dimension can be computed without the fact.
    """
    zips = zip_geo.where(F.col("pdate") == F.lit(as_of - timedelta(days=zip_days))).select(
        F.col("id").alias("nr_zip"), "city_id"
    )
    return (
        local_impressions(interactions, as_of, cjv_days)
        .join(zips.where(F.col("city_id").isNotNull()), "nr_zip")
        .groupBy("city_id", "doc_id", "user_id")
        .agg(*_sum_up("checked", "clicked"))
    )


def zip_doc_states(interactions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums and user states per (zip, doc) of checked local impressions, and per ``keys``.

    Zips meet their cities when the states are read, as cities change.
    """
    sums = [F.sum("checked").alias("checks"), F.sum("clicked").alias("clicks")]
    return distinct_states(interactions, [*keys, "nr_zip", "doc_id"], "user_id", sums)


def city_states(states: DataFrame, zip_geo: DataFrame, as_of: date, zip_days: int = 2) -> DataFrame:
    """The states of a window per (city, doc): takes the place of ``city_doc_user`` facts."""
    zips = zip_geo.where(F.col("pdate") == F.lit(as_of - timedelta(days=zip_days))).select(
        F.col("id").alias("nr_zip"), "city_id"
    )
    return states.join(zips.where(F.col("city_id").isNotNull()), "nr_zip").drop("nr_zip")


def doc_impressions(interactions: DataFrame, as_of: date, cjv_days: int = 3) -> DataFrame:
    """Sums per document, the only part of the fact the document lists need."""
    return (
        local_impressions(interactions, as_of, cjv_days)
        .groupBy("doc_id")
        .agg(*_sum_up("checked", "clicked"))
    )


def _sum_up(checks: str = "checks", clicks: str = "clicks") -> list[Column]:
    return [F.sum(checks).alias("checks"), F.sum(clicks).alias("clicks")]


def _metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    totals = rows.groupBy(*keys).agg(
        *_sum_up(),
        F.count_distinct("doc_id").alias("docs"),
        F.count_distinct("user_id").alias("users"),
    )
    return totals.select(
        *keys,
        rounded_ctr(F.col("clicks"), F.col("checks")).alias("ctr"),
        "checks",
        "clicks",
        "docs",
        "users",
    )


def state_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The metrics of ``_metrics`` from user states instead of users."""
    totals = merged_counts(rows, keys, ("checks", "clicks"), "users")
    docs = rows.groupBy(*keys).agg(F.count_distinct("doc_id").alias("docs"))
    docs = docs.select(*[F.col(k).alias(f"of_{k}") for k in keys], "docs")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])
    return totals.join(docs, same).select(
        *keys, rounded_ctr(F.col("clicks"), F.col("checks")).alias("ctr"), "checks", "clicks", "docs", "users"
    )


def city_category_ctr(
    facts: DataFrame,
    doc_dim: DataFrame,
    dimension: str,
    as_of: date,
    doc_days: int = 3,
    dedupe_docs: bool = False,
) -> DataFrame:
    """Metrics per (city, category) of ``city_doc_user`` facts.

    Impressions of no category form a NULL group.
    """
    docs = doc_facets(doc_dim, dimension, as_of, doc_days, dedupe_docs).select(
        "doc_id", F.explode("categories").alias("category")
    )
    return _metrics(facts.join(docs, "doc_id", "left"), ["city_id", "category"])


def cross_geo(
    facts: DataFrame,
    doc_dim: DataFrame,
    dimension: str,
    as_of: date,
    doc_days: int = 3,
    min_users: int = 1000,
    min_check: int = 100,
    max_rows: int | None = None,
    dedupe_docs: bool = False,
    measure: Callable[[DataFrame, Sequence[str]], DataFrame] = _metrics,
) -> DataFrame:
    """Geotags a city reads more eagerly than the rest of a category.

    A (city, category, geotag) is kept when its rounded ctr is strictly above
    the one of (city, category) over *all* documents of the category, tagged or
    not. Both grains come out of one aggregate: every impression counts once
    under the marker row ``overall`` and once per geotag; the baseline is then
    joined to its geotags.

    Sums decide the uplift and are cheap; distinct users and documents are
    counted only for the groups that pass, and for their baselines: facts meet
    the (city, category) pairs of those before their geotags fan out. ``facts``
    (``city_doc_user``) is read twice: stage it. The groups that pass are
    written while the plan is built. All rows come out, in no order;
    ``max_rows`` keeps the first ones by city, category and ctr, sorted.

    ``city_states`` may stand for the facts, with ``state_metrics`` as ``measure``.
    """
    group = ["city_id", "category"]
    keys = [*group, "overall", "type_pid"]
    overall = F.array(
        F.struct(F.lit(True).alias("overall"), F.lit(None).cast("string").alias("type_pid"))
    )
    per_tag = F.transform(
        "geos", lambda geo: F.struct(F.lit(False).alias("overall"), geo.alias("type_pid"))
    )
    docs = doc_facets(doc_dim, dimension, as_of, doc_days, dedupe_docs)

    def per_category(rows: DataFrame) -> DataFrame:
        return (
            rows.join(docs, "doc_id")
            .select(*rows.columns, "geos", F.explode("categories").alias("category"))
            .where(F.col("category").isNotNull())
        )

    def fan_out(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != "geos"]
        return rows.select(*kept, F.inline(F.concat(overall, per_tag)))

    sums = (
        fan_out(per_category(facts.groupBy("city_id", "doc_id").agg(*_sum_up())))
        .groupBy(*keys)
        .agg(*_sum_up())
        .withColumn("ctr", rounded_ctr(F.col("clicks"), F.col("checks")))
    )
    base_ctr = sums.where("overall").select(*group, F.col("ctr").alias("base_ctr"))
    wanted = (
        sums.where(~F.col("overall") & (F.col("checks") >= min_check))
        .join(base_ctr, group)
        .where(F.col("ctr") > F.col("base_ctr"))
        .select(*group, F.col("type_pid"))
    )
    wanted = stage(wanted, f"cross-geo-{dimension}")
    pairs = wanted.select(*group).distinct()
    candidates = fan_out(per_category(facts).join(pairs, group, "left_semi"))
    same_tag = reduce(
        Column.__and__,
        [F.col(c).eqNullSafe(F.col(f"wanted_{c}")) for c in (*group, "type_pid")],
    )
    named = wanted.select(*[F.col(c).alias(f"wanted_{c}") for c in wanted.columns])
    metrics = ("ctr", "checks", "clicks", "docs", "users")
    tags = measure(
        candidates.where(~F.col("overall")).join(named, same_tag, "left_semi"), [*group, "type_pid"]
    )
    base = measure(candidates.where("overall"), group).where(F.col("users") >= min_users)
    uplifted = tags.join(
        base.select(*group, *[F.col(m).alias(f"base_{m}") for m in metrics]), group
    ).select(*group, "type_pid", *metrics, *[f"base_{m}" for m in metrics])
    return _capped(uplifted, cross_geo_order(), max_rows, f"cross-geo-{dimension}-capped")


def cross_geo_order() -> list[Column]:
    """The order in which the rows are landed."""
    return [F.col("city_id"), F.col("category"), F.col("ctr").desc(), F.col("type_pid")]


def _capped(rows: DataFrame, order: list[Column], max_rows: int | None, label: str) -> DataFrame:
    return rows if max_rows is None else ordered_cap(rows, order, max_rows, label=label)


def cross_geo_kv(rows: DataFrame) -> DataFrame:
    """``city@category`` → geotags, best ctr first, every geotag kept, in numbered parts."""
    return kv_parts(
        rows,
        key=F.concat("city_id", F.lit("@"), "category"),
        item=F.col("type_pid"),
        order=[-F.col("ctr"), F.col("type_pid")],
    )


def geo_top_docs(
    per_doc: DataFrame,
    doc_dim: DataFrame,
    dimension: str,
    as_of: date,
    doc_days: int = 3,
    min_check: int = 100,
    max_rows: int | None = None,
    dedupe_docs: bool = False,
) -> DataFrame:
    """Documents whose ctr is at least the ctr of their ``category@type@pid``.

    ``per_doc`` (``doc_impressions``) brings one row per document to the
    document's keys, and these fan out only after the join. All rows come out,
    in no order; ``max_rows`` keeps the first ones by key and ctr, sorted.
    """
    docs = doc_dim.where(within(F.col("pdate"), as_of, doc_days))
    if dedupe_docs:
        docs = latest_snapshot(docs)
    keys = docs.select("doc_id", list_keys(dimension).alias("list_keys"))
    per_key_doc = (
        per_doc.join(keys, "doc_id")
        .select("doc_id", "checks", "clicks", F.explode("list_keys").alias("list_key"))
        .groupBy("list_key", "doc_id")
        .agg(*_sum_up())
    )

    ctr = rounded_ctr(F.col("clicks"), F.col("checks"))
    docs = per_key_doc.where(F.col("checks") >= min_check).withColumn("ctr", ctr)
    base = per_key_doc.groupBy("list_key").agg(*_sum_up()).select(
        F.col("list_key").alias("base_key"),
        ctr.alias("base_ctr"),
        F.col("checks").alias("base_checks"),
        F.col("clicks").alias("base_clicks"),
    )
    kept = (
        docs.join(base, F.col("list_key") == F.col("base_key"))
        .where(F.col("ctr") >= F.col("base_ctr"))
        .select(
            "list_key", "doc_id", "ctr", "checks", "clicks",
            "base_key", "base_ctr", "base_checks", "base_clicks",
        )
    )
    return _capped(kept, geo_top_docs_order(), max_rows, f"geo-top-docs-{dimension}")


def geo_top_docs_order() -> list[Column]:
    """The order in which the rows are landed."""
    return [F.col("list_key"), F.col("ctr").desc(), F.col("doc_id")]


def geo_top_docs_kv(rows: DataFrame, max_size: int = 200) -> DataFrame:
    """``category@type@pid`` → its first ``max_size`` documents by ctr."""
    return kv_fold(
        rows,
        key=F.col("list_key"),
        item=F.col("doc_id"),
        order=[-F.col("ctr"), F.col("doc_id")],
        max_size=max_size,
    )


def geo_new_docs(
    doc_dim: DataFrame,
    dimension: str,
    as_of: datetime,
    doc_days: int = 1,
    hours: int = 6,
    max_docs_exclusive: int = 20,
    dedupe_docs: bool = False,
) -> DataFrame:
    """``category@type@pid`` → newest documents of the last hours.

    The cap is exclusive: 20 keeps 19. A document that carries the key twice
    takes two places and is listed once. Order within a list is by id.
    """
    hour = as_of.replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)
    # Written as text, the bound does not depend on the time zone of the driver.
    since = F.lit(hour.isoformat(sep=" ")).cast(doc_dim.schema["publish_time"].dataType)
    docs = doc_dim.where(within(F.col("pdate"), as_of.date(), doc_days))
    if dedupe_docs:
        docs = latest_snapshot(docs)
    recent = docs.where(F.col("publish_time") >= since)
    newest = top_k(
        recent.select("doc_id", "publish_time", F.explode(list_keys(dimension)).alias("list_key")),
        ["list_key"],
        [F.col("publish_time").desc(), F.col("doc_id")],
        max_docs_exclusive - 1,
    )
    return (
        newest.groupBy(F.col("list_key").alias("key"))
        .agg(F.sort_array(F.collect_set("doc_id")).alias("ids"))
        .select("key", F.size("ids").alias("size"), F.array_join("ids", "#").alias("value"))
    )
