"""Every operator as a named query over the test tables.

Windows span all 30 generated days, so each query reads its whole tables;
thresholds are lowered to what the data can reach.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import kvstore, sinks
from feedloom.itemsets import ItemSets
from feedloom.jobs import CROSS_PREFIX, NEW_PREFIX, TOP_PREFIX, VARIANT_ORDER
from feedloom.ledger import RunLedger
from feedloom.operators import keyed_lists as lists
from feedloom.operators.facets import DIMENSIONS
from feedloom.plans import engage, feedparse, geo, history, review, sampling, sync, tabs
from feedloom.snapshots import KeyedSnapshot
from feedloom.staging import stage, stage_counted, staging_root
from feedloom.sources.bucketed import read_together, write_bucketed
from feedloom.sources import schemas
from feedloom.sources.files import json_lines, numbered_lines, ragged_text, zip_lines
from feedloom.sources.testdata import (
    ALL_DAYS,
    AS_OF,
    AS_OF_TIME,
    CONTENT_HOST,
    FIRST_DAY,
    LAST_DAY,
    FeedTables,
    load,
)

Query = Callable[[SparkSession, str], DataFrame]

MIN_USERS = 5
MIN_CHECK = 5
DOC_DAYS = 3
NEW_DOC_HOURS = 48
TOP_LIST_SIZE = 200
LOW_CHECK = 5
SAMPLE = 100
SAMPLE_SEED = "0"
ARM_LABELS = ("rank_a", "rank_b")
ARM_BUCKETS = ("rank_exp-v1", "rank_exp-v2")
ARTICLE_URL = "https://articles.example.com/{}?noRedirect=1"
IMAGE_PROXY = "https://images.example.com/image?url="
NEW_HOST = "https://images.example.com"
METRIC_HOST = "host1"
ASSESS_DOCS = 50

QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that engines with different date types compare equal."""
    return df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _register(name: str, build: Callable[[FeedTables], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: _plain(build(load(spark, folder)))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- geo lists


def city_facts(t: FeedTables) -> DataFrame:
    return geo.city_doc_user(t.interactions, t.zip_geo, AS_OF, cjv_days=ALL_DAYS)


def cross_geo(t: FeedTables, dimension: str, latest: bool = False) -> DataFrame:
    facts = stage(city_facts(t), "city-doc-user")
    return geo.cross_geo(
        facts, t.doc_dim, dimension, AS_OF, DOC_DAYS,
        min_users=MIN_USERS, min_check=MIN_CHECK, dedupe_docs=latest,
    )


def daily_states(t: FeedTables) -> DataFrame:
    """User states of all days, computed day by day in one pass."""
    rows = geo.local_impressions(t.interactions, AS_OF, ALL_DAYS)
    return stage(geo.zip_doc_states(rows, ["pdate"]), "daily-states")


def cross_geo_states(t: FeedTables, dimension: str) -> DataFrame:
    states = stage(geo.city_states(daily_states(t).drop("pdate"), t.zip_geo, AS_OF), "city-states")
    return geo.cross_geo(
        states, t.doc_dim, dimension, AS_OF, DOC_DAYS,
        min_users=MIN_USERS, min_check=MIN_CHECK, measure=geo.state_metrics,
    )


def city_category(t: FeedTables) -> DataFrame:
    return geo.city_category_ctr(city_facts(t), t.doc_dim, "channel", AS_OF, DOC_DAYS)


def doc_facts(t: FeedTables) -> DataFrame:
    return geo.doc_impressions(t.interactions, AS_OF, cjv_days=ALL_DAYS)


def top_docs(
    t: FeedTables, dimension: str, facts: DataFrame | None = None, latest: bool = False
) -> DataFrame:
    facts = doc_facts(t) if facts is None else facts
    return geo.geo_top_docs(
        facts, t.doc_dim, dimension, AS_OF, DOC_DAYS, min_check=MIN_CHECK, dedupe_docs=latest
    )


def top_docs_bucketed(t: FeedTables, dimension: str) -> DataFrame:
    """The same lists from facts and documents that are laid out by document."""
    spark = t.interactions.sparkSession
    root = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/bucketed-{uuid.uuid4().hex}"
    write_bucketed(geo.local_impressions(t.interactions, AS_OF, ALL_DAYS), f"{root}/facts", "doc_id", 8)
    write_bucketed(t.doc_dim, f"{root}/docs", "doc_id", 8)
    facts, docs = read_together(spark, f"{root}/facts", f"{root}/docs")
    return geo.geo_top_docs(
        geo.doc_impressions(facts, AS_OF, ALL_DAYS), docs, dimension, AS_OF, DOC_DAYS, min_check=MIN_CHECK
    )


def top_docs_kv(t: FeedTables, dimension: str, facts: DataFrame | None = None) -> DataFrame:
    return geo.geo_top_docs_kv(top_docs(t, dimension, facts), TOP_LIST_SIZE)


def new_docs(t: FeedTables, dimension: str, latest: bool = False) -> DataFrame:
    return geo.geo_new_docs(
        t.doc_dim, dimension, AS_OF_TIME, doc_days=DOC_DAYS, hours=NEW_DOC_HOURS, dedupe_docs=latest
    )


def merged_top_docs(t: FeedTables) -> DataFrame:
    facts = stage(doc_facts(t), "doc-impressions")
    merged = lists.merge_variants([top_docs_kv(t, d, facts) for d in VARIANT_ORDER])
    return lists.kv_publish(merged, TOP_PREFIX)


def merged_new_docs(t: FeedTables) -> DataFrame:
    return lists.kv_publish(lists.merge_variants([new_docs(t, d) for d in VARIANT_ORDER]), NEW_PREFIX)


def gates(t: FeedTables) -> DataFrame:
    facts = stage(doc_facts(t), "doc-impressions")
    return _union(
        [lists.publish_gate(new_docs(t, d), f"geo_new_docs_{d}") for d in DIMENSIONS]
        + [lists.publish_gate(top_docs(t, d, facts), f"geo_top_docs_{d}") for d in DIMENSIONS]
    )


def observed_gates(t: FeedTables) -> DataFrame:
    """The gates, from the passes that land the lists."""
    facts = stage(doc_facts(t), "doc-impressions")
    results = {f"geo_new_docs_{d}": new_docs(t, d) for d in DIMENSIONS}
    results |= {f"geo_top_docs_{d}": top_docs(t, d, facts) for d in DIMENSIONS}
    rows = []
    for name, found in results.items():
        _, measured = stage_counted(found, name, lists.gate_measures())
        rows.append((name, measured["result_rows"], lists.passes(measured)))
    return t.interactions.sparkSession.createDataFrame(rows, "list_name string, result_rows long, publish boolean")


for _dim in DIMENSIONS:
    _register(f"cross_geo_{_dim}", lambda t, d=_dim: cross_geo(t, d))
    _register(f"cross_geo_{_dim}_states", lambda t, d=_dim: cross_geo_states(t, d))
    _register(f"geo_top_docs_{_dim}", lambda t, d=_dim: top_docs(t, d))
    _register(f"geo_new_docs_{_dim}", lambda t, d=_dim: new_docs(t, d))
    _register(f"cross_geo_{_dim}_latest", lambda t, d=_dim: cross_geo(t, d, latest=True))
    _register(f"geo_top_docs_{_dim}_latest", lambda t, d=_dim: top_docs(t, d, latest=True))
    _register(f"geo_new_docs_{_dim}_latest", lambda t, d=_dim: new_docs(t, d, latest=True))
_register("geo_top_docs_channel_bucketed", lambda t: top_docs_bucketed(t, "channel"))
_register("city_category_ctr", city_category)
_register("cross_geo_kv", lambda t: geo.cross_geo_kv(cross_geo(t, "channel")))
_register("geo_top_docs_kv", lambda t: top_docs_kv(t, "channel"))
_register("kv_size_stats", lambda t: lists.kv_size_stats(top_docs_kv(t, "channel")))
_register("geo_kv_merged", merged_top_docs)
_register("geo_new_kv_merged", merged_new_docs)
_register("publish_gate", gates)
_register("publish_gate_observed", observed_gates)
_register(
    "kv_publish",
    lambda t: lists.kv_publish(geo.cross_geo_kv(cross_geo(t, "first_cat")), CROSS_PREFIX["first_cat"]),
)



def stored_lists(t: FeedTables) -> DataFrame:
    """What a store holds after three batches: lists that expire, hashes, and the lists again, later."""
    spark = t.interactions.sparkSession
    store = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}"
    merged = stage(merged_top_docs(t), "merged")
    kvstore.publish(merged.withColumn("value", F.lit("earlier")), store, 0)
    kvstore.publish(tabs.hot_tab_hash(hot_docs(t)), store, 0)
    kvstore.publish(merged, store, 1000)
    return kvstore.read(spark, store, 2000).select("key", F.coalesce("field", F.lit("")).alias("field"), "value", "expires_at")


_register("kv_store_alive", stored_lists)

# ---------------------------------------------------------------- engagement


def engaged(t: FeedTables, scope: str, by: str) -> DataFrame:
    if scope == "local":
        rows, size = engage.local_engagement(t.interactions, AS_OF, ALL_DAYS), engage.LOCAL_LIST_SIZE
    else:
        rows, size = engage.nonlocal_engagement(t.interactions, AS_OF, ALL_DAYS), engage.NONLOCAL_LIST_SIZE
    return engage.top_engaged(rows, t.doc_static, by, size)


def engagement_hashes(t: FeedTables) -> DataFrame:
    listed = engage.engagement_lists(t.interactions, t.doc_static, AS_OF, ALL_DAYS)
    return engage.engagement_hash(listed, F.col("list_name"))


_register("local_top_comments", lambda t: engaged(t, "local", "cmts"))
_register("local_top_likes", lambda t: engaged(t, "local", "likes"))
_register("nonlocal_top_comments", lambda t: engaged(t, "nonlocal", "cmts"))
_register("nonlocal_top_likes", lambda t: engaged(t, "nonlocal", "likes"))
_register("hash_publish", engagement_hashes)

# ---------------------------------------------------------------------- tabs


def tab_docs(t: FeedTables) -> DataFrame:
    return tabs.tab_doc_ctr(t.interactions, AS_OF, ALL_DAYS)


def smoothed(t: FeedTables) -> DataFrame:
    return tabs.tab_smoothed_ctr(tab_docs(t), t.doc_profile)


def hot_docs(t: FeedTables) -> DataFrame:
    return tabs.hot_tab_docs(smoothed(t), LOW_CHECK)


def hot_fresh(t: FeedTables) -> DataFrame:
    fresh = tabs.fresh_docs(smoothed(t), t.doc_static, tabs.epoch_of(AS_OF_TIME), days=1.5, short_days=0.5)
    return tabs.hot_tab_docs(fresh, LOW_CHECK)


def metric_points(t: FeedTables) -> DataFrame:
    points = tabs.tab_metric_points(tabs.tab_reports(t.interactions, FIRST_DAY, LAST_DAY), METRIC_HOST)
    return points.select("metric", "ts", "value", F.col("tags")["host"].alias("host"))


_register("tab_doc_ctr", tab_docs)
_register("tab_smoothed_ctr", smoothed)
_register("hot_tab_docs", hot_docs)
_register("hot_tab_docs_fresh", hot_fresh)
_register("hot_tab_publish", lambda t: tabs.hot_tab_hash(hot_docs(t)))
_register("tab_metrics", lambda t: tabs.tab_metrics(t.interactions, FIRST_DAY, LAST_DAY))
_register("tab_metrics_total", lambda t: tabs.tab_metrics_total(t.interactions, FIRST_DAY, LAST_DAY))
_register("tab_metric_points", metric_points)

# ----------------------------------------------------------- samples, parsing


def users(t: FeedTables) -> DataFrame:
    return sampling.feed_users(t.interactions, FIRST_DAY, LAST_DAY)


def items(t: FeedTables) -> DataFrame:
    return feedparse.feed_items(t.feed_dump)


def metadata(t: FeedTables) -> DataFrame:
    return feedparse.doc_metadata(t.doc_meta_json, AS_OF.isoformat())


def drawn(t: FeedTables) -> DataFrame:
    """What can be said of a random sample: its size, and that its users are in the pool."""
    return sampling.sample_check(sampling.user_sample(users(t), SAMPLE, seed=7), users(t))


_register("user_sample", drawn)
_register("user_sample_hashed", lambda t: sampling.user_sample_hashed(users(t), SAMPLE, SAMPLE_SEED))
_register(
    "sample_arm_grid",
    lambda t: sampling.sample_arm_grid(
        sampling.user_sample_hashed(users(t), SAMPLE, SAMPLE_SEED), ARM_LABELS, ARM_BUCKETS
    ),
)
_register("feed_items", items)
_register("doc_metadata", metadata)
_register("crawl_rows", lambda t: feedparse.crawl_rows(items(t), metadata(t)))
_register(
    "crawl_enqueue",
    lambda t: review.first_outcomes(
        feedparse.crawl_rows(items(t), metadata(t)), t.written_ledger, t.reviews
    ),
)
_register("assess_dedupe", lambda t: feedparse.assess_dedupe(t.crawl_rows, ASSESS_DOCS))

# -------------------------------------------------------------------- review


def first_outcomes(t: FeedTables) -> DataFrame:
    return review.first_outcomes(t.crawl_rows, t.written_ledger, t.reviews)


def run_ledger(t: FeedTables) -> DataFrame:
    """Ledger of three runs of ten days each, two of which were run again.

    The second failed after its messages were written, and the first is repeated
    after it; both find what they found before.
    """
    spark = t.crawl_rows.sparkSession
    ledger = RunLedger(spark, f"{staging_root(spark)}/{spark.sparkContext.applicationId}/ledger-{uuid.uuid4().hex}")
    source = F.concat(F.lit("from="), F.date_format("day", "yyyy-MM-dd"), F.lit("."), "arm")
    tens = F.least(F.floor((F.dayofmonth("day") - 1) / 10), F.lit(2))

    def run(number: int) -> DataFrame:
        lines = t.crawl_rows.where(tens == number)
        before = t.written_ledger.select("docid").unionByName(ledger.entries(without=f"r{number}").select("docid"))
        return stage(review.ledger_rows(review.first_outcomes(lines, before, t.reviews), source), "run-rows")

    ledger.commit("r0", run(0))
    run(1).count()
    ledger.commit("r1", run(1))
    ledger.commit("r0", run(0))
    ledger.commit("r2", run(2))
    return ledger.entries()


def reviewed(t: FeedTables) -> DataFrame:
    return review.reviewed_docs(t.crawl_rows, t.reviews)


def labeled(t: FeedTables) -> DataFrame:
    gate = stage(review.review_gate(reviewed(t)), "review-gate")
    return review.review_labeled(t.crawl_rows, t.reviews, gate)


def daily_and_gate(t: FeedTables) -> tuple[DataFrame, DataFrame]:
    docs = stage(reviewed(t), "reviewed-docs")
    gate = stage(review.review_gate(docs), "review-gate")
    return review.review_daily(docs, gate), gate


def payload(t: FeedTables) -> DataFrame:
    rows = review.review_payload(
        t.display_doc,
        F.lit(AS_OF_TIME.isoformat(sep=" ")),
        ARTICLE_URL,
        IMAGE_PROXY,
        {CONTENT_HOST: NEW_HOST},
    )
    return rows.select(
        "_id", "type", "mp_full_article", "doc.date", "doc.title", "doc.url",
        F.array_join("doc.image_urls", " ").alias("image_urls"), "doc.content", "insert_time",
    )


def review_points(t: FeedTables) -> DataFrame:
    daily, gate = daily_and_gate(t)
    daily = stage(daily, "review-daily")
    points = _union([review.review_metric_points(daily, gate, days) for days in (1, 7)])
    return points.select("metric", "ts", "value", F.col("tags")["client"].alias("client"))


_register("review_enqueue", lambda t: review.review_enqueue(t.crawl_rows, first_outcomes(t)))
_register("review_enqueue_counts", lambda t: review.review_enqueue_counts(t.crawl_rows, first_outcomes(t)))
_register("review_messages", lambda t: review.review_messages(first_outcomes(t)))
_register(
    "review_ledger_rows",
    lambda t: review.ledger_rows(
        first_outcomes(t), F.concat(F.lit("from="), F.date_format("day", "yyyy-MM-dd"), F.lit("."), "arm")
    ),
)
_register("review_run_ledger", run_ledger)
_register("review_payload", payload)
_register("review_lookup", lambda t: review.review_lookup(t.crawl_rows, t.reviews))
_register("review_gate", lambda t: review.review_gate(reviewed(t)))
_register("review_labeled", labeled)
_register("editor_weighted", lambda t: review.editor_weighted(reviewed(t)))
_register("editor_unique", lambda t: review.editor_unique(reviewed(t)))
_register("review_summary", lambda t: review.review_summary(*daily_and_gate(t)))
_register("review_status", lambda t: review.review_status(*daily_and_gate(t)))
_register("review_status_reason", lambda t: review.review_status_reason(*daily_and_gate(t)))
_register("review_unique_status", lambda t: review.review_unique_status(*daily_and_gate(t)))
_register("review_7d", lambda t: review.review_summary(*daily_and_gate(t), 7))
_register("review_7d_status", lambda t: review.review_status(*daily_and_gate(t), 7))
_register("review_7d_status_reason", lambda t: review.review_status_reason(*daily_and_gate(t), 7))
_register("review_7d_unique_status", lambda t: review.review_unique_status(*daily_and_gate(t), 7))
_register("review_metric_points", review_points)

# ------------------------------------------------------- history, index sync


def user_history(t: FeedTables) -> DataFrame:
    return history.user_history(
        t.interactions, t.doc_static_daily,
        FIRST_DAY, LAST_DAY, date(2023, 8, 1), AS_OF, snapshot=AS_OF,
    )


def history_by_days(t: FeedTables) -> DataFrame:
    """The history from kept item sets: two thirds of the days folded, the others as they landed."""
    bounds = (date(2023, 8, 1), AS_OF, AS_OF)
    sets = ItemSets(t.interactions.sparkSession, _folder(t, "user-items"), "user_id", buckets=8)
    days = [FIRST_DAY + timedelta(days=k) for k in range((LAST_DAY - FIRST_DAY).days + 1)]
    for landed in (days[:20], days[20:]):
        sets.put(history.read_items(t.interactions, t.doc_static_daily, landed[0], landed[-1], *bounds), landed)
        sets.fold(days[19], FIRST_DAY)
    return history.kept_history(sets, FIRST_DAY, LAST_DAY)


def sync_outcome(t: FeedTables) -> DataFrame:
    return sync.index_sync_outcome(t.timeliness_updates, t.search_index)


def merged_index(t: FeedTables) -> DataFrame:
    """The index after two update runs, the first folded into the base of its buckets.

    The second run changes once more what half of the documents got in the first.
    """
    spark = t.search_index.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/index-{uuid.uuid4().hex}"
    index = KeyedSnapshot(spark, path, "docid", buckets=8)
    index.create(t.search_index)
    first = sync.index_changes(sync.index_sync_outcome(t.timeliness_updates, index.read()))
    index.update(first)
    index.compact()
    again = F.concat(F.lit("again "), "timeliness_type").alias("timeliness_type")
    index.update(first.where(F.col("docid").cast("long") % 3 == 1).select("docid", again))
    return index.read()


def _folder(t: FeedTables, label: str) -> str:
    spark = t.interactions.sparkSession
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def pasted_rows(t: FeedTables) -> DataFrame:
    """Crawl rows put together from two texts, line by line; the second lacks the last tenth."""
    spark, left, right = t.crawl_rows.sparkSession, _folder(t, "items"), _folder(t, "pages")
    rows = stage(t.crawl_rows.select("line_no", "uid", "pos", "title", "url"), "paste")
    last = rows.agg(F.max("line_no")).first()[0]
    sinks.write_delimited(rows.orderBy("line_no").select("uid", "pos"), left)
    sinks.write_delimited(rows.where(F.col("line_no") <= last * 0.9).orderBy("line_no").select("title", "url"), right)
    return zip_lines(numbered_lines(spark, left), numbered_lines(spark, right))


def synced_text(t: FeedTables) -> DataFrame:
    """The outcome of updates that are read from lines of control-separated text."""
    lines = t.timeliness_updates.orderBy("line_no").select(F.array_join("fields", "\x01").alias("value"))
    lines.write.text(path := _folder(t, "updates"))
    return sync.index_sync_outcome(ragged_text(lines.sparkSession, path, "\x01"), t.search_index)


def items_of_json(t: FeedTables) -> DataFrame:
    """Items of feed dumps that are read from JSON lines."""
    t.feed_dump.withColumn("day", F.date_format("day", "yyyy-MM-dd")).write.json(path := _folder(t, "dumps"))
    return feedparse.feed_items(json_lines(t.feed_dump.sparkSession, path, schemas.JSON["feed_dump"]))


def messages_of_log(t: FeedTables) -> DataFrame:
    """Reindex messages from a log with other lines in it, some of them cut off."""
    outcome = stage(sync_outcome(t), "outcome")
    told = sync.outcome_log(outcome, AS_OF_TIME.isoformat(sep=" "))
    other = outcome.select(F.concat(F.lit("process doc="), "docid").alias("value"))
    cut = outcome.select(F.concat(F.lit("docid="), "docid").alias("value"))
    told.unionByName(other).unionByName(cut).write.text(path := _folder(t, "log"))
    return sync.reindex_messages(sync.logged_outcome(numbered_lines(outcome.sparkSession, path)), t.doc_static)


_register("crawl_paste", pasted_rows)
_register("index_sync_text", synced_text)
_register("feed_items_json", items_of_json)
_register("reindex_messages_from_log", messages_of_log)
_register("user_history", user_history)
_register("user_history_by_days", history_by_days)
_register("index_sync_outcome", sync_outcome)
_register("index_sync_lines", lambda t: sync.update_line_counts(t.timeliness_updates))
_register("index_sync_counts", lambda t: sync.index_sync_counts(sync_outcome(t)))
_register("index_sync_snapshot", lambda t: sync.index_sync_snapshot(t.timeliness_updates, t.search_index))
_register("index_snapshot_merged", merged_index)
_register("reindex_messages", lambda t: sync.reindex_messages(sync_outcome(t), t.doc_static))
_register("timeliness_lookup", lambda t: sync.timeliness_lookup(t.lookup_ids, t.doc_static))
