"""The scheduled jobs end to end: read tables, compute, gate, write.

    spark-submit --py-files feedloom.zip run_job.py geo_top_docs \\
        --tables <folder> --out <folder> --as-of 2024-01-31

Tables are Parquet folders named as in ``sources.schemas``, the fact and the
snapshots partitioned by ``pdate``. Every job takes its clock as an argument.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import commits, kvstore, sinks
from feedloom.itemsets import ItemSets
from feedloom.ledger import RunLedger
from feedloom.operators import keyed_lists as lists
from feedloom.operators.distinct_states import DailyStates
from feedloom.plans import engage, feedparse, geo, history, review, sampling, sync, tabs
from feedloom.session import build_session
from feedloom.snapshots import KeyedSnapshot
from feedloom.sources import schemas
from feedloom.sources.bucketed import read_together, write_bucketed
from feedloom.sources.files import json_lines, numbered_lines, partitioned_table, ragged_text, with_int_flags
from feedloom.sources.logs import quarantined, read_log
from feedloom.staging import clear, stage, stage_counted

# List prefixes, and the order in which the variants overwrite
# each other where they share one.
CROSS_PREFIX = {
    "channel": "local_geo_channel",
    "first_cat": "local_geo_first_cat",
    "second_cat": "local_geo_second_cat",
}
TOP_PREFIX = "local_geo_top"
NEW_PREFIX = "local_geo_new"
VARIANT_ORDER = ("first_cat", "second_cat", "channel")
MIN_RESULT_ROWS = 100
ANALYSIS_DAYS = 7


@dataclass(frozen=True)
class Run:
    """Where a job reads and writes, and the time it runs for.

    ``formats`` names inputs that are not plain Parquet: ``json`` lines, ``text``, or
    ``bucketed`` layouts.
    """

    spark: SparkSession
    tables: str
    out: str
    as_of: datetime
    formats: Mapping[str, str] = field(default_factory=dict)
    one_file: bool = False

    @property
    def day(self) -> date:
        return self.as_of.date()

    def table(self, name: str) -> DataFrame:
        if self.formats.get(name) == "json":
            return json_lines(self.spark, f"{self.tables}/{name}", schemas.JSON[name])
        if self.formats.get(name) == "bucketed":
            return self.dealt()[name]
        df = partitioned_table(self.spark, f"{self.tables}/{name}")
        return with_int_flags(df) if name == "interactions" else df

    def dealt(self) -> dict[str, DataFrame]:
        """The inputs given as bucketed layouts, which must be dealt alike."""
        names = [n for n, kind in self.formats.items() if kind == "bucketed"]
        frames = read_together(self.spark, *[f"{self.tables}/{n}" for n in names])
        return dict(zip(names, frames, strict=True))

    def lines(self, name: str, sep: str) -> DataFrame:
        """Fields, width and order of the lines of a text input, or such a table."""
        if self.formats.get(name) == "text":
            return ragged_text(self.spark, f"{self.tables}/{name}", sep)
        return self.table(name)

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def has(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def fresh_path(self, name: str) -> str:
        """Where a result goes that has the name of an input: never onto the input."""
        if self.tables.rstrip("/") == self.out.rstrip("/"):
            raise ValueError(f"{name} is read from {self.tables} and must be written elsewhere")
        return self.path(name)


def _publish_list(
    run: Run, name: str, rows: DataFrame, kv: DataFrame, prefix: str, min_rows: int, order: Sequence[Column]
) -> bool:
    """Land the rows in order, then publish the list unless the result is too short.

    The gate's count comes from the pass that lands the rows. ``one_file`` of a run
    joins them into one file beside their folder.
    """
    landed = run.path(f"{name}/rows")
    counts = sinks.write_delimited(rows, landed, order=order, measures=lists.gate_measures())
    if run.one_file:
        sinks.merge_parts(run.spark, landed, run.path(f"{name}/rows.txt"))
    if not lists.passes(counts, min_rows):
        return False
    published = lists.kv_publish(kv, prefix)
    published.write.mode("overwrite").parquet(run.path(f"{name}/kv"))
    return True


def store_of(run: Run) -> str:
    """The store that the lists are published to: read it with ``kvstore.read``."""
    return run.path("store")


def _to_store(run: Run, written: str) -> None:
    """Commit a written list to the store, as one batch with the clock of the run."""
    kvstore.publish(run.spark.read.parquet(run.path(written)), store_of(run), tabs.epoch_of(run.as_of))


def _merge_published(run: Run, name: str, published: list[str]) -> None:
    """The one key space variants of a shared prefix end up in."""
    if published:
        variants = [run.spark.read.parquet(run.path(f"{variant}/kv")) for variant in published]
        merged = lists.merge_variants(variants).withColumn("ttl_sec", F.lit(lists.LIST_TTL_SEC))
        merged.write.mode("overwrite").parquet(run.path(f"{name}/kv"))
        _to_store(run, f"{name}/kv")


def cross_geo(
    run: Run,
    min_users: int = 1000,
    min_check: int = 100,
    min_rows: int = MIN_RESULT_ROWS,
    dedupe_docs: bool = False,
    cjv_days: int = 3,
) -> None:
    """Cross-geo lists from daily states: a run reads the facts of days that are new or not over."""
    first = run.day - timedelta(days=cjv_days)
    daily = DailyStates(run.spark, run.path("zip_doc_states"))
    for day in daily.open_days(first, run.day):
        rows = geo.local_impressions(run.table("interactions").where(F.col("pdate") == F.lit(day)), day, 0)
        daily.put(geo.zip_doc_states(rows), day)
    window = daily.window(first, run.day).drop("day")
    facts = stage(geo.city_states(window, run.table("zip_geo"), run.day), "city-states")
    for dimension in VARIANT_ORDER:
        name = f"cross_geo_{dimension}"
        found = geo.cross_geo(
            facts, run.table("doc_dim"), dimension, run.day,
            min_users=min_users, min_check=min_check, dedupe_docs=dedupe_docs, measure=geo.state_metrics,
        )
        rows = stage(found, name)
        prefix = CROSS_PREFIX[dimension]
        if _publish_list(run, name, rows, geo.cross_geo_kv(rows), prefix, min_rows, geo.cross_geo_order()):
            _to_store(run, f"{name}/kv")


def geo_top_docs(
    run: Run,
    min_check: int = 100,
    max_size: int = 200,
    min_rows: int = MIN_RESULT_ROWS,
    dedupe_docs: bool = False,
) -> None:
    per_doc = stage(geo.doc_impressions(run.table("interactions"), run.day), "doc-impressions")
    published = []
    for dimension in VARIANT_ORDER:
        name = f"geo_top_docs_{dimension}"
        found = geo.geo_top_docs(
            per_doc, run.table("doc_dim"), dimension, run.day, min_check=min_check, dedupe_docs=dedupe_docs
        )
        rows = stage(found, name)
        kv = geo.geo_top_docs_kv(rows, max_size)
        if _publish_list(run, name, rows, kv, TOP_PREFIX, min_rows, geo.geo_top_docs_order()):
            published.append(name)
    _merge_published(run, "geo_top_docs", published)


def geo_new_docs(
    run: Run, hours: int = 6, max_size: int = 20, min_rows: int = MIN_RESULT_ROWS, dedupe_docs: bool = False
) -> None:
    published = []
    for dimension in VARIANT_ORDER:
        name = f"geo_new_docs_{dimension}"
        found = geo.geo_new_docs(
            run.table("doc_dim"), dimension, run.as_of,
            hours=hours, max_docs_exclusive=max_size, dedupe_docs=dedupe_docs,
        )
        kv = stage(found, name)
        rows = kv.select("key", "value")
        if _publish_list(run, name, rows, kv, NEW_PREFIX, min_rows, [F.col("key")]):
            published.append(name)
    _merge_published(run, "geo_new_docs", published)


def bucket_tables(run: Run, buckets: int = 512, key: str = "doc_id") -> None:
    """Lay interactions and documents out in buckets of the document, parted by day.

    Jobs read them with ``--format interactions=bucketed --format doc_dim=bucketed``
    and join and sum them by document without a shuffle.
    """
    for name in ("interactions", "doc_dim"):
        write_bucketed(run.table(name), run.fresh_path(name), key, buckets, ["pdate"])


def engagement(run: Run, min_comments: int = 10) -> None:
    """All four lists in one pass over the fact, a folder for each hash."""
    listed = engage.engagement_lists(
        run.table("interactions"), run.table("doc_static"), run.day, min_comments=min_comments
    )
    hashes = engage.engagement_hash(listed, F.col("list_name"))
    hashes.write.mode("overwrite").partitionBy("key").parquet(run.path("engagement"))
    _to_store(run, "engagement")


def hot_tab_docs(run: Run, fresh_only: bool = False, min_check: int = 60) -> None:
    docs = tabs.tab_doc_ctr(run.table("interactions"), run.day)
    if fresh_only:
        docs = tabs.fresh_docs(docs, run.table("doc_static"), tabs.epoch_of(run.as_of)).drop("age_days")
    ranked = tabs.hot_tab_docs(tabs.tab_smoothed_ctr(docs, run.table("doc_profile")), min_check)
    tabs.hot_tab_hash(ranked).write.mode("overwrite").parquet(run.path("hot_tab_docs"))
    _to_store(run, "hot_tab_docs")


def tab_metrics(run: Run, host: str = "batch") -> None:
    """Metrics of the day before the run."""
    day = run.day - timedelta(days=1)
    reports = tabs.tab_reports(run.table("interactions"), day, day)
    tabs.tab_metric_points(reports, host).write.mode("overwrite").parquet(run.path("tab_metrics"))


def sample(run: Run, users: int = sampling.SAMPLE_SIZE, labels: str = "", buckets: str = "") -> None:
    """Draw the users of the day before, and lay out the arms they are crawled under.

    ``labels`` and ``buckets`` name experiment arms, parted by commas.
    """
    day = run.day - timedelta(days=1)
    pool = sampling.feed_users(run.table("interactions"), day, day)
    drawn = stage(sampling.user_sample_hashed(pool, users, seed=run.day.isoformat()), "sample")
    arms = [[x for x in text.split(",") if x] for text in (labels, buckets)]
    sinks.write_delimited(drawn, run.path("sample"))
    sampling.sample_arm_grid(drawn, *arms).write.mode("overwrite").parquet(run.path("sample_grid"))


def crawl_rows(run: Run, include_local: bool = False) -> None:
    """Parse the day's feed dumps and add them to the crawl rows, one folder per run."""
    dumps = run.table("feed_dump").where(F.col("day") == F.lit(run.day))
    metadata = feedparse.doc_metadata(run.table("doc_meta_json"), run.day.isoformat())
    rows = feedparse.crawl_rows(feedparse.feed_items(dumps, include_local), metadata)
    path = f"{run.path('crawl_rows')}/day={run.day.isoformat()}"
    rows.drop("day").write.mode("overwrite").partitionBy("arm").parquet(path)


def _crawl_lines(run: Run) -> DataFrame:
    """Crawl rows: those the job ``crawl_rows`` made, a table, or files of tab text."""
    own = run.path("crawl_rows")
    if run.formats.get("crawl_rows") == "text":
        return feedparse.crawl_lines(run.lines("crawl_rows", "\t")).withColumn("day", F.to_date("day"))
    if run.has(own):
        return run.spark.read.parquet(own).withColumn("day", F.to_date("day"))
    return run.table("crawl_rows")


def written_ledger(run: Run) -> RunLedger:
    """What the enqueue runs have queued, run by run."""
    return RunLedger(run.spark, run.path("written_ledger"))


def _written_before(run: Run) -> DataFrame:
    """Documents queued by other runs of this job, and those given as a table."""
    known = written_ledger(run).entries(without=run.day.isoformat()).select("docid", "source")
    given = f"{run.tables}/written_ledger"
    if run.tables.rstrip("/") != run.out.rstrip("/") and run.has(given):
        known = known.unionByName(run.spark.read.parquet(given).select("docid", "source"))
    return known


def review_enqueue(run: Run, arms: str = sampling.CONTROL_ARM) -> None:
    """Queue the documents of the day's crawl files and remember them.

    ``arms`` gives the order of the day's runs, parted by commas. A document is
    queued once, whatever the number of days. The day may be run again, also after
    it failed at any point: its messages lie in a folder of their own, its ledger
    rows are committed after them and don't count as written before.
    """
    name = run.day.isoformat()
    lines = _crawl_lines(run).where(F.col("day") == F.lit(run.day))
    firsts = stage(
        review.first_outcomes(lines, _written_before(run), run.table("reviews"), arms.split(",")), "review-firsts"
    )
    commits.replace(review.review_messages(firsts), run.path("review_messages"), f"day={name}")
    counts = review.review_enqueue_counts(lines, firsts)
    commits.replace(counts.drop("day"), run.path("review_enqueue_counts"), f"day={name}")
    source = F.concat(F.lit("from="), F.date_format("day", "yyyy-MM-dd"), F.lit("."), "arm")
    written_ledger(run).commit(name, review.ledger_rows(firsts, source))


def review_analysis(run: Run, max_fail_ratio: float = review.MAX_FAIL_RATIO) -> None:
    """Re-read the reviews of the last seven crawl days and report on each.

    The windows of the oldest of them reach another six days back.
    """
    first = run.day - timedelta(days=2 * ANALYSIS_DAYS - 1)
    last = run.day - timedelta(days=1)
    lines = _crawl_lines(run).where(F.col("day").between(F.lit(first), F.lit(last)))
    reviews = run.table("reviews")
    docs = stage(review.reviewed_docs(lines, reviews), "reviewed-docs")
    gate = stage(review.review_gate(docs, max_fail_ratio), "review-gate")
    labeled = review.review_labeled(lines, reviews, gate)
    sinks.write_delimited(labeled.drop("line_no"), run.path("review_labeled"))
    daily = stage(review.review_daily(docs, gate), "review-daily")
    reported = F.col("day") >= F.lit(run.day - timedelta(days=ANALYSIS_DAYS))
    checked = docs.join(gate.where("passed"), list(review.RUN), "left_semi")
    editors = review.editor_weighted(checked).unionByName(review.editor_unique(checked))
    editors.where(reported).write.mode("overwrite").parquet(run.path("review_editors"))
    reports = {
        "summary": review.review_summary,
        "status": review.review_status,
        "status_reason": review.review_status_reason,
        "unique_status": review.review_unique_status,
    }
    for days in (1, ANALYSIS_DAYS):
        for name, report in reports.items():
            result = report(daily, gate, days).where(reported)
            result.write.mode("overwrite").parquet(run.path(f"review_{name}_{days}d"))
        points = review.review_metric_points(daily, gate, days)
        oldest = F.unix_date(F.lit(run.day - timedelta(days=ANALYSIS_DAYS))).cast("long") * 86400
        points.where(F.col("ts") >= oldest).write.mode("overwrite").parquet(run.path(f"review_points_{days}d"))


def user_history(
    run: Run, fact_days: int = 31, publish_days: int = 190, partitions: int | None = None,
    keep: bool = False, fold_after: int = 8,
) -> None:
    """Lines ``user, part, parts, items``: a heavy reader has several.

    With ``keep`` the items are kept from run to run: a run reads the facts of days that
    are absent, of the last one and the one before it, and each day's items are chosen by
    the documents of the run that landed it last, not by today's.
    """
    first = run.day - timedelta(days=fact_days)
    bounds = dict(first_publish=run.day - timedelta(days=publish_days), last_publish=run.day, snapshot=run.day)
    facts, docs = run.table("interactions"), run.table("doc_static_daily")
    if not keep:
        rows = history.user_history(facts, docs, first_day=first, last_day=run.day, output_partitions=partitions, **bounds)
    else:
        sets = user_items(run)
        closed = sets.closed() or date.min
        recent = {d for d in (run.day - timedelta(days=1), run.day) if d > closed}
        due = recent.union(sets.open_days(first + timedelta(days=k) for k in range(fact_days + 1)))
        if due:
            sets.put(history.read_items(facts, docs, min(due), max(due), **bounds), due)
        rows = history.kept_history(sets, first, run.day, output_partitions=partitions)
    sinks.write_delimited(rows, run.path("user_history"), sep=",")
    if keep:
        user_items(run).fold(run.day - timedelta(days=2), first, min_days=fold_after)


def user_items(run: Run) -> ItemSets:
    """The items that ``user_history`` keeps."""
    return ItemSets(run.spark, run.fresh_path("user_items"), "user_id")


def search_index(run: Run) -> KeyedSnapshot:
    """The index as the jobs keep it: read it with ``read()``."""
    return KeyedSnapshot(run.spark, run.fresh_path("search_index"), "docid")


def index_sync(run: Run, compact_after: int = 8) -> None:
    """Bring the index up to date and queue the documents it does not have.

    Updates are lines of two fields parted by ``\\x01``, or a table of such lines.
    The first run takes the index from the input table, later ones from where this
    job keeps it; only changed fields are written, and buckets that ``compact_after``
    runs have touched are written anew. A run may be repeated.
    """
    index, updates = search_index(run), run.lines("timeliness_updates", "\x01")
    if not index.exists():
        index.create(run.table("search_index"))
    sync.update_line_counts(updates).write.mode("overwrite").parquet(run.path("index_sync_lines"))
    outcome, counts = stage_counted(
        sync.index_sync_outcome(updates, index.read()), "index-sync", sync.outcome_measures()
    )
    # The counters of the run are those of the pass that wrote its outcome.
    one = run.spark.createDataFrame([tuple(counts[c] for c in sync.COUNTERS)], ", ".join(f"{c} long" for c in sync.COUNTERS))
    one.write.mode("overwrite").parquet(run.path("index_sync_counts"))
    index.update(sync.index_changes(outcome))
    sync.outcome_log(outcome, run.as_of.isoformat(sep=" ")).write.mode("overwrite").text(run.path("index_sync_log"))
    messages = sync.reindex_messages(outcome, run.table("doc_static"))
    messages.write.mode("overwrite").parquet(run.path("reindex_messages"))
    index.compact(compact_after)


def reindex_from_log(run: Run) -> None:
    """Queue documents that the index lacks from the log of an update run, whoever wrote it.

    Lines that tell of a document but can't be read are written apart.
    """
    lines = stage(numbered_lines(run.spark, f"{run.tables}/index_sync_log"), "log-lines")
    messages = sync.reindex_messages(sync.logged_outcome(lines), run.table("doc_static"))
    messages.write.mode("overwrite").parquet(run.path("reindex_messages"))
    log = read_log(lines, sync.OUTCOME_LOG)
    quarantined(log).write.mode("overwrite").parquet(run.path("index_sync_log_quarantine"))


JOBS: dict[str, Callable[..., None]] = {
    job.__name__: job
    for job in (
        cross_geo, geo_top_docs, geo_new_docs, engagement, hot_tab_docs, tab_metrics, sample, crawl_rows,
        review_enqueue, review_analysis, user_history, index_sync,
        reindex_from_log, bucket_tables,
    )
}


def _value(text: str) -> int | float | bool | str:
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--tables", required=True, help="folder of the input tables")
    parser.add_argument("--out", required=True, help="folder for results")
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat, help="UTC run time")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a parameter of the job")
    parser.add_argument("--format", action="append", default=[], metavar="TABLE=FORMAT", help="json, text or bucketed input")
    parser.add_argument("--one-file", action="store_true", help="landed rows also as one file, in order")
    args = parser.parse_args()
    settings = {name: _value(text) for name, text in _pairs(args.set).items()}
    spark = build_session(f"feedloom-{args.job}")
    try:
        JOBS[args.job](Run(spark, args.tables, args.out, args.as_of, _pairs(args.format), args.one_file), **settings)
    finally:
        clear(spark)


if __name__ == "__main__":
    main()
