"""The human-review loop: enqueue, look up, label, gate and report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import day_epoch, null_text, stripped
from feedloom.plans.feedparse import CRAWL_WIDTH
from feedloom.plans.sampling import CONTROL_ARM
from feedloom.staging import stage

# A run is one crawl file: a day and an arm.
RUN = ("day", "arm")
# Queue message, id suffix of a review, statuses, metric names.
QUEUE = "quality_check"
QUEUE_TAGS = ("from_foryou",)
REVIEW_SUFFIX = "_from_foryou"
NOT_REVIEWED = "not_reviewed"
STATUSES = ("ok", "poor", "detrimental")
METRIC_PREFIX = "feed_quanlity_check_"
MAX_FAIL_RATIO = 0.8


# ---------------------------------------------------------------- enqueue


def first_outcomes(
    lines: DataFrame,
    ledger: DataFrame,
    reviews: DataFrame,
    arms: Sequence[str] = (CONTROL_ARM,),
) -> DataFrame:
    """(day, arm, docid, line_no, outcome) of the first line of a document in a run.

    Runs follow one another by day, and within a day in the order of ``arms``,
    others after them by name; each sees what the runs before it have queued. So
    a document not yet in the ledger and not under review is ``succ`` in its
    first run and a duplicate in later ones. One under review ``exist``s in every
    run, as it does not enter the ledger. Lines meet the ledger and the reviews
    as one row per run and document, and runs meet through a minimum per document.
    """
    written = ledger.select("docid").distinct().withColumn("written", F.lit(True))
    reviewed = (
        reviews.select(F.col("_id").alias("docid")).distinct().withColumn("reviewed", F.lit(True))
    )
    turn = F.coalesce(
        *[F.when(F.col("arm") == arm, k) for k, arm in enumerate(arms)], F.lit(len(arms))
    )
    run = F.struct("day", turn.alias("turn"), "arm")
    firsts = (
        lines.where(F.col("width") >= 2)
        .groupBy(*RUN, "docid")
        .agg(F.min("line_no").alias("line_no"))
        .withColumn("run", run)
    )
    first_run = firsts.groupBy(F.col("docid").alias("first_docid")).agg(F.min("run").alias("first_run"))
    outcome = (
        F.when(F.col("written"), "dup")
        .when(F.col("reviewed"), "exist")
        .when(F.col("run") == F.col("first_run"), "succ")
        .otherwise("dup")
    )
    return (
        firsts.join(first_run, F.col("docid").eqNullSafe(F.col("first_docid")))
        .join(written, "docid", "left")
        .join(reviewed, "docid", "left")
        .select(*RUN, "docid", "line_no", outcome.alias("outcome"))
    )


def review_enqueue(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Outcome of every line of a run: skip, dup, exist or succ."""
    known = firsts.select(*RUN, "line_no", "outcome")
    outcome = F.when(F.col("width") < 2, "skip").otherwise(F.coalesce("outcome", F.lit("dup")))
    return (
        lines.select(*RUN, "line_no", "docid", "width")
        .join(known, [*RUN, "line_no"], "left")
        .select(*RUN, "line_no", "docid", outcome.alias("outcome"))
    )


def review_enqueue_counts(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Counts per run of each outcome, without matching line to line."""
    run = list(RUN)
    totals = lines.groupBy(*run).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("width") < 2).alias("skip_num")
    )
    decided = firsts.groupBy(*run).agg(
        F.count_if(F.col("outcome") == "succ").alias("succ"),
        F.count_if(F.col("outcome") == "exist").alias("exist"),
    )
    succ, exist = F.coalesce("succ", F.lit(0)), F.coalesce("exist", F.lit(0))
    return totals.join(decided, run, "left").select(
        *run,
        succ.alias("succ_num"),
        exist.alias("exist_num"),
        (F.col("lines") - F.col("skip_num") - succ - exist).alias("dup_num"),
        "skip_num",
    )


def review_messages(firsts: DataFrame) -> DataFrame:
    """(key, value) queue messages of the documents to review."""
    body = F.struct(
        "docid", F.lit(QUEUE).alias("queue"), F.array(*[F.lit(t) for t in QUEUE_TAGS]).alias("tag")
    )
    return firsts.where(F.col("outcome") == "succ").select(
        F.col("docid").alias("key"), F.to_json(body).alias("value")
    )


def ledger_rows(firsts: DataFrame, source: Column) -> DataFrame:
    """(docid, source) rows to append to the ledger of written documents."""
    return firsts.where(F.col("outcome") == "succ").select("docid", source.alias("source"))


def review_payload(
    docs: DataFrame,
    insert_time: Column,
    article_url: str,
    image_proxy: str,
    hosts: Mapping[str, str],
) -> DataFrame:
    """What an editor sees of a document, absent fields filled in.

    ``article_url`` has ``{}`` for the id and replaces the url of a document
    hosted in full; ``hosts`` are rewritten inside the content.
    """
    full = F.coalesce("mp_full_article", F.lit(False))
    before, after = article_url.split("{}")
    content = F.coalesce("content", F.lit(""))
    for old, new in hosts.items():
        content = F.replace(content, F.lit(old), F.lit(new))
    images = F.transform(
        F.coalesce("image_urls", F.array().cast("array<string>")),
        lambda url: F.concat(F.lit(image_proxy), url),
    )
    return docs.select(
        "_id",
        F.lit(QUEUE).alias("type"),
        full.alias("mp_full_article"),
        F.struct(
            F.coalesce("date", F.lit("")).alias("date"),
            F.coalesce("title", F.lit("")).alias("title"),
            F.when(full, F.concat(F.lit(before), "_id", F.lit(after)))
            .otherwise(F.coalesce("url", F.lit("")))
            .alias("url"),
            images.alias("image_urls"),
            content.alias("content"),
        ).alias("doc"),
        insert_time.alias("insert_time"),
    )


# ----------------------------------------------------------- lookup, labels


def _looked_up(rows: DataFrame, reviews: DataFrame) -> DataFrame:
    """Adds ret, status, reason and editor of each row's docid."""
    state = reviews.select(
        F.col("_id").alias("review_id"),
        F.lit(True).alias("found"),
        F.col("review.status").alias("review_status"),
        F.col("review.reason").alias("review_reason"),
        F.col("review.editor").alias("review_editor"),
        F.col("review").isNotNull().alias("has_review"),
    )
    succ = F.col("review_status").isNotNull()
    error = (
        F.when(F.col("found").isNull(), "not_in_mongo")
        .when(~F.col("has_review"), "no_review")
        .otherwise("no_status")
    )
    return (
        rows.withColumn("review_id", F.concat("docid", F.lit(REVIEW_SUFFIX)))
        .join(state, "review_id", "left")
        .select(
            *rows.columns,
            F.when(succ, "succ").otherwise("error").alias("ret"),
            null_text(F.col("review_status")).alias("status"),
            F.when(succ, null_text(F.col("review_reason"))).otherwise(error).alias("reason"),
            null_text(F.col("review_editor")).alias("editor"),
        )
    )


def _label() -> list[Column]:
    """Status and reason a row is published with."""
    reviewed = F.col("ret") == "succ"
    return [
        F.when(reviewed, F.col("status")).otherwise(NOT_REVIEWED).alias("status"),
        F.when(reviewed, F.col("reason")).otherwise("").alias("reason"),
    ]


def review_lookup(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """(day, arm, line_no, docid, ret, status, reason, editor) per usable line."""
    usable = lines.where(F.col("width") > 2).select(*RUN, "line_no", "docid")
    return _looked_up(usable, reviews)


def reviewed_docs(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """The review state of every document of a run, with its numbers of lines.

    ``wrong`` lines are too short to look up, ``looked`` ones are not,
    ``complete`` ones have all fields. The gate and every report are built on
    this table alone: stage it.
    """
    per_doc = lines.groupBy(*RUN, "docid").agg(
        F.count_if(F.col("width") <= 2).alias("wrong"),
        F.count_if(F.col("width") > 2).alias("looked"),
        F.count_if(F.col("width") == CRAWL_WIDTH).alias("complete"),
    )
    return _looked_up(per_doc, reviews)


def review_gate(docs: DataFrame, max_fail_ratio: float = MAX_FAIL_RATIO) -> DataFrame:
    """Per run: line counts, fail ratio and whether the run may be reported.

    One row per crawl file. Stage it before filtering by it: its size is then
    known, and lines or documents need not be gathered by run to meet it.
    """
    succ = F.when(F.col("ret") == "succ", F.col("looked")).otherwise(0)
    counts = docs.groupBy(*RUN).agg(
        F.sum(F.col("wrong") + F.col("looked")).alias("line_cnt"),
        F.sum(succ).alias("succ_cnt"),
        F.sum("wrong").alias("wrong_cnt"),
        F.sum(F.col("looked") - succ).alias("empty_cnt"),
        F.sum("complete").alias("complete_cnt"),
    )
    failed = (F.col("wrong_cnt") + F.col("empty_cnt")).cast("double")
    fail_ratio = F.when(F.col("line_cnt") == 0, 100.0).otherwise(
        F.try_divide(failed, F.col("line_cnt").cast("double"))
    )
    return counts.withColumn("fail_ratio", fail_ratio).withColumn(
        "passed", ~(F.col("fail_ratio") > max_fail_ratio)
    )


def _passed(rows: DataFrame, gate: DataFrame) -> DataFrame:
    return rows.join(gate.where("passed").select(*RUN), list(RUN), "left_semi")


def review_labeled(lines: DataFrame, reviews: DataFrame, gate: DataFrame) -> DataFrame:
    """Complete crawl rows plus status and reason; runs the gate stops are left out."""
    complete = _passed(lines.where(F.col("width") == CRAWL_WIDTH), gate).drop("width")
    return _looked_up(complete, reviews).select(*complete.columns, *_label())


# ------------------------------------------------------------ editor check


def _editor_rates(docs: DataFrame, weight: Column, doc_type: str) -> DataFrame:
    """Totals, counts per status and their rates by editor."""
    counts = (
        docs.where((F.col("ret") == "succ") & (F.col("looked") > 0))
        .groupBy(*RUN, "editor")
        .agg(
            F.sum(weight).alias("total"),
            *[F.sum(F.when(F.col("status") == s, weight).otherwise(0)).alias(s) for s in STATUSES],
        )
    )
    total = F.col("total").cast("double")
    return counts.select(
        *RUN,
        F.lit(doc_type).alias("type"),
        "editor",
        "total",
        *STATUSES,
        *[F.try_divide(F.col(s).cast("double"), total).alias(f"{s}_rate") for s in STATUSES],
    ).orderBy(*RUN, "editor")


def editor_weighted(docs: DataFrame) -> DataFrame:
    """Per editor, every reviewed line counts."""
    return _editor_rates(docs, F.col("looked"), "weighted_doc")


def editor_unique(docs: DataFrame) -> DataFrame:
    """Per editor, a document counts once per status it was given."""
    return _editor_rates(docs, F.lit(1).cast("long"), "uniq_doc")


# ---------------------------------------------------------------- analysis


def review_daily(docs: DataFrame, gate: DataFrame) -> DataFrame:
    """(day, arm, docid, status, reason, cnt, usable): one row per run and document.

    ``cnt`` is its number of complete lines; they share the document's label.
    Every report is built on this table and the gate.
    """
    labeled = _passed(docs.where(F.col("complete") > 0), gate).select(
        *RUN, "docid", *_label(), F.col("complete").alias("cnt")
    )
    usable = (F.col("status") != NOT_REVIEWED) & (stripped(F.col("reason")) != "")
    return labeled.withColumn("usable", usable)


def _on_run_days(rows: DataFrame, gate: DataFrame) -> DataFrame:
    """Reports exist for days with a run that passed, be it without a complete line."""
    return _passed(rows, gate)


def _trailing(counts: DataFrame, gate: DataFrame, day_range: int) -> DataFrame:
    """Sum daily counts over the trailing window of each run day.

    Takes a table already counted per day, so it is a handful of rows that are
    repeated. Days missing inside a window simply add nothing.
    """
    if day_range == 1:
        return counts
    keys = [c for c in counts.columns if not c.endswith("cnt")]
    shifts = F.sequence(F.lit(0), F.lit(day_range - 1))
    shifted = counts.select("*", F.explode(shifts).alias("shift")).withColumn(
        "day", F.date_add("day", F.col("shift"))
    )
    sums = [F.sum(c).alias(c) for c in counts.columns if c.endswith("cnt")]
    return _on_run_days(shifted, gate).groupBy(*keys).agg(*sums)


def _documents_by_status(daily: DataFrame, gate: DataFrame, day_range: int) -> DataFrame:
    """(day, arm, status, cnt): distinct usable documents of each trailing window.

    The newest day is read first, so a document shows a day's status until it
    is seen again or has left the window. Each of its days thus stands for an
    interval of window days; equal intervals are counted before they unfold.
    """
    seen = daily.where("usable").select(*RUN, "docid", "status")
    if day_range == 1:
        return seen.groupBy(*RUN, "status").agg(F.count(F.lit(1)).alias("cnt"))
    seen_again = F.lead("day").over(Window.partitionBy("arm", "docid").orderBy("day"))
    intervals = (
        seen.withColumn("last", F.least(F.date_add("day", day_range - 1), F.date_sub(seen_again, 1)))
        .groupBy("arm", "status", "day", "last")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    unfolded = intervals.select(
        "arm", "status", "docs", F.explode(F.sequence("day", "last")).alias("day")
    )
    return _on_run_days(unfolded, gate).groupBy(*RUN, "status").agg(F.sum("docs").alias("cnt"))


def _shares(counts: DataFrame, whole: Sequence[str]) -> DataFrame:
    total = F.sum("cnt").over(Window.partitionBy(*whole))
    return counts.withColumn("rate", F.try_divide(F.col("cnt").cast("double"), total.cast("double")))


def review_summary(
    daily: DataFrame, gate: DataFrame, day_range: int = 1, by_status: DataFrame | None = None
) -> DataFrame:
    """Per run day: total, usable and wrong rows, distinct documents, success rate.

    ``by_status`` may hold the documents by status, if they are known already.
    """
    per_day = daily.groupBy(*RUN).agg(
        F.sum("cnt").alias("total_cnt"),
        F.sum(F.when(F.col("usable"), F.col("cnt")).otherwise(0)).alias("succ_cnt"),
        F.sum(F.when(F.col("usable"), 0).otherwise(F.col("cnt"))).alias("wrong_cnt"),
    )
    by_status = _documents_by_status(daily, gate, day_range) if by_status is None else by_status
    documents = (
        by_status
        .groupBy(*RUN)
        .agg(F.sum("cnt").alias("documents"))
    )
    rate = F.try_divide(F.col("succ_cnt").cast("double"), F.col("total_cnt").cast("double"))
    return (
        _trailing(per_day, gate, day_range)
        .join(documents, list(RUN), "left")
        .select(
            *RUN,
            "total_cnt",
            "succ_cnt",
            "wrong_cnt",
            F.coalesce("documents", F.lit(0)).alias("uniq_doc_cnt"),
            rate.alias("succ_rate"),
        )
    )


def review_status(daily: DataFrame, gate: DataFrame, day_range: int = 1) -> DataFrame:
    """Per run day and status: rows and their share of the usable rows."""
    per_day = daily.where("usable").groupBy(*RUN, "status").agg(F.sum("cnt").alias("cnt"))
    return _shares(_trailing(per_day, gate, day_range), RUN)


def review_status_reason(daily: DataFrame, gate: DataFrame, day_range: int = 1) -> DataFrame:
    """Per run day, status and reason: rows and their share of the status."""
    per_day = daily.where("usable").groupBy(*RUN, "status", "reason").agg(F.sum("cnt").alias("cnt"))
    counts = _trailing(per_day, gate, day_range)
    return _shares(counts, [*RUN, "status"]).orderBy(*RUN, "status", F.desc("cnt"), "reason")


def review_unique_status(daily: DataFrame, gate: DataFrame, day_range: int = 1) -> DataFrame:
    """Per run day and status: documents by the status seen first, newest day first."""
    return _shares(_documents_by_status(daily, gate, day_range), RUN)


def review_metric_points(
    daily: DataFrame, gate: DataFrame, day_range: int = 1, client: str = "batch"
) -> DataFrame:
    """(metric, ts, value, tags) of one window length.

    Statuses outside the three known ones are counted but not reported. The
    documents by status are counted once and written, a few rows per run and
    status; ``daily`` is read three times: stage it.
    """
    seen = stage(_documents_by_status(daily, gate, day_range), f"review-documents-{day_range}d")
    length = F.lit("" if day_range <= 1 else f"{day_range}d_")

    def named(values: DataFrame, what: Column) -> DataFrame:
        return values.select(
            F.concat(F.lit(METRIC_PREFIX), length, "arm", what).alias("metric"),
            day_epoch(F.col("day")).alias("ts"),
            F.col("point").alias("value"),
        )

    summary = {
        "total_cnt": "_count_total",
        "succ_cnt": "_count_succ",
        "wrong_cnt": "_count_wrong",
        "uniq_doc_cnt": "_count_succ_uniq_doc",
        "succ_rate": "_rate_succ",
    }
    totals = review_summary(daily, gate, day_range, seen).select(
        *RUN, *[F.col(c).cast("double").alias(suffix) for c, suffix in summary.items()]
    )
    points = named(
        totals.unpivot(list(RUN), list(summary.values()), "what", "point"), F.col("what")
    )
    by_status = {
        "status_": review_status(daily, gate, day_range),
        "uniqdoc_status_": _shares(seen, RUN),
    }
    for infix, shares in by_status.items():
        known = shares.where(F.col("status").isin(*STATUSES)).select(
            *RUN, "status", F.col("cnt").cast("double").alias("count"), "rate"
        )
        long = known.unpivot([*RUN, "status"], ["count", "rate"], "kind", "point")
        points = points.unionByName(
            named(long, F.concat(F.lit("_"), "kind", F.lit("_" + infix), "status"))
        )
    return points.withColumn("tags", F.create_map(F.lit("client"), F.lit(client)))
