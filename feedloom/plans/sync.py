"""Keeping a search index in step with document timeliness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import stripped
from feedloom.sources.logs import LogFormat, log_rows, read_log

# Outcome texts.
NOT_IN_INDEX = "none"
UPDATED = "succ_update_es"


# Fields of an update line: document and timeliness.
UPDATE_WIDTH = 2


def latest_updates(updates: DataFrame) -> DataFrame:
    """(docid, timeliness): the last whole line of a document wins.

    ``updates`` has the ``fields``, ``width`` and ``line_no`` of each line. Lines
    of more or fewer than two fields are no updates.
    """
    whole = updates.where(F.col("width") == UPDATE_WIDTH).select(
        stripped(F.col("fields")[0]).alias("docid"),
        stripped(F.col("fields")[1]).alias("timeliness"),
        "line_no",
    )
    return whole.groupBy("docid").agg(F.max_by("timeliness", "line_no").alias("timeliness"))


def update_line_counts(updates: DataFrame) -> DataFrame:
    """One row: lines read, and lines left out for their width."""
    return updates.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("width") != UPDATE_WIDTH).alias("left_out"),
    )


def index_sync_outcome(updates: DataFrame, search_index: DataFrame) -> DataFrame:
    """(docid, timeliness, msg) per updated document."""
    indexed = search_index.select("docid").distinct().withColumn("indexed", F.lit(True))
    return (
        latest_updates(updates)
        .join(indexed, "docid", "left")
        .select(
            "docid",
            "timeliness",
            F.when(F.col("indexed"), UPDATED).otherwise(NOT_IN_INDEX).alias("msg"),
        )
    )


COUNTERS = ("total", "in_es", "succ_update_es")


def outcome_measures() -> dict[str, Column]:
    """Counters of an outcome: documents updated, found in the index, updated there."""
    updated = F.count_if(F.col("msg") == UPDATED)
    return dict(zip(COUNTERS, (F.count(F.lit(1)), updated, updated), strict=True))


def index_sync_counts(outcome: DataFrame) -> DataFrame:
    """One row of the counters."""
    return outcome.agg(*[column.alias(name) for name, column in outcome_measures().items()])


def index_sync_snapshot(updates: DataFrame, search_index: DataFrame) -> DataFrame:
    """The index after the update: only ``timeliness_type`` changes."""
    rest = [c for c in search_index.columns if c not in ("docid", "timeliness_type")]
    return search_index.join(latest_updates(updates), "docid", "left").select(
        "docid", F.coalesce("timeliness", "timeliness_type").alias("timeliness_type"), *rest
    )


def index_changes(outcome: DataFrame) -> DataFrame:
    """What an update run changes in the index: one field of the documents it holds."""
    return outcome.where(F.col("msg") == UPDATED).select("docid", F.col("timeliness").alias("timeliness_type"))


def reindex_messages(outcome: DataFrame, doc_static: DataFrame) -> DataFrame:
    """(key, value) messages ``{docId, url}`` for documents not in the index."""
    urls = doc_static.select(F.col("_id").alias("docid"), "url")
    body = F.struct(F.col("docid").alias("docId"), F.coalesce("url", F.lit("")).alias("url"))
    return (
        outcome.where(F.col("msg") == NOT_IN_INDEX)
        .join(urls, "docid", "left")
        .select(F.col("docid").alias("key"), F.to_json(body).alias("value"))
    )


#: A line of the log of an update run that tells of a document.
OUTCOME_LOG = LogFormat(
    marker="docid=", columns="docid string, timeliness string, msg string", pattern=r"docid=(\S+) (\S*) msg=(\S+)$"
)


def outcome_log(outcome: DataFrame, stamp: str) -> DataFrame:
    """The outcome as lines of a log, as the update run writes them."""
    said = F.concat(F.lit("docid="), "docid", F.lit(" "), "timeliness", F.lit(" msg="), "msg")
    return outcome.select(F.concat(F.lit(f"{stamp} : INFO : "), said).alias("value"))


def logged_outcome(lines: DataFrame) -> DataFrame:
    """The outcome of update runs, from the lines of their logs: the last one of a document counts."""
    rows = log_rows(read_log(lines, OUTCOME_LOG))
    last = rows.groupBy("docid").agg(F.max_by(F.struct("timeliness", "msg"), "line_no").alias("last"))
    return last.select("docid", "last.timeliness", "last.msg")


def timeliness_lookup(ids: DataFrame, doc_static: DataFrame) -> DataFrame:
    """(_id, status, timeliness_type, expire_time) of the requested ids.

    Both fields must exist, otherwise the lookup failed and both are empty.
    """
    known = doc_static.where(
        F.col("timeliness_type").isNotNull() & F.col("expire_time").isNotNull()
    ).select("_id", "timeliness_type", "expire_time")
    found = F.col("timeliness_type").isNotNull()
    return ids.select("_id").join(known, "_id", "left").select(
        "_id",
        F.when(found, "success").otherwise("failed").alias("status"),
        F.coalesce("timeliness_type", F.lit("")).alias("timeliness_type"),
        F.coalesce("expire_time", F.lit("")).alias("expire_time"),
    )
