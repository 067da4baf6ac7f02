"""Feed dumps and document metadata, parsed from JSON into crawl rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import null_text, starts_local
from feedloom.operators.ranking import spread_rank
from feedloom.staging import stage

# Fields are read as text, so that a document may give its position in any form.
FEED_BODY = "documents array<struct<docid:string,pos:string,contextMeta:struct<condition:string>>>"
# The same with its keys, for dumps in which a field is null or no object: tells null from absent.
FEED_KEYS = "documents array<map<string,string>>"
FEED_FIELDS = ("docid", "pos", "contextMeta")
META_BODY = (
    "data map<string,struct<static_feature:"
    "struct<url:string,domain:string,stitle:string,date:string>>>, _corrupt string"
)
# Fields that stand in for metadata that could not be fetched.
STUB_DOMAIN = "nullTitle"
STUB_TITLE = "nullPubTime"
CRAWL_WIDTH = 10
STUB_WIDTH = 8
ITEM_WIDTH = 5


def feed_items(dumps: DataFrame, include_local: bool = False) -> DataFrame:
    """One row per document of a feed dump, in dump order (dump_no, item_no).

    A dump that does not parse, or that has a document without id, position or
    context, gives no rows. Positions are taken as they are written, a null one
    as ``None``. Local items are left out unless asked for.
    """
    run = [c for c in ("day",) if c in dumps.columns]
    # inline() evaluates what it is given once, however often its fields are used below.
    parsed_body = F.inline(F.array(F.from_json("body", FEED_BODY)))
    odd = F.col("documents").isNull() | F.exists(
        "documents", lambda d: d["docid"].isNull() | d["pos"].isNull() | d["contextMeta"].isNull()
    )

    def item(docid: Column, pos: Column, condition: Column) -> Column:
        return F.struct(docid.alias("docid"), pos.alias("pos"), condition.alias("condition"))

    found = F.transform("documents", lambda d: item(d["docid"], d["pos"], d["contextMeta"]["condition"]))
    whole = F.inline(F.array(F.struct(F.when(odd, _odd_items(item)).otherwise(found).alias("items"))))
    items = (
        dumps.select(*run, F.col("line_no").alias("dump_no"), "uid", "arm", "body", parsed_body)
        .select(*run, "dump_no", "uid", "arm", whole)
        .select(*run, "dump_no", "uid", "arm", F.posexplode("items").alias("item_no", "d"))
    )
    condition = F.col("d")["condition"]
    parsed = items.select(
        *run,
        "dump_no",
        "item_no",
        "uid",
        "arm",
        F.col("d")["docid"].alias("docid"),
        null_text(F.col("d")["pos"], "None").alias("pos"),
        F.coalesce(starts_local(condition), F.lit(False)).alias("is_local"),
        null_text(condition).alias("condition"),
    )
    return parsed if include_local else parsed.where(~F.col("is_local"))


def _odd_items(item: Callable[[Column, Column, Column], Column]) -> Column:
    """Items of a body whose fields are not all there; null if the dump is to be skipped."""
    documents = F.from_json("body", FEED_KEYS)["documents"]
    incomplete = F.exists(
        documents,
        lambda d: F.exists(F.array(*[F.lit(f) for f in FEED_FIELDS]), lambda f: ~F.map_contains_key(d, f))
        | d["docid"].isNull()
        | d["contextMeta"].isNull(),
    )
    condition = lambda d: F.get_json_object(d["contextMeta"], "$.condition")
    return F.when(~incomplete, F.transform(documents, lambda d: item(d["docid"], d["pos"], condition(d))))


def doc_metadata(bodies: DataFrame, run_date: str) -> DataFrame:
    """(docid, meta_status, url, domain, title, pub_time, run_date).

    ``ok``: parsed. ``null``: no single record with features, five text nulls.
    ``broken``: the body does not parse or lacks one of the four features.
    """
    parsed = F.from_json(F.coalesce("body", F.lit("{")), META_BODY, {"columnNameOfCorruptRecord": "_corrupt"})
    record = F.map_values("data")[0]["static_feature"]
    names = ("url", "domain", "stitle", "date")
    # An absent body is read as text that does not parse.
    rows = bodies.select("docid", F.inline(F.array(parsed))).select(
        "docid", "_corrupt", F.when(F.size("data") == 1, record).alias("feature")
    )
    any_missing = F.lit(False)
    for name in names:
        any_missing = any_missing | F.col(f"feature.{name}").isNull()
    status = (
        F.when(F.col("_corrupt").isNotNull(), "broken")
        .when(F.col("feature").isNull(), "null")
        .when(any_missing, "broken")
        .otherwise("ok")
    )

    def field(value: Column) -> Column:
        return F.when(F.col("meta_status") == "ok", value).when(
            F.col("meta_status") == "null", F.lit("null")
        )

    return rows.withColumn("meta_status", status).select(
        "docid",
        "meta_status",
        field(F.col("feature.url")).alias("url"),
        field(F.col("feature.domain")).alias("domain"),
        field(F.translate("feature.stitle", "\t", " ")).alias("title"),
        field(F.col("feature.date")).alias("pub_time"),
        field(F.lit(run_date)).alias("run_date"),
    )


def crawl_rows(items: DataFrame, metadata: DataFrame) -> DataFrame:
    """The rows of each crawl file: items with their metadata, numbered.

    A file is a (day, arm); its rows have a ``line_no`` from 1, in order of dump
    and item, counted slice by slice so that no task holds a whole file (the
    items are written while the plan is built, and numbered before the metadata
    makes them wide). ``width`` is the number of
    fields the row has as text: 10 when complete, 8 when the metadata is missing
    and a stub takes its place, 5 when broken.
    """
    # Numbering reads its rows more than once: they are written first, still narrow.
    order = [F.col("dump_no"), F.col("item_no")]
    numbered = spread_rank(stage(items, "feed-items"), ["day", "arm"], order, "line_no", label="crawl-rows")
    joined = numbered.join(metadata, "docid", "left")
    missing = F.col("meta_status").isNull()
    width = (
        F.when(missing, STUB_WIDTH)
        .when(F.col("meta_status") == "broken", ITEM_WIDTH)
        .otherwise(CRAWL_WIDTH)
    )
    return joined.select(
        "day",
        "arm",
        "line_no",
        width.alias("width"),
        "uid",
        "docid",
        "pos",
        F.when(F.col("is_local"), "True").otherwise("False").alias("is_local"),
        "condition",
        F.when(missing, F.col("docid")).otherwise(F.col("url")).alias("url"),
        F.when(missing, STUB_DOMAIN).otherwise(F.col("domain")).alias("domain"),
        F.when(missing, STUB_TITLE).otherwise(F.col("title")).alias("title"),
        "pub_time",
        "run_date",
    )


# The fields of a crawl row as text, in order.
CRAWL_FIELDS = (
    "uid", "docid", "pos", "is_local", "condition", "url", "domain", "title", "pub_time", "run_date",
)


def crawl_lines(lines: DataFrame) -> DataFrame:
    """Crawl rows from lines of text (``fields``, ``width`` beside day, arm and line_no)."""
    named = [F.get(F.col("fields"), F.lit(k)).alias(name) for k, name in enumerate(CRAWL_FIELDS)]
    return lines.select("day", "arm", "line_no", "width", *named)


def assess_dedupe(rows: DataFrame, max_docs: int) -> DataFrame:
    """First row of each document, in line order, up to ``max_docs`` + 1 documents."""
    columns = [c for c in rows.columns if c not in ("docid", "line_no")]
    firsts = (
        rows.where(F.col("width") >= 2)
        .groupBy("docid")
        .agg(
            F.min("line_no").alias("line_no"),
            F.min_by(F.struct(*columns), F.col("line_no")).alias("row"),
        )
    )
    return firsts.orderBy("line_no").limit(max_docs + 1).select("line_no", "docid", "row.*")
