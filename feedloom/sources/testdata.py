"""The feed tables as deterministic projections of the generated test tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.plans.tabs import METRIC_TAB_NAMES
from feedloom.sources.files import ragged_fields

AS_OF = date(2024, 1, 31)
AS_OF_TIME = datetime(2024, 1, 31)
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2024, 1, 30)
# The generated events span 30 days: windows of 30 days read the whole table.
ALL_DAYS = 30
CHANNEL_NAMES = ("foryou", "local", "channelnew", "channel")
TAB_IDS = (*METRIC_TAB_NAMES, "k999001", "k999002")
REASONS = ("reason_a", "reason_b", "reason_c")
CONTENT_HOST = "http://old-images.example.com"
TITLE_PATTERN = "<title>([^<]*)</title>"


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass
class FeedTables:
    """Lazily built feed tables over one test data folder."""

    spark: SparkSession
    folder: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        events = self._read("events")
        i = F.col("event_id")
        condition = (
            F.when(i % 10 < 5, "local_pop").when(i % 10 < 7, "evergreen").when(i % 10 < 9, "global")
        )
        return events.select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.col("ts").cast("timestamp_ntz").alias("event_time"),
            F.to_date(F.col("ts").cast("timestamp_ntz")).alias("day"),
            F.get_json_object("props", "$.k").alias("doc_id"),
            condition.alias("nr_condition"),
        )

    @cached_property
    def interactions(self) -> DataFrame:
        i, value, kind = F.col("event_id"), F.col("value"), F.col("event_type")
        zips = self._read("customer").select(
            F.col("c_custkey").alias("user_id"), _text("c_nationkey").alias("nr_zip")
        )
        no_error = (kind != "error").cast("int")
        seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', event_time)")
        no_likes = (i % 13 == 0) | (F.col("doc_id").cast("int") % 10 == 3)
        # Clicks of some documents in the new tabs were never recorded.
        unrecorded = (i % 4 == 2) & (F.col("doc_id").cast("int") % 25 == 12)
        return self._events.join(zips, "user_id").select(
            "user_id",
            "doc_id",
            "nr_zip",
            F.col("day").alias("pdate"),
            seconds.alias("ts"),
            _pick(CHANNEL_NAMES, i % 4).alias("channel_name"),
            _pick(TAB_IDS, i % 25).alias("channel_id"),
            "nr_condition",
            no_error.alias("joined"),
            no_error.alias("checked"),
            F.when(~unrecorded, kind.isin("click", "purchase").cast("int")).alias("clicked"),
            (kind == "purchase").cast("int").alias("shared"),
            (kind == "signup").cast("int").alias("thumbed_up"),
            F.floor(value * 100).alias("cv_time"),
            F.when(F.col("user_id") % 50 != 49, F.when(F.col("user_id") % 2 == 0, "ios").otherwise("android")).alias("os"),
            F.when(i % 11 != 0, F.floor(value)).alias("doc_comment_cnt"),
            F.when(~no_likes, F.floor(value / 2)).alias("doc_thumb_up_cnt"),
        )

    @cached_property
    def zip_geo(self) -> DataFrame:
        return self._read("nation").select(
            _text("n_nationkey").alias("id"),
            _text("n_regionkey").alias("city_id"),
            F.date_sub(F.lit(AS_OF), 2).alias("pdate"),
        )

    @cached_property
    def _documents(self) -> DataFrame:
        hours = F.make_dt_interval(hours=(F.col("doc_id") % 48).cast("int"))
        return self._read("documents").withColumn("publish_time", _ntz(AS_OF_TIME) - hours)

    @cached_property
    def doc_dim(self) -> DataFrame:
        """Every sixth document has an older snapshot; some have no geotags, or a NULL of them."""
        d = F.col("doc_id")

        def tag(kind: Column, prefix: str, pid: Column) -> Column:
            return F.struct(kind.alias("type"), F.concat(F.lit(prefix), pid).alias("pid"))

        wide = F.when(d % 3 == 0, "state").otherwise("county")
        tab = F.when(d % 97 == 13, "\t").otherwise("")
        city_pid = F.when(d % 23 != 7, F.concat(((d + F.col("back")) % 5).cast("string"), tab))
        tags = F.array(tag(F.lit("city"), "p", city_pid), tag(wide, "q", (d % 7).cast("string")))
        geotag = F.when(d % 17 == 9, F.array_except(tags, tags)).when(d % 17 != 2, tags)
        snapshots = F.when(d % 6 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        channels = F.when(d % 29 == 3, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
        return self._documents.withColumn("back", F.explode(snapshots)).select(
            _text("doc_id").alias("doc_id"),
            F.date_sub(F.to_date("publish_time"), F.col("back")).alias("pdate"),
            "publish_time",
            channels.alias("channels"),
            geotag.alias("geotag"),
            F.struct(
                F.create_map("lang", F.lit(1.0)).alias("first_cat"),
                F.create_map("source", F.lit(0.5)).alias("second_cat"),
            ).alias("text_category"),
        )

    @cached_property
    def _page_urls(self) -> DataFrame:
        return self._read("pages").select(F.col("page_id").alias("doc_id"), "url")

    @cached_property
    def _timeliness(self) -> Column:
        d = F.col("doc_id")
        return F.when(d % 4 == 0, "current").when(d % 4 == 1, "evergreen").when(d % 4 == 2, "short")

    @cached_property
    def doc_static(self) -> DataFrame:
        d = F.col("doc_id")
        length = F.concat(F.lit("len"), (F.col("n_chars") % 4).cast("string"))
        epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', publish_time)")
        return self._documents.join(self._page_urls, "doc_id", "left").select(
            _text("doc_id").alias("_id"),
            F.struct(
                F.create_map("lang", F.lit(1.0)).alias("first_cat"),
                F.create_map("source", F.lit(0.5)).alias("second_cat"),
                # Some documents carry the name of an upper level again.
                F.create_map(F.when(d % 10 == 1, F.col("lang")).otherwise(length), F.lit(0.1)).alias("third_cat"),
            ).alias("text_category_v2"),
            F.when(d % 31 != 4, epoch).alias("epoch"),
            "url",
            self._timeliness.alias("timeliness_type"),
            F.when(d % 6 != 5, F.concat(F.lit("2024-0"), (d % 9 + 1).cast("string"), F.lit("-01"))).alias("expire_time"),
        )

    @cached_property
    def doc_static_daily(self) -> DataFrame:
        return self._documents.select(
            _text("doc_id").alias("doc_id"),
            "publish_time",
            self._timeliness.alias("timeliness_type"),
            ((F.col("doc_id") % 10) / F.lit(10.0)).alias("is_news_score"),
            F.lit(AS_OF).alias("pdate"),
        )

    @cached_property
    def doc_profile(self) -> DataFrame:
        """Views and clicks per document and tab over the last one and two days."""

        def cell(days: int) -> list[Column]:
            recent = F.col("pdate") >= F.date_sub(F.lit(AS_OF), days)
            return [
                F.sum(F.when(recent, F.col("checked"))).alias(f"view_{days}"),
                F.sum(F.when(recent, F.col("clicked"))).alias(f"click_{days}"),
            ]

        def profile(days: int) -> Column:
            entry = F.struct(
                F.col("channel_id"),
                F.struct(F.col(f"view_{days}").alias("view"), F.col(f"click_{days}").alias("click")),
            )
            # At most one entry per tab id.
            return F.map_from_entries(F.collect_list(F.when(F.col(f"view_{days}").isNotNull(), entry)))

        cells = (
            self.interactions.where(F.col("pdate") >= F.date_sub(F.lit(AS_OF), 2))
            .groupBy("doc_id", "channel_id")
            .agg(*cell(1), *cell(2))
        )
        return cells.groupBy("doc_id").agg(
            profile(1).alias("tab_cfb_1d"), profile(2).alias("tab_cfb_2d")
        )

    @cached_property
    def reviews(self) -> DataFrame:
        d = F.col("doc_id")
        status = F.when(F.col("toxic") == 1, "detrimental").when(F.col("quality") == 1, "ok").otherwise("poor")
        reason = F.when(d % 9 == 4, "").when(d % 5 != 2, _pick(REASONS, d % 3))
        review = F.struct(
            F.when(d % 17 != 0, status).alias("status"),
            reason.alias("reason"),
            F.when(d % 5 != 4, F.concat(F.lit("editor"), (d % 5).cast("string"))).alias("editor"),
        )
        suffix = F.when(d % 19 == 3, "").otherwise("_from_foryou")
        return self._read("labels").select(
            F.concat(_text("doc_id"), suffix).alias("_id"),
            F.when(d % 37 != 5, review).alias("review"),
        )

    @cached_property
    def crawl_rows(self) -> DataFrame:
        """One line per event; some lines are stubs of 8 fields, some have only one."""
        i = F.col("event_id")
        width = F.when(i % 58 == 0, 1).when(i % 29 == 0, 8).otherwise(10)
        local = F.coalesce(F.col("nr_condition").startswith("local"), F.lit(False))
        return self._events.select(
            i.alias("line_no"),
            "day",
            F.when(i % 2 == 0, "online").otherwise("exp").alias("arm"),
            width.alias("width"),
            _text("user_id").alias("uid"),
            F.when(width > 1, F.col("doc_id")).alias("docid"),
            (i % 25).cast("string").alias("pos"),
            F.when(local, "True").otherwise("False").alias("is_local"),
            F.coalesce("nr_condition", F.lit("null")).alias("condition"),
            F.concat(F.lit("https://example.com/"), "doc_id").alias("url"),
            F.lit("example.com").alias("domain"),
            F.concat(F.lit("title "), "doc_id").alias("title"),
            F.date_format("day", "yyyy-MM-dd").alias("pub_time"),
            F.lit(AS_OF.isoformat()).alias("run_date"),
        )

    @cached_property
    def feed_dump(self) -> DataFrame:
        """One dump per event with three documents.

        Every 41st body is cut off; some have a position as text, a fractional or
        a null one, or none at all.
        """
        i = F.col("event_id")

        def document(step: int) -> Column:
            docid = ((F.col("doc_id").cast("int") + step) % 100).cast("string")
            meta = (
                F.when(i % 10 == 9, F.lit("{}"))
                .when(
                    (i + step) % 3 == 0,
                    F.concat(F.lit('{"condition":"'), F.col("nr_condition"), F.lit('"}')),
                )
                .otherwise(F.lit('{"condition":"trending"}'))
            )
            pos = (
                F.when(i % 37 == 5, f'"pos":"{step}",')
                .when(i % 37 == 6, f'"pos":{step}.5,')
                .when(i % 37 == 7, '"pos":null,')
                .when(i % 43 == 9, "")
                .otherwise(f'"pos":{step},')
            )
            return F.concat(
                F.lit('{"docid":"'), docid, F.lit('",'), pos, F.lit('"contextMeta":'), meta, F.lit("}")
            )

        body = F.concat(
            F.lit('{"documents":['), F.concat_ws(",", document(0), document(1), document(2)), F.lit("]}")
        )
        return self._events.select(
            i.alias("line_no"),
            "day",
            _text("user_id").alias("uid"),
            F.lit("").alias("zip"),
            F.when(i % 2 == 0, "online").otherwise("exp").alias("arm"),
            F.when(i % 41 == 0, '{"documents":[').otherwise(body).alias("body"),
        )

    @cached_property
    def doc_meta_json(self) -> DataFrame:
        """Metadata bodies from pages; some lack features, a field, or name two ids."""
        p = F.col("page_id")
        title = F.concat(F.regexp_extract("html", TITLE_PATTERN, 1), F.lit("\t"), _text("page_id"))
        feature = F.struct(
            "url",
            F.when(p % 17 != 3, F.element_at(F.split("url", "/"), 3)).alias("domain"),
            title.alias("stitle"),
            F.lit("2024-01-30 00:00:00").alias("date"),
        )
        record = F.struct(F.when(p % 13 != 5, feature).alias("static_feature"))
        one = F.create_map(_text("page_id"), record)
        two = F.create_map(_text("page_id"), record, F.lit("other"), record)
        data = F.struct(F.when(p % 19 == 7, two).otherwise(one).alias("data"))
        body = F.when(p % 43 == 11, "{").otherwise(F.to_json(data))
        return self._read("pages").select(_text("page_id").alias("docid"), body.alias("body"))

    @cached_property
    def display_doc(self) -> DataFrame:
        d = F.col("doc_id")
        images = F.array(
            F.concat(F.lit("http://img.example.com/"), _text("doc_id"), F.lit("/1.jpg")),
            F.concat(F.lit("http://img.example.com/"), _text("doc_id"), F.lit("/2.jpg")),
        )
        content = F.concat(F.lit(CONTENT_HOST + "/a.png "), F.col("text"))
        return self._documents.join(self._page_urls, "doc_id", "left").select(
            _text("doc_id").alias("_id"),
            F.when(d % 5 != 0, d % 5 == 1).alias("mp_full_article"),
            F.when(d % 7 != 0, F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss")).alias("date"),
            F.when(d % 6 != 0, F.concat(F.lit("title "), _text("doc_id"))).alias("title"),
            "url",
            F.when(d % 4 != 0, images).alias("image_urls"),
            F.when(d % 9 != 0, content).alias("content"),
        )

    @cached_property
    def written_ledger(self) -> DataFrame:
        return self._read("documents").where(F.col("doc_id") % 7 == 0).select(
            _text("doc_id").alias("docid"), F.lit("from=earlier").alias("source")
        )

    @cached_property
    def timeliness_updates(self) -> DataFrame:
        """Lines of two fields, two per document: the second one must win.

        Some documents have a later line of one field, or of three: no updates.
        """
        d = F.col("doc_id")
        docid = _text("doc_id")
        last = F.when(d % 4 == 0, "evergreen").otherwise("current")
        bad = F.when(d % 11 == 3, docid).when(d % 11 == 4, F.concat_ws("\x01", docid, F.lit("short"), F.lit("x")))
        lines = [
            F.concat_ws("\x01", docid, F.lit("short ")),
            F.concat_ws("\x01", docid, last),
            bad,
        ]
        numbered = [F.struct((d * 3 + k).alias("line_no"), line.alias("line")) for k, line in enumerate(lines)]
        return (
            self._read("documents")
            .select(F.inline(F.array(*numbered)))
            .where(F.col("line").isNotNull())
            .select("line_no", ragged_fields(F.col("line"), "\x01").alias("fields"))
            .withColumn("width", F.size("fields"))
        )

    @cached_property
    def lookup_ids(self) -> DataFrame:
        """Every document, and some ids that no document has."""
        ids = [_text("doc_id"), F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("gone"), _text("doc_id")))]
        return (
            self._read("documents").select(F.explode(F.array(*ids)).alias("_id")).where(F.col("_id").isNotNull())
        )

    @cached_property
    def search_index(self) -> DataFrame:
        return self._read("documents").where(F.col("doc_id") % 3 != 0).select(
            _text("doc_id").alias("docid"), F.lit("old").alias("timeliness_type")
        )


def load(spark: SparkSession, folder: str) -> FeedTables:
    return FeedTables(spark, folder)
