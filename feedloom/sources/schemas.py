"""Schemas of the feed tables."""

from __future__ import annotations

INTERACTIONS = (
    "user_id bigint, doc_id string, nr_zip string, pdate date, ts bigint, "
    "channel_name string, channel_id string, nr_condition string, "
    "joined int, checked int, clicked int, shared int, thumbed_up int, "
    "cv_time bigint, os string, doc_comment_cnt bigint, doc_thumb_up_cnt bigint"
)
DOC_DIM = (
    "doc_id string, pdate date, publish_time timestamp_ntz, channels array<string>, "
    "geotag array<struct<type:string,pid:string>>, "
    "text_category struct<first_cat:map<string,double>,second_cat:map<string,double>>"
)
ZIP_GEO = "id string, city_id string, pdate date"
DOC_STATIC = (
    "_id string, text_category_v2 struct<first_cat:map<string,double>,"
    "second_cat:map<string,double>,third_cat:map<string,double>>, "
    "epoch bigint, url string, timeliness_type string, expire_time string"
)
DOC_STATIC_DAILY = (
    "doc_id string, publish_time timestamp_ntz, timeliness_type string, "
    "is_news_score double, pdate date"
)
DOC_PROFILE = (
    "doc_id string, tab_cfb_1d map<string,struct<view:bigint,click:bigint>>, "
    "tab_cfb_2d map<string,struct<view:bigint,click:bigint>>"
)
FEED_DUMP = "line_no bigint, day date, uid string, zip string, arm string, body string"
DOC_META_JSON = "docid string, body string"
CRAWL_ROWS = (
    "line_no bigint, day date, arm string, width int, uid string, docid string, pos string, "
    "is_local string, condition string, url string, domain string, title string, "
    "pub_time string, run_date string"
)
REVIEWS = "_id string, review struct<status:string,reason:string,editor:string>"
DISPLAY_DOC = (
    "_id string, mp_full_article boolean, date string, title string, url string, "
    "image_urls array<string>, content string"
)
WRITTEN_LEDGER = "docid string, source string"
TIMELINESS_UPDATES = "line_no bigint, fields array<string>, width int"
SEARCH_INDEX = "docid string, timeliness_type string"

# Inputs that may come as JSON lines.
JSON = {"feed_dump": FEED_DUMP, "doc_meta_json": DOC_META_JSON, "reviews": REVIEWS, "display_doc": DISPLAY_DOC}
