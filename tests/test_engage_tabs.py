import json
from datetime import date

import pytest

from feedloom.plans import engage, tabs
from feedloom.sources import schemas

AS_OF = date(2024, 1, 31)


@pytest.fixture
def static(spark):
    def build(*rows):
        data = [
            (
                row["_id"],
                tuple(row.get(level) for level in engage.CATEGORY_LEVELS),
                row.get("epoch"),
                None,
                None,
                None,
            )
            for row in rows
        ]
        return spark.createDataFrame(data, schemas.DOC_STATIC)

    return build


def test_local_counters_default_to_zero(impressions, rows_of):
    facts = impressions(
        {"doc_id": "a", "doc_comment_cnt": 3, "doc_thumb_up_cnt": None},
        {"doc_id": "a", "doc_comment_cnt": 7, "doc_thumb_up_cnt": None, "pdate": AS_OF},
        {"doc_id": "late", "pdate": date(2024, 2, 1)},
        {"doc_id": "early", "pdate": date(2024, 1, 28)},
        {"doc_id": "inner", "nr_condition": "x_local"},
        {"doc_id": "null", "nr_condition": None},
        {"doc_id": "unjoined", "joined": 0},
        {"doc_id": "unchecked", "checked": 0, "doc_comment_cnt": None, "channel_name": "foryou"},
    )
    assert rows_of(engage.local_engagement(facts, AS_OF)) == [("a", 7.0, 0.0), ("unchecked", 0.0, 0.0)]


def test_nonlocal_drops_null_conditions_and_unseen_likes(impressions, rows_of):
    base = {"channel_name": "foryou", "nr_condition": "global", "doc_thumb_up_cnt": 1}
    facts = impressions(
        {**base, "doc_id": "kept", "doc_comment_cnt": 11},
        {**base, "doc_id": "ten", "doc_comment_cnt": 10},
        {**base, "doc_id": "no_likes", "doc_comment_cnt": 50, "doc_thumb_up_cnt": None},
        {**base, "doc_id": "no_comments", "doc_comment_cnt": None},
        {**base, "doc_id": "null", "doc_comment_cnt": 50, "nr_condition": None},
        {**base, "doc_id": "local", "doc_comment_cnt": 50, "nr_condition": "local_x"},
        {**base, "doc_id": "other", "doc_comment_cnt": 50, "channel_name": "local"},
    )
    assert rows_of(engage.nonlocal_engagement(facts, AS_OF)) == [("kept", 11.0, 1.0)]


def test_a_name_at_two_levels_lists_the_document_twice(impressions, static, rows_of):
    facts = impressions(
        {"doc_id": "a", "doc_comment_cnt": 5, "doc_thumb_up_cnt": 1},
        {"doc_id": "b", "doc_comment_cnt": 5, "doc_thumb_up_cnt": 2},
        {"doc_id": "unknown", "doc_comment_cnt": 9},
    )
    docs = static(
        {"_id": "a", "first_cat": {"x": 1.0}, "second_cat": {"x": 1.0, "y": 1.0}},
        {"_id": "b", "third_cat": {"x": 1.0}},
        {"_id": "none"},
    )
    rows = engage.local_engagement(facts, AS_OF)
    by_comments = engage.top_engaged(rows, docs, "cmts", 2)
    assert rows_of(by_comments, "category", "rk", "doc_id") == [("x", 1, "a"), ("x", 2, "a"), ("y", 1, "a")]
    by_likes = engage.top_engaged(rows, docs, "likes", 2)
    assert rows_of(by_likes, "category", "rk", "doc_id") == [("x", 1, "b"), ("x", 2, "a"), ("y", 1, "a")]
    hashes = {r["field"]: r for r in engage.engagement_hash(by_likes, "localTopLikes").collect()}
    assert json.loads(hashes["x#0/1"]["value"]) == [
        {"docId": "b", "likes": 2.0, "cmts": 5.0},
        {"docId": "a", "likes": 1.0, "cmts": 5.0},
    ]
    assert hashes["y#0/1"]["ttl_sec"] == 15552000
    with pytest.raises(ValueError):
        engage.top_engaged(rows, docs, "views", 2)


def test_unmapped_tabs_are_kept(impressions, rows_of):
    new = {"channel_name": "channelnew"}
    facts = impressions(
        {**new, "clicked": 1}, {**new}, {**new, "channel_id": "k0"}, {**new, "checked": 0}, {"channel_id": "k122524"}
    )
    assert rows_of(tabs.tab_doc_ctr(facts, AS_OF)) == [
        ("crime", "d1", "k122516", 0.5, 2, 1),
        (None, "d1", "k0", 0.0, 1, 0),
    ]


@pytest.fixture
def tab_rows(spark):
    schema = "tab string, doc_id string, channel_id string, ctr double, checks bigint, clicks bigint"

    def build(*rows):
        return spark.createDataFrame([("t", doc, tab, 0.1, checks, 1) for doc, tab, checks in rows], schema)

    return build


def test_smoothing_uses_the_one_day_clicks_twice(spark, tab_rows, rows_of):
    profile = spark.createDataFrame(
        [
            ("a", {"k1": (10, 4)}, {"k1": (20, 12)}),
            ("b", {"other": (10, 4)}, None),
        ],
        schemas.DOC_PROFILE,
    )
    docs = tab_rows(("a", "k1", 100), ("b", "k1", 100), ("missing", "k1", 100))
    rows = rows_of(tabs.tab_smoothed_ctr(docs, profile), "doc_id", "acc_click", "acc_check", "acc_ctr")
    assert rows == [("a", 7.0, 50.0, 0.14), ("b", 1.0, 30.0, 1 / 30), ("missing", 1.0, 30.0, 1 / 30)]
    other = rows_of(tabs.tab_smoothed_ctr(docs, profile, use_2d_click=True), "doc_id", "acc_click")
    assert other[0] == ("a", 11.0)


def test_low_volume_documents_go_behind(spark, tab_rows):
    from pyspark.sql import functions as F

    smoothed = tab_rows(("a", "k1", 59), ("b", "k1", 60), ("c", "k1", 61), ("d", "k1", 5), ("z", "k2", 1)).withColumns(
        {
            "acc_click": F.lit(1.0),
            "acc_check": F.lit(30.0),
            "acc_ctr": F.when(F.col("doc_id").isin("a", "d"), 0.9).otherwise(0.1),
        }
    )
    ranked = tabs.hot_tab_docs(smoothed)
    order = [(r["channel_id"], r["doc_id"]) for r in ranked.orderBy("channel_id", "rk").collect()]
    assert order == [("k1", "b"), ("k1", "c"), ("k1", "a"), ("k1", "d"), ("k2", "z")]
    row = tabs.hot_tab_hash(ranked).where("field = 'k2#0/1'").first()
    assert json.loads(row["value"]) == [{"docId": "z", "tabId": "k2", "ctr": 0.1, "click": 1.0, "check": 30.0}]


def test_freshness_by_tab(static, tab_rows, rows_of):
    now, day = 100 * 86400, 86400
    docs = static(
        {"_id": "week", "epoch": now - 7 * day},
        {"_id": "older", "epoch": now - 7 * day - 1},
        {"_id": "two", "epoch": now - 2 * day},
        {"_id": "none"},
    )
    rows = tab_rows(
        ("week", "k1", 1), ("older", "k1", 1), ("two", "k122521", 1), ("week", "k122525", 1), ("none", "k1", 1), ("absent", "k1", 1)
    )
    fresh = tabs.fresh_docs(rows, docs, now)
    assert rows_of(fresh, "doc_id", "channel_id", "age_days") == [("two", "k122521", 2.0), ("week", "k1", 7.0)]


def test_metrics_and_points(impressions, rows_of):
    new = {"channel_name": "channelnew"}
    facts = impressions(
        {**new, "user_id": 1, "clicked": 1, "shared": 1, "thumbed_up": 1},
        {**new, "user_id": 2},
        {**new, "user_id": 3, "os": "android"},
        {**new, "user_id": 3, "os": None, "clicked": 1},
        {**new, "user_id": 4, "channel_id": "k0", "clicked": 1},
        {"channel_name": "channel", "channel_id": "k26164", "clicked": 1},
        {"channel_name": "channel"},
    )
    day = date(2024, 1, 30)
    per_tab = tabs.tab_metrics(facts, day, day)
    assert rows_of(per_tab, "tab", "os", "dau", "clicks", "checks", "ctr", "str1") == [
        ("crime", "android", 1, 0, 1, 0.0, None),
        ("crime", "ios", 2, 1, 2, 0.5, 1.0),
        ("crime", None, 1, 1, 1, 1.0, 0.0),
        ("headline", "ios", 1, 1, 1, 1.0, 0.0),
    ]
    totals = tabs.tab_metrics_total(facts, day, day)
    assert rows_of(totals, "tab", "os", "dau", "clicks", "checks") == [
        ("tot", "android", 1, 0, 1),
        ("tot", "ios", 3, 2, 3),
        ("tot", None, 1, 1, 1),
    ]
    points = tabs.tab_metric_points(per_tab.unionByName(totals), "h").collect()
    # No os, or a NULL ratio: the whole row stays unpublished.
    assert {p["metric"].split(".", 2)[2] for p in points} == {"ios.crime", "ios.headline", "ios.tot"}
    assert len(points) == 3 * len(tabs.TAB_METRICS)
    values = {p["metric"]: (p["ts"], p["value"], p["tags"]) for p in points}
    assert values["tabmetric.up_pu.ios.crime"] == (1706572800, 0.5, {"host": "h"})
    assert tabs.tab_metrics(facts, AS_OF, AS_OF).count() == 0


def test_clicks_that_were_never_recorded_leave_no_row(impressions, rows_of):
    new = {"channel_name": "channelnew"}
    facts = impressions(
        {"doc_id": "a", "clicked": None, **new}, {"doc_id": "a", "clicked": None, **new},
        {"doc_id": "b", "clicked": None, **new}, {"doc_id": "b", "clicked": 1, **new},
    )
    assert rows_of(tabs.tab_doc_ctr(facts, AS_OF), "doc_id", "ctr", "checks", "clicks") == [("b", 0.5, 2, 1)]


def test_all_lists_in_one_pass_equal_the_single_ones(impressions, static, rows_of):
    facts = impressions(
        {"doc_id": "a", "doc_comment_cnt": 50, "doc_thumb_up_cnt": 1},
        {"doc_id": "b", "doc_comment_cnt": None, "doc_thumb_up_cnt": None},
        {"doc_id": "a", "nr_condition": "global", "channel_name": "foryou", "doc_comment_cnt": 11, "doc_thumb_up_cnt": 2},
        {"doc_id": "b", "nr_condition": "global", "channel_name": "foryou", "doc_comment_cnt": 12, "doc_thumb_up_cnt": None},
        {"doc_id": "c", "nr_condition": "global", "channel_name": "foryou", "doc_comment_cnt": 10, "doc_thumb_up_cnt": 7},
        {"doc_id": "c", "nr_condition": "global", "doc_comment_cnt": 99, "doc_thumb_up_cnt": 99},
        {"doc_id": "d", "nr_condition": None, "channel_name": "foryou", "doc_comment_cnt": 99, "doc_thumb_up_cnt": 99},
    )
    docs = static(*[{"_id": d, "first_cat": {"x": 1.0}} for d in "abcd"])
    listed = engage.engagement_lists(facts, docs, AS_OF)
    for (scope, by), name in engage.HASH_NAMES.items():
        if scope == "local":
            single = engage.top_engaged(engage.local_engagement(facts, AS_OF), docs, by, engage.LOCAL_LIST_SIZE)
        else:
            single = engage.top_engaged(engage.nonlocal_engagement(facts, AS_OF), docs, by, engage.NONLOCAL_LIST_SIZE)
        columns = ("category", "rk", "doc_id", "cmts", "likes")
        assert rows_of(listed.where(listed.list_name == name), *columns) == rows_of(single, *columns) != []
