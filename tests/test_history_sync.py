import json
from datetime import date, datetime

import pytest

from feedloom.plans import history, sync
from feedloom.sources import schemas

DAY = date(2024, 1, 30)
WINDOW = dict(
    first_day=date(2024, 1, 1), last_day=DAY, first_publish=date(2023, 8, 1), last_publish=date(2024, 1, 31), snapshot=DAY
)


@pytest.fixture
def static_daily(spark):
    def build(*rows):
        data = [(d, p, kind, score, day) for d, p, kind, score, day in rows]
        return spark.createDataFrame(data, schemas.DOC_STATIC_DAILY)

    return build


def test_which_impressions_count(impressions, static_daily, rows_of):
    published = datetime(2024, 1, 31, 23, 59)
    docs = static_daily(
        ("long", published, "evergreen", 0.9, DAY),
        ("nonnews", published, None, 0.4, DAY),
        ("half", published, "short", 0.5, DAY),
        ("unknown", published, None, None, DAY),
        ("old", datetime(2023, 7, 31, 23), "current", 0.1, DAY),
        ("stale", published, "current", 0.1, date(2024, 1, 29)),
    )
    facts = impressions(
        {"doc_id": "long", "ts": 5},
        {"doc_id": "long", "ts": 5},
        {"doc_id": "long", "ts": 6, "channel_name": "foryou"},
        {"doc_id": "nonnews"},
        {"doc_id": "half"},
        {"doc_id": "half", "ts": 2, "nr_condition": "an_evergreen_one"},
        {"doc_id": "unknown", "nr_condition": None},
        {"doc_id": "unknown", "nr_condition": "evergreen", "ts": 3},
        {"doc_id": "old"},
        {"doc_id": "stale"},
        {"doc_id": "missing", "nr_condition": "evergreen"},
        {"doc_id": "long", "ts": 7, "cv_time": 1999},
        {"doc_id": "long", "ts": 7, "channel_name": "channel"},
        {"doc_id": "long", "ts": 7, "user_id": 0},
        {"doc_id": "long", "ts": 7, "checked": 0},
        {"doc_id": "long", "ts": 7, "joined": 0},
        {"doc_id": "long", "ts": 7, "pdate": date(2023, 12, 31)},
    )
    rows = rows_of(history.user_history(facts, docs, **WINDOW))
    assert rows == [(1, 0, 1, "half|2\tlong|5\tlong|6\tnonnews|1\tunknown|3")]


def test_heavy_readers_come_in_parts_that_add_up(impressions, static_daily):
    docs = static_daily(("long", datetime(2024, 1, 1), "evergreen", 0.9, DAY))
    heavy = [{"doc_id": "long", "ts": i, "user_id": 7} for i in range(500)]
    light = [{"doc_id": "long", "ts": i, "user_id": u} for u in range(10, 60) for i in range(10)]
    facts = impressions(*heavy, *light)
    whole = {r["user_id"]: set(r["doc_items"].split("\t")) for r in history.user_history(facts, docs, **WINDOW).collect()}
    rows = history.user_history(facts, docs, part_size=50, output_partitions=3, **WINDOW).collect()
    seen: dict[int, list[str]] = {}
    for row in rows:
        seen.setdefault(row["user_id"], []).extend(row["doc_items"].split("\t"))
    assert {u: set(items) for u, items in seen.items()} == whole
    assert all(len(items) == len(set(items)) for items in seen.values())
    assert len([r for r in rows if r["user_id"] == 7]) == 10
    assert {r["n_parts"] for r in rows if r["user_id"] == 7} == {10}
    assert {(r["part"], r["n_parts"]) for r in rows if r["user_id"] != 7} == {(0, 1)}
    assert max(len(r["doc_items"].split("\t")) for r in rows) < 100


def _updates(spark, *rows):
    data = [(i, list(fields), len(fields)) for i, fields in enumerate(rows)]
    return spark.createDataFrame(data, schemas.TIMELINESS_UPDATES)


def test_last_update_wins(spark, rows_of):
    updates = _updates(spark, ("a", "old"), (" a\t", "\r new \n"), ("b", "x"), ("c", ""), ("c", "y"), ("c", ""))
    index = spark.createDataFrame([("a", "t0"), ("z", "t0"), ("c", "t0")], schemas.SEARCH_INDEX)
    outcome = sync.index_sync_outcome(updates, index)
    assert rows_of(outcome) == [("a", "new", "succ_update_es"), ("b", "x", "none"), ("c", "", "succ_update_es")]
    assert rows_of(sync.index_sync_counts(outcome)) == [(3, 2, 2)]
    assert rows_of(sync.index_sync_snapshot(updates, index)) == [("a", "new"), ("c", ""), ("z", "t0")]


def test_lines_of_another_width_are_no_updates(spark, rows_of):
    updates = _updates(spark, ("a", "new"), ("a",), ("a", "x", "y"), ("b", "x", "y"), ("c",))
    assert rows_of(sync.latest_updates(updates)) == [("a", "new")]
    assert rows_of(sync.update_line_counts(updates)) == [(5, 4)]


def test_reindex_and_lookup(spark, rows_of):
    outcome = spark.createDataFrame([("a", "x", "none"), ("b", "x", "none"), ("c", "x", "succ_update_es")], "docid string, timeliness string, msg string")
    static = spark.createDataFrame(
        [
            ("a", (None, None, None), None, "http://a", "current", "2024"),
            ("c", (None, None, None), None, "http://c", "current", None),
        ],
        schemas.DOC_STATIC,
    )
    messages = {r["key"]: json.loads(r["value"]) for r in sync.reindex_messages(outcome, static).collect()}
    assert messages == {"a": {"docId": "a", "url": "http://a"}, "b": {"docId": "b", "url": ""}}
    ids = spark.createDataFrame([("a",), ("a",), ("c",), ("x",)], "_id string")
    assert rows_of(sync.timeliness_lookup(ids, static)) == [
        ("a", "success", "current", "2024"),
        ("a", "success", "current", "2024"),
        ("c", "failed", "", ""),
        ("x", "failed", "", ""),
    ]
