import json
from datetime import date

from feedloom.plans import feedparse, sampling
from feedloom.sources import schemas

DAY = date(2024, 1, 30)


def test_users_are_distinct_with_their_zip(impressions, rows_of):
    feed = {"channel_name": "foryou"}
    facts = impressions(
        {**feed}, {**feed}, {**feed, "nr_zip": "z2"}, {**feed, "nr_zip": None}, {"user_id": 9}, {**feed, "user_id": 8, "pdate": date(2024, 1, 1)}
    )
    users = sampling.feed_users(facts, DAY, DAY)
    assert rows_of(users) == [(1, "z1"), (1, "z2"), (1, None)]
    assert sampling.user_sample(users, 2, seed=1).count() == 2
    first = rows_of(sampling.user_sample_hashed(users, 2))
    assert first == rows_of(sampling.user_sample_hashed(users.repartition(7), 2))


def test_arm_grid(spark, rows_of):
    users = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "user_id bigint, nr_zip string")
    grid = sampling.sample_arm_grid(users, ["x", "y"], ["bx", "by"], max_users=2)
    assert rows_of(grid, "user_id", "arm", "bucket") == [
        (u, arm, bucket) for u in (1, 2) for arm, bucket in (("online", ""), ("x", "bx"), ("y", "by"))
    ]
    uneven = sampling.sample_arm_grid(users, ["x", "y"], ["bx"])
    assert rows_of(uneven, "user_id", "arm") == [(1, "online"), (2, "online"), (3, "online")]


def _dump(spark, *bodies):
    rows = [(i, DAY, f"u{i}", "z", "online", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, schemas.FEED_DUMP)


def _doc(docid, pos, **meta):
    return {"docid": docid, "pos": pos, "contextMeta": meta}


def test_feed_items(spark, rows_of):
    dumps = _dump(
        spark,
        {"documents": [_doc("a", 0, condition="local_x"), _doc("b", 1), _doc("c", 2, condition="x_local")], "more": 1},
        '{"documents": [',
        {"documents": [_doc("a", 0), {"docid": "b", "pos": 1}]},
        {"documents": []},
        {"other": 1},
    )
    items = feedparse.feed_items(dumps)
    assert rows_of(items, "uid", "item_no", "docid", "pos", "is_local", "condition") == [
        ("u0", 1, "b", "1", False, "null"),
        ("u0", 2, "c", "2", False, "x_local"),
    ]
    assert rows_of(feedparse.feed_items(dumps, include_local=True), "docid") == [("a",), ("b",), ("c",)]


def test_positions_are_taken_as_written(spark, rows_of):
    dumps = _dump(
        spark,
        {"documents": [_doc("a", "3"), _doc("b", 1.0), _doc("c", None), _doc("d", 2)]},
        {"documents": [_doc("e", 0), {"docid": "f", "contextMeta": {}}]},
        {"documents": [{"docid": None, "pos": 1, "contextMeta": {}}]},
    )
    items = feedparse.feed_items(dumps)
    assert rows_of(items, "docid", "pos") == [("a", "3"), ("b", "1.0"), ("c", "None"), ("d", "2")]


def test_contexts_of_any_form(spark, rows_of):
    odd = [{"docid": i, "pos": 1, "contextMeta": m} for i, m in (("a", "text"), ("b", [1]), ("c", {"condition": 7}), ("d", {"x": 1}))]
    dumps = _dump(spark, *[{"documents": [d, _doc("z", 2, condition="k")]} for d in odd], {"documents": [None]}, {"documents": "x"})
    items = feedparse.feed_items(dumps)
    assert rows_of(items.where("docid <> 'z'"), "docid", "condition") == [("a", "null"), ("b", "null"), ("c", "7"), ("d", "null")]
    assert items.where("docid = 'z' AND condition = 'k' AND item_no = 1").count() == 4


def test_crawl_rows_are_numbered_within_their_file(spark):
    docs = [[_doc(f"{i}{k}", k) for k in range(3)] for i in range(4)]
    items = feedparse.feed_items(_dump(spark, *[{"documents": d} for d in docs]))
    none = spark.createDataFrame([], schemas.DOC_META_JSON)
    rows = feedparse.crawl_rows(items, feedparse.doc_metadata(none, "2024-01-31"))
    found = [(r["line_no"], r["docid"]) for r in rows.orderBy("line_no").collect()]
    assert found == list(enumerate((d["docid"] for dump in docs for d in dump), 1))


def test_a_grid_has_every_user(spark):
    users = spark.range(1500).selectExpr("id AS user_id", "'z' AS nr_zip")
    assert sampling.sample_arm_grid(users, [], []).count() == 1500


def _feature(**fields):
    return {"static_feature": {"url": "u", "domain": "d", "stitle": "t\tt", "date": "2024", **fields}}


def test_metadata_and_crawl_rows(spark, rows_of):
    bodies = {
        "ok": {"data": {"ok": _feature()}},
        "two": {"data": {"two": _feature(), "x": _feature()}},
        "no_feature": {"data": {"no_feature": {}}},
        "no_data": {"status": 1},
        "no_title": {"data": {"no_title": {"static_feature": {"url": "u", "domain": "d", "date": "2024"}}}},
    }
    rows = [(k, json.dumps(v)) for k, v in bodies.items()] + [("cut", '{"data"'), ("null", None)]
    meta = feedparse.doc_metadata(spark.createDataFrame(rows, schemas.DOC_META_JSON), "2024-01-31")
    assert rows_of(meta, "docid", "meta_status") == [
        ("cut", "broken"), ("no_data", "null"), ("no_feature", "null"), ("no_title", "broken"),
        ("null", "broken"), ("ok", "ok"), ("two", "null"),
    ]
    assert rows_of(meta.where("docid in ('ok', 'two')"), "url", "domain", "title", "pub_time", "run_date") == [
        ("null",) * 5,
        ("u", "d", "t t", "2024", "2024-01-31"),
    ]
    items = feedparse.feed_items(_dump(spark, {"documents": [_doc("ok", 0), _doc("cut", 1), _doc("gone", 2), _doc("two", 3)]}))
    crawl = feedparse.crawl_rows(items, meta)
    assert rows_of(crawl, "docid", "width", "is_local", "url", "domain", "title") == [
        ("cut", 5, "False", None, None, None),
        ("gone", 8, "False", "gone", "nullTitle", "nullPubTime"),
        ("ok", 10, "False", "u", "d", "t t"),
        ("two", 10, "False", "null", "null", "null"),
    ]


def test_dedupe_accepts_one_more_than_the_maximum(spark, rows_of):
    rows = [(5, 10, "c"), (1, 10, "a"), (2, 1, None), (3, 10, "a"), (4, 2, "b"), (6, 10, "d")]
    df = spark.createDataFrame(rows, "line_no bigint, width int, docid string")
    assert rows_of(feedparse.assess_dedupe(df, 2), "line_no", "docid") == [(1, "a"), (4, "b"), (5, "c")]
