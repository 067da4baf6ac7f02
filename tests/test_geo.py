from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom.plans import geo

AS_OF = date(2024, 1, 31)
ZIP_DAY = date(2024, 1, 29)


@pytest.fixture
def zips(spark):
    rows = [("z1", "c1", ZIP_DAY), ("z2", "c2", ZIP_DAY), ("z3", None, ZIP_DAY), ("z1", "old", date(2024, 1, 1))]
    return spark.createDataFrame(rows, "id string, city_id string, pdate date")


def _clicks(n, clicked, **given):
    return [{**given, "user_id": i, "clicked": int(i < clicked)} for i in range(n)]


def test_scope_of_the_fact(impressions):
    rows = [
        {"doc_id": "kept"},
        {"doc_id": "kept2", "channel_name": "foryou", "nr_condition": "x_local_y"},
        {"doc_id": "null_condition", "nr_condition": None},
        {"doc_id": "other_condition", "nr_condition": "evergreen"},
        {"doc_id": "other_channel", "channel_name": "channelnew"},
        {"doc_id": "not_joined", "joined": 0},
        {"doc_id": "not_checked", "checked": 0},
        {"doc_id": "too_old", "pdate": date(2024, 1, 27)},
        {"doc_id": "oldest", "pdate": date(2024, 1, 28)},
    ]
    kept = geo.local_impressions(impressions(*rows), AS_OF, 3)
    assert sorted(r["doc_id"] for r in kept.collect()) == ["kept", "kept2", "oldest"]


def test_city_metrics_keep_the_null_category(impressions, documents, zips, rows_of):
    facts = geo.city_doc_user(
        impressions(
            {"doc_id": "d1", "clicked": 1},
            {"doc_id": "d1", "user_id": 2},
            {"doc_id": "unknown"},
            {"doc_id": "empty"},
            {"doc_id": "d1", "nr_zip": "z3"},
            {"doc_id": "d1", "nr_zip": "nowhere"},
            {"doc_id": "d1", "nr_zip": None},
        ),
        zips,
        AS_OF,
    )
    docs = documents({"doc_id": "d1", "channels": ["a", "b"]}, {"doc_id": "empty", "channels": []})
    rows = rows_of(geo.city_category_ctr(facts, docs, "channel", AS_OF))
    assert rows == [
        ("c1", "a", 0.5, 2, 1, 1, 2),
        ("c1", "b", 0.5, 2, 1, 1, 2),
        ("c1", None, 0.0, 2, 0, 2, 1),
    ]


def _cross(impressions, documents, zips, **limits):
    docs = documents(
        {"doc_id": "d1", "channels": ["a"], "geotag": [("city", "p1"), ("state", "s")]},
        {"doc_id": "d2", "channels": ["a"], "geotag": [("city", "p2"), ("county", None)]},
        {"doc_id": "d3", "channels": ["a"], "geotag": []},
        {"doc_id": "d4", "channels": [None, "b"], "geotag": [(None, "p1"), ("city", "p1")]},
    )
    facts = geo.city_doc_user(
        impressions(
            *_clicks(10, 8, doc_id="d1"),
            *_clicks(10, 2, doc_id="d2"),
            *_clicks(20, 4, doc_id="d3"),
            *_clicks(6, 3, doc_id="d4"),
        ),
        zips,
        AS_OF,
    )
    return geo.cross_geo(facts, docs, "channel", AS_OF, **limits)


def test_cross_geo_beats_the_baseline_of_all_documents(impressions, documents, zips, rows_of):
    rows = rows_of(_cross(impressions, documents, zips, min_users=5, min_check=5))
    # Category a: 40 checks, 14 clicks, 20 users, with the untagged d3. Category b
    # has one geotag at exactly its baseline, which is not above it.
    assert rows == [("c1", "a", "city@p1", 0.8, 10, 8, 1, 10, 0.35, 40, 14, 3, 20)]


def test_cross_geo_thresholds(impressions, documents, zips):
    assert _cross(impressions, documents, zips, min_users=21, min_check=5).count() == 0
    assert _cross(impressions, documents, zips, min_users=20, min_check=11).count() == 0
    assert _cross(impressions, documents, zips, min_users=20, min_check=10).count() == 1


def test_cross_geo_can_name_a_null_pid(impressions, documents, zips, rows_of):
    docs = documents(
        {"doc_id": "d1", "channels": ["a"], "geotag": [("city", None)]},
        {"doc_id": "d2", "channels": ["a"], "geotag": [("city", "p")]},
    )
    facts = geo.city_doc_user(impressions(*_clicks(4, 4, doc_id="d1"), *_clicks(4, 1, doc_id="d2")), zips, AS_OF)
    rows = geo.cross_geo(facts, docs, "channel", AS_OF, min_users=1, min_check=1)
    assert rows_of(rows, "type_pid", "ctr", "base_ctr") == [(None, 1.0, 0.625)]
    assert rows_of(geo.cross_geo_kv(rows), "key", "value") == [("c1@a", "\\N")]


def test_cross_geo_cap_keeps_the_first_rows(impressions, documents, zips, rows_of):
    docs = documents(
        *[{"doc_id": f"d{i}", "channels": ["a"], "geotag": [("city", f"p{i}")]} for i in range(6)],
        {"doc_id": "low", "channels": ["a"], "geotag": []},
    )
    rows = [r for i in range(6) for r in _clicks(10, 4 + i, doc_id=f"d{i}")] + _clicks(100, 0, doc_id="low")
    facts = geo.city_doc_user(impressions(*rows), zips, AS_OF)
    capped = geo.cross_geo(facts, docs, "channel", AS_OF, min_users=1, min_check=1, max_rows=4)
    assert [r["type_pid"] for r in capped.collect()] == ["city@p5", "city@p4", "city@p3", "city@p2"]


def test_snapshots_multiply_sums_unless_deduped(impressions, documents, zips, rows_of):
    docs = documents(
        {"doc_id": "d1", "channels": ["a"], "pdate": date(2024, 1, 29)},
        {"doc_id": "d1", "channels": ["b"], "pdate": date(2024, 1, 30)},
        {"doc_id": "d1", "channels": ["b"], "pdate": date(2024, 1, 28)},
    )
    facts = geo.city_doc_user(impressions(*_clicks(3, 1, doc_id="d1")), zips, AS_OF)
    plain = geo.city_category_ctr(facts, docs, "channel", AS_OF)
    assert rows_of(plain, "category", "checks", "docs") == [("a", 3, 1), ("b", 6, 1)]
    deduped = geo.city_category_ctr(facts, docs, "channel", AS_OF, dedupe_docs=True)
    assert rows_of(deduped, "category", "checks", "docs") == [("b", 3, 1)]


def test_top_docs_at_the_baseline_are_kept(impressions, documents, rows_of):
    docs = documents(
        *[
            {"doc_id": d, "first_cat": {"x": 1.0}, "geotag": [("city", "p"), ("state", "s"), ("city", None), (None, "q")]}
            for d in ("d1", "d2", "d3", "d4")
        ]
    )
    facts = impressions(
        *_clicks(10, 5, doc_id="d1"), *_clicks(10, 7, doc_id="d2"), *_clicks(10, 3, doc_id="d3"), *_clicks(2, 1, doc_id="d4")
    )
    rows = geo.geo_top_docs(geo.doc_impressions(facts, AS_OF), docs, "first_cat", AS_OF, min_check=3)
    base = ("x@city@p", 0.5, 32, 16)
    assert rows_of(rows) == [("x@city@p", "d1", 0.5, 10, 5, *base), ("x@city@p", "d2", 0.7, 10, 7, *base)]
    assert rows_of(geo.geo_top_docs_kv(rows, 1), "value") == [("d2",)]
    assert rows_of(geo.geo_top_docs_kv(rows), "value") == [("d2#d1",)]


def test_top_docs_ties_go_by_id(impressions, documents, rows_of):
    docs = documents(*[{"doc_id": d, "channels": ["x"], "geotag": [("city", "p")]} for d in ("b", "c", "a")])
    facts = impressions(*[r for d in "bca" for r in _clicks(4, 2, doc_id=d)])
    rows = geo.geo_top_docs(geo.doc_impressions(facts, AS_OF), docs, "channel", AS_OF, min_check=1)
    assert rows_of(geo.geo_top_docs_kv(rows), "value") == [("a#b#c",)]


def test_new_docs_cap_is_exclusive(documents, rows_of):
    def doc(i, hour, **more):
        return {
            "doc_id": f"d{i:02}", "channels": ["a"], "geotag": [("city", "p")],
            "publish_time": datetime(2024, 1, 30, hour), **more,
        }

    docs = documents(
        *[doc(i, 20) for i in range(25)],
        doc(90, 11),
        doc(91, 21, geotag=[("state", "p")]),
        doc(92, 21, channels=[None]),
        doc(93, 21, pdate=date(2024, 1, 28)),
    )
    rows = geo.geo_new_docs(docs, "channel", datetime(2024, 1, 30, 18, 59))
    assert rows_of(rows) == [("a@city@p", 19, "#".join(f"d{i:02}" for i in range(19)))]
    # The hour floor lets a document of 12:00 in, not the one of 11:00.
    early = documents(doc(1, 12), doc(2, 11))
    assert rows_of(geo.geo_new_docs(early, "channel", datetime(2024, 1, 30, 18, 59)), "value") == [("d01",)]


def test_new_docs_takes_the_newest_and_a_repeated_key_takes_two_places(documents, rows_of):
    docs = documents(
        {"doc_id": "new", "channels": ["a", "a"], "geotag": [("city", "p")], "publish_time": datetime(2024, 1, 30, 17)},
        {"doc_id": "mid", "channels": ["a"], "geotag": [("city", "p")], "publish_time": datetime(2024, 1, 30, 16)},
        {"doc_id": "old", "channels": ["a"], "geotag": [("city", "p")], "publish_time": datetime(2024, 1, 30, 15)},
    )
    rows = geo.geo_new_docs(docs, "channel", datetime(2024, 1, 30, 18), max_docs_exclusive=4)
    assert rows_of(rows) == [("a@city@p", 2, "mid#new")]


def test_rounding_is_half_up(spark):
    from feedloom.functions import rounded_ctr

    df = spark.createDataFrame([(1, 32), (2469, 20000), (1, 3), (0, 5), (0, 0)], "clicks bigint, checks bigint")
    values = [r[0] for r in df.select(rounded_ctr(F.col("clicks"), F.col("checks"))).collect()]
    assert values == [0.0313, 0.1235, 0.3333, 0.0, None]


def test_unknown_dimension_is_refused(documents):
    with pytest.raises(ValueError):
        geo.geo_new_docs(documents({"doc_id": "d"}), "third_cat", datetime(2024, 1, 30))




def test_documents_without_geotags_count_for_the_baseline(impressions, documents, zips, rows_of):
    facts = geo.city_doc_user(
        impressions(*_clicks(10, 5, doc_id="tagged"), *_clicks(10, 0, doc_id="null"), *_clicks(10, 0, doc_id="empty")),
        zips,
        AS_OF,
    )
    docs = documents(
        {"doc_id": "tagged", "channels": ["a"], "geotag": [("city", "p1")]},
        {"doc_id": "null", "channels": ["a"], "geotag": None},
        {"doc_id": "empty", "channels": ["a"], "geotag": []},
    )
    rows = geo.cross_geo(facts, docs, "channel", AS_OF, min_users=1, min_check=1)
    assert rows_of(rows, "type_pid", "ctr", "base_ctr", "base_docs") == [("city@p1", 0.5, 0.1667, 3)]


def test_more_rows_than_the_former_cap_stay(spark, rows_of):
    n = 1_000_050
    per_doc = spark.range(n).selectExpr("cast(id as string) doc_id", "1 checks", "1 clicks")
    docs = spark.range(n).selectExpr(
        "cast(id as string) doc_id",
        "date'2024-01-31' pdate",
        "array('a') channels",
        "array(named_struct('type', 'city', 'pid', 'p')) geotag",
    )
    assert geo.geo_top_docs(per_doc, docs, "channel", AS_OF, min_check=1).count() == n


def test_only_the_latest_snapshot_counts_if_asked(impressions, documents, rows_of):
    per_doc = geo.doc_impressions(impressions({"doc_id": "d"}, {"doc_id": "d"}), AS_OF)
    docs = documents(
        {"doc_id": "d", "channels": ["a"], "geotag": [("city", "p1")], "pdate": date(2024, 1, 29)},
        {"doc_id": "d", "channels": ["a"], "geotag": [("city", "p1")], "pdate": date(2024, 1, 30)},
    )
    every = geo.geo_top_docs(per_doc, docs, "channel", AS_OF, min_check=1)
    assert rows_of(every, "list_key", "checks") == [("a@city@p1", 4)]
    latest = geo.geo_top_docs(per_doc, docs, "channel", AS_OF, min_check=1, dedupe_docs=True)
    assert rows_of(latest, "list_key", "checks") == [("a@city@p1", 2)]
