import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.plans import review
from feedloom.sources import schemas

D1 = date(2024, 1, 1)


@pytest.fixture
def lines(spark):
    def build(*rows):
        """(line_no, day offset, arm, width, docid)"""
        data = [
            (n, D1 + timedelta(d), arm, w, "u", doc, "1", "False", "null", "url", "dom", "t", "pt", "rd")
            for n, d, arm, w, doc in rows
        ]
        return spark.createDataFrame(data, schemas.CRAWL_ROWS)

    return build


@pytest.fixture
def reviews(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), schemas.REVIEWS)

    return build


@pytest.fixture
def ledger(spark):
    def build(*docids):
        return spark.createDataFrame([(d, "s") for d in docids], schemas.WRITTEN_LEDGER)

    return build


def _ok(docid, status="ok", reason="r", editor="e"):
    return (docid + "_from_foryou", (status, reason, editor))


def test_enqueue_outcomes(lines, reviews, ledger, rows_of):
    df = lines(
        (1, 0, "online", 1, None),
        (2, 0, "online", 10, "new"),
        (3, 0, "online", 10, "new"),
        (4, 0, "online", 2, "written"),
        (5, 0, "online", 10, "known"),
        (6, 0, "online", 10, "known"),
        (7, 0, "exp", 10, "new"),
        (8, 0, "online", 1, None),
        (9, 0, "online", 10, "both"),
    )
    # A review counts under its bare id only.
    seen = reviews(("known", None), _ok("new"), ("both", None))
    firsts = review.first_outcomes(df, ledger("written", "written", "both"), seen)
    outcome = review.review_enqueue(df, firsts)
    assert rows_of(outcome, "line_no", "outcome") == [
        (1, "skip"), (2, "succ"), (3, "dup"), (4, "dup"), (5, "exist"), (6, "dup"), (7, "dup"), (8, "skip"), (9, "dup"),
    ]
    counts = rows_of(review.review_enqueue_counts(df, firsts), "arm", "succ_num", "exist_num", "dup_num", "skip_num")
    assert counts == [("exp", 0, 0, 1, 0), ("online", 1, 1, 4, 2)]
    assert sum(sum(c[1:]) for c in counts) == df.count()
    messages = [json.loads(r["value"]) for r in review.review_messages(firsts).collect()]
    assert messages == [{"docid": "new", "queue": "quality_check", "tag": ["from_foryou"]}]
    assert rows_of(review.ledger_rows(firsts, F.col("arm"))) == [("new", "online")]


def test_runs_see_what_earlier_runs_queued(lines, reviews, ledger, rows_of):
    df = lines(
        (1, 1, "online", 10, "a"),
        (1, 0, "zeta", 10, "a"),
        (2, 0, "zeta", 10, "b"),
        (1, 0, "alpha", 10, "b"),
        (2, 0, "alpha", 10, "k"),
        (2, 1, "online", 10, "k"),
    )
    known, none = reviews(("k", None)), ledger()
    by_name = review.first_outcomes(df, none, known)
    assert rows_of(by_name.where("outcome = 'succ'"), "arm", "docid") == [("alpha", "b"), ("zeta", "a")]
    # One under review is found anew in every run.
    assert rows_of(by_name.where("docid = 'k'"), "arm", "outcome") == [("alpha", "exist"), ("online", "exist")]
    given = review.first_outcomes(df, none, known, ["online", "zeta", "alpha"])
    assert rows_of(given.where("outcome = 'succ'"), "arm", "docid") == [("zeta", "a"), ("zeta", "b")]


def test_lookup_messages(lines, reviews, rows_of):
    df = lines(*[(i, 0, "online", w, d) for i, (w, d) in enumerate([(10, "a"), (8, "b"), (10, "c"), (10, "d"), (2, "e"), (10, "f")])])
    known = reviews(
        _ok("a", reason=None, editor=None),
        ("b_from_foryou", (None, "r", "ed")),
        ("c_from_foryou", None),
        _ok("e"),
        ("f", ("ok", "r", "e")),
    )
    assert rows_of(review.review_lookup(df, known), "docid", "ret", "status", "reason", "editor") == [
        ("a", "succ", "ok", "null", "null"),
        ("b", "error", "null", "no_status", "ed"),
        ("c", "error", "null", "no_review", "null"),
        ("d", "error", "null", "not_in_mongo", "null"),
        ("f", "error", "null", "not_in_mongo", "null"),
    ]


def test_gate_stops_a_run_above_the_ratio(lines, reviews, rows_of):
    good = [(i, 0, "online", 10, "a") for i in range(2)] + [(i, 0, "online", 10, "x") for i in range(2, 9)] + [(9, 0, "online", 1, None)]
    bad = [(i, 0, "exp", 10, "x") for i in range(9)] + [(9, 0, "exp", 10, "a")]
    df, known = lines(*good, *bad), reviews(_ok("a"))
    gate = review.review_gate(review.reviewed_docs(df, known))
    assert rows_of(gate, "arm", "line_cnt", "succ_cnt", "wrong_cnt", "empty_cnt", "fail_ratio", "passed") == [
        ("exp", 10, 1, 0, 9, 0.9, False),
        ("online", 10, 2, 1, 7, 0.8, True),
    ]
    labeled = review.review_labeled(df, known, gate)
    assert rows_of(labeled.groupBy("arm", "status", "reason").count()) == [
        ("online", "not_reviewed", "", 7),
        ("online", "ok", "r", 2),
    ]
    open_gate = gate.withColumn("passed", F.lit(True))
    assert review.review_labeled(df, known, open_gate).count() == 19


def test_editor_checks(lines, reviews, rows_of):
    df = lines(*[(i, 0, "online", 10, d) for i, d in enumerate(["a", "a", "b", "c", "n"])])
    known = reviews(_ok("a"), _ok("b", status="poor"), _ok("c", status="odd"), ("n_from_foryou", (None, None, "e")))
    lookup = review.reviewed_docs(df, known)
    columns = ("type", "editor", "total", "ok", "poor", "detrimental", "ok_rate", "poor_rate", "detrimental_rate")
    assert rows_of(review.editor_weighted(lookup), *columns) == [("weighted_doc", "e", 4, 2, 1, 0, 0.5, 0.25, 0.0)]
    assert rows_of(review.editor_unique(lookup), *columns) == [("uniq_doc", "e", 3, 1, 1, 0, 1 / 3, 1 / 3, 0.0)]


@pytest.fixture
def tables(lines, reviews):
    def build(*rows):
        """(line_no, day offset, docid): what the reviews say is in the id, ``doc.status.reason``."""
        df = lines(*[(n, d, "online", 10, doc) for n, d, doc in rows])
        known = {doc: doc.split(".") for _, _, doc in rows if "." in doc}
        state = reviews(*[_ok(doc, status, reason) for doc, (_, status, reason) in known.items()])
        docs = review.reviewed_docs(df, state)
        gate = review.review_gate(docs, max_fail_ratio=1.0)
        return review.review_daily(docs, gate), gate

    return build


def test_analysis_of_one_day_and_of_a_window(tables, rows_of):
    tables = tables(
        (1, 0, "a.ok.x"),
        (2, 0, "p.poor.x"),
        (3, 0, "b.ok.y"),
        (4, 0, "c"),
        (5, 0, "d.ok. "),
        (6, 0, "a.ok.x"),
        (1, 2, "a.ok.x"),
        (2, 2, "e.odd.x"),
        (1, 6, "z"),
        (1, 7, "p.poor.x"),
    )
    day = [(D1 + timedelta(d)) for d in (0, 2, 6, 7)]
    columns = ("day", "total_cnt", "succ_cnt", "wrong_cnt", "uniq_doc_cnt", "succ_rate")
    assert rows_of(review.review_summary(*tables), *columns) == [
        (day[0], 6, 4, 2, 3, 4 / 6),
        (day[1], 2, 2, 0, 2, 1.0),
        (day[2], 1, 0, 1, 0, 0.0),
        (day[3], 1, 1, 0, 1, 1.0),
    ]
    # Seven days back from a day that has a run: day 7 no longer sees day 0.
    assert rows_of(review.review_summary(*tables, 7), *columns) == [
        (day[0], 6, 4, 2, 3, 4 / 6),
        (day[1], 8, 6, 2, 4, 0.75),
        (day[2], 9, 6, 3, 4, 6 / 9),
        (day[3], 4, 3, 1, 3, 0.75),
    ]
    assert rows_of(review.review_status(*tables), "day", "status", "cnt", "rate")[:2] == [
        (day[0], "ok", 3, 0.75),
        (day[0], "poor", 1, 0.25),
    ]
    reasons = review.review_status_reason(*tables).where(F.col("day") == F.lit(day[0]))
    assert [tuple(r)[2:] for r in reasons.collect()] == [("ok", "x", 2, 2 / 3), ("ok", "y", 1, 1 / 3), ("poor", "x", 1, 1.0)]
    unique = rows_of(review.review_unique_status(*tables), "day", "status", "cnt")
    assert unique[:2] == [(day[0], "ok", 2), (day[0], "poor", 1)]
    week = [r for r in rows_of(review.review_unique_status(*tables, 7), "day", "status", "cnt") if r[0] == day[1]]
    assert week == [(day[1], "odd", 1), (day[1], "ok", 2), (day[1], "poor", 1)]


def test_the_newest_day_decides_a_status(spark, rows_of):
    def row(day, doc, status, usable=True):
        return (D1 + timedelta(day), "online", doc, status, "x", 1, usable)

    daily = spark.createDataFrame(
        [row(0, "a", "poor"), row(2, "a", "odd"), row(2, "b", "ok"), row(9, "a", "ok", False), row(10, "a", "ok"), row(12, "c", "ok")],
        "day date, arm string, docid string, status string, reason string, cnt bigint, usable boolean",
    )
    # Day 4 did not pass the gate; day 5 did without a complete line and reports the days before.
    # Day 13 is past the data.
    runs = {0: 1, 1: 1, 2: 1, 4: 0, 5: 1, 6: 1, 8: 1, 9: 1, 10: 1, 13: 1}
    gate = spark.createDataFrame(
        [(D1 + timedelta(d), "online", bool(p), 0 if d == 5 else 2) for d, p in runs.items()],
        "day date, arm string, passed boolean, complete_cnt bigint",
    )
    counts = rows_of(review.review_unique_status(daily, gate, 7), "day", "status", "cnt")
    assert sorted(((d - D1).days, status, n) for d, status, n in counts) == [
        (0, "poor", 1), (1, "poor", 1), (2, "odd", 1), (2, "ok", 1), (5, "odd", 1), (5, "ok", 1), (6, "odd", 1), (6, "ok", 1),
        (8, "odd", 1), (8, "ok", 1), (10, "ok", 1), (13, "ok", 2),
    ]


def test_metric_points(tables):
    tables = tables((1, 0, "a.ok.x"), (2, 0, "b.odd.x"), (1, 1, "c"))
    points = {(p["metric"], p["ts"]): p["value"] for p in review.review_metric_points(*tables).collect()}
    ts, prefix = 1704067200, "feed_quanlity_check_online"
    first = {m.removeprefix(prefix): v for (m, t), v in points.items() if t == ts}
    assert first == {
        "_count_total": 2.0, "_count_succ": 2.0, "_count_wrong": 0.0, "_count_succ_uniq_doc": 2.0, "_rate_succ": 1.0,
        "_count_status_ok": 1.0, "_rate_status_ok": 0.5, "_count_uniqdoc_status_ok": 1.0, "_rate_uniqdoc_status_ok": 0.5,
    }
    # A day without usable rows reports its counts only.
    assert sum(t == ts + 86400 for _, t in points) == 5
    week = {p["metric"] for p in review.review_metric_points(*tables, 7).collect()}
    assert "feed_quanlity_check_7d_online_rate_status_ok" in week


def test_payload_defaults(spark):
    rows = [
        ("1", None, None, None, None, None, None),
        ("2", True, "2024", "T", "http://x", ["i"], "see http://old/a and http://old/b"),
        ("3", False, "2024", "T", "http://x", [], "plain"),
    ]
    docs = spark.createDataFrame(rows, schemas.DISPLAY_DOC)
    payload = review.review_payload(docs, F.lit("now"), "http://art/{}?n=1", "http://img?u=", {"http://old": "https://new"})
    by_id = {r["_id"]: r for r in payload.collect()}
    assert by_id["1"]["doc"].asDict() == {"date": "", "title": "", "url": "", "image_urls": [], "content": ""}
    assert by_id["2"]["doc"].asDict() == {
        "date": "2024", "title": "T", "url": "http://art/2?n=1", "image_urls": ["http://img?u=i"],
        "content": "see https://new/a and https://new/b",
    }
    assert by_id["3"]["doc"]["url"] == "http://x" and by_id["1"]["mp_full_article"] is False
