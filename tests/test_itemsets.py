"""Item sets that take a day at a time, against plain sets and the one-month history."""

import random
from datetime import date, datetime, timedelta

import pytest

from feedloom import commits, jobs
from feedloom.itemsets import ClosedDay, ItemSets
from feedloom.plans import history
from feedloom.sources import schemas

FIRST = date(2024, 1, 1)
DAYS = [FIRST + timedelta(days=k) for k in range(31)]
WINDOW = dict(first_publish=date(2023, 8, 1), last_publish=DAYS[-1], snapshot=DAYS[-1])


def rows_on(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id long, item string, day date")


def held(sets, *window):
    found = sets.read(*window)
    return set() if found is None else {(r["user_id"], r["item"], r["day"]) for r in found.collect()}


def test_daily_merges_equal_the_query_of_the_month(spark, impressions, tmp_path):
    random.seed(31)
    docs = spark.createDataFrame(
        [(f"d{i}", datetime(2024, 1, 1), random.choice(["evergreen", "short", None]), random.choice([0.1, 0.9, None]), DAYS[-1])
         for i in range(20)],
        schemas.DOC_STATIC_DAILY,
    )
    facts = impressions(
        *[
            {
                "pdate": random.choice(DAYS), "doc_id": f"d{random.randrange(25)}", "ts": random.randrange(40),
                # One reader owns a third of all rows.
                "user_id": 7 if i % 3 == 0 else random.randrange(40),
                "nr_condition": random.choice(["an_evergreen", "local_pop", None]),
            }
            for i in range(1500)
        ]
    )
    whole = history.user_history(facts, docs, DAYS[0], DAYS[-1], part_size=60, **WINDOW)
    sets = ItemSets(spark, str(tmp_path), "user_id", buckets=4, spread=3)
    for n, day in enumerate(DAYS):
        sets.put(history.read_items(facts, docs, day, day, **WINDOW), [day])
        if n % 10 == 9:
            sets.fold(day, FIRST, min_days=2)
        if n == 19:
            sets.vacuum()
    kept = history.kept_history(sets, DAYS[0], DAYS[-1], part_size=60)
    expected = sorted(map(repr, whole.collect()))
    assert len(expected) > 40 and sorted(map(repr, kept.collect())) == expected
    assert max(r["n_parts"] for r in kept.collect()) > 1
    changed = {r["user_id"] for r in sets.touched(DAYS[-1]).collect()}
    fresh = history.kept_history(sets, DAYS[0], DAYS[-1], part_size=60, changed_on=DAYS[-1]).collect()
    assert sorted(map(repr, fresh)) == sorted(repr(r) for r in whole.collect() if r["user_id"] in changed)


def test_a_day_is_replaced_until_it_is_folded(spark, tmp_path):
    sets = ItemSets(spark, str(tmp_path), "user_id", buckets=4)
    assert sets.read() is None and sets.fold(DAYS[5]) == [] and sets.closed() is None
    assert history.kept_history(sets, DAYS[0], DAYS[5]).count() == 0
    sets.put(rows_on(spark, (1, "a", DAYS[0]), (1, "a", DAYS[0]), (1, "b", DAYS[1]), (2, None, DAYS[0]), (None, "a", DAYS[0])), DAYS[:2])
    sets.put(rows_on(spark, (1, "c", DAYS[1])), [DAYS[1]])
    assert held(sets) == {(1, "a", DAYS[0]), (1, "c", DAYS[1])}
    assert held(sets, None, DAYS[0]) == {(1, "a", DAYS[0])}
    sets.put(rows_on(spark), [DAYS[1], DAYS[2]])
    assert held(sets) == {(1, "a", DAYS[0])} and sets.open_days(DAYS[:4]) == [DAYS[3]]
    assert sets.touched(DAYS[2]) is None
    sets.fold(DAYS[0])
    with pytest.raises(ClosedDay):
        sets.put(rows_on(spark), [DAYS[0]])
    sets.put(rows_on(spark, (1, "a", DAYS[3])), [DAYS[3]])
    assert held(sets) == {(1, "a", DAYS[3])}
    sets.fold(DAYS[3])
    with pytest.raises(ClosedDay):
        sets.read(None, DAYS[2])
    # Made with four buckets, it keeps them.
    assert ItemSets(spark, str(tmp_path), "user_id", buckets=64).buckets == 4


def test_items_leave_with_the_last_day_they_were_seen_on(spark, tmp_path):
    sets = ItemSets(spark, str(tmp_path), "user_id", buckets=2)
    sets.put(rows_on(spark, (1, "old", DAYS[0]), (1, "again", DAYS[0]), (1, "again", DAYS[9])), [DAYS[0], DAYS[9]])
    assert held(sets, DAYS[5]) == {(1, "again", DAYS[9])}
    sets.fold(DAYS[9], DAYS[5])
    assert held(sets) == {(1, "again", DAYS[9])}
    # A bucket whose items are all gone holds no file, but is closed.
    sets.put(rows_on(spark, (1, "new", DAYS[12])), [DAYS[12]])
    sets.fold(DAYS[12], DAYS[20])
    sets.vacuum()
    assert held(sets, DAYS[20]) == set() and sets.closed() == DAYS[12]


def test_only_touched_buckets_are_written_anew(spark, tmp_path):
    sets = ItemSets(spark, str(tmp_path), "user_id", buckets=32, spread=2)
    many = spark.range(20_000).selectExpr("id % 500 AS user_id", "concat('i', id) AS item", f"DATE '{DAYS[0]}' AS day")
    sets.put(many, [DAYS[0]])
    assert len(sets.fold(DAYS[0])) == 32
    sets.put(rows_on(spark, (3, "x", DAYS[1]), (3, "y", DAYS[1]), (4, "x", DAYS[1])), [DAYS[1]])
    written = spark.read.parquet(f"{sets.root}/day={DAYS[1]}").count()
    touched = sets.fold(DAYS[1])
    assert written == 3 and 1 <= len(touched) <= 4
    base = spark.read.option("basePath", sets.root).parquet(f"{sets.root}/base=1")
    assert {r[0] for r in base.select("_bucket").distinct().collect()} == set(touched)
    assert len(held(sets)) == 20_003
    sets.vacuum()
    assert len(held(sets)) == 20_003 and sets.days() == []


def test_a_failed_attempt_is_never_read(spark, tmp_path, monkeypatch):
    sets = ItemSets(spark, str(tmp_path), "user_id", buckets=2)
    sets.put(rows_on(spark, (1, "a", DAYS[0])), [DAYS[0]])

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "swap", fails)
        with pytest.raises(RuntimeError):
            sets.put(rows_on(spark, (1, "b", DAYS[0])), [DAYS[0]])
        patch.setattr(commits, "rename", fails)
        with pytest.raises(RuntimeError):
            sets.fold(DAYS[0])
    assert held(sets) == {(1, "a", DAYS[0])}
    sets.put(rows_on(spark, (1, "b", DAYS[0])), [DAYS[0]])
    sets.vacuum()
    assert held(sets) == {(1, "b", DAYS[0])} and not [n for n in commits.names(spark, sets.root) if n[0] == "_"]


def test_the_job_keeps_items_from_run_to_run(spark, tmp_path, impressions):
    tables, out = f"{tmp_path}/tables", f"{tmp_path}/out"
    facts = [{"pdate": d, "ts": i, "doc_id": "long", "user_id": i % 3 + 1} for i, d in enumerate(DAYS)]
    docs = [("long", datetime(2024, 1, 1), "evergreen", 0.9, d) for d in DAYS]
    impressions(*facts).write.partitionBy("pdate").parquet(f"{tables}/interactions")
    spark.createDataFrame(docs, schemas.DOC_STATIC_DAILY).write.partitionBy("pdate").parquet(f"{tables}/doc_static_daily")

    def lines(**more):
        runs = []
        for day in (datetime(2024, 1, 28), datetime(2024, 1, 30), datetime(2024, 1, 30), datetime(2024, 1, 31)):
            run = jobs.Run(spark, tables, out, day)
            jobs.user_history(run, fact_days=20, **more)
            runs.append(sorted(r["value"] for r in spark.read.text(run.path("user_history")).collect()))
        return runs

    expected = lines()
    assert expected[0] != expected[1] == expected[2] != expected[3]
    assert lines(keep=True, fold_after=1) == expected
