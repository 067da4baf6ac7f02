"""A keyed table under partial updates, against a dictionary."""

import os
import random

import pytest
from pyspark.sql import functions as F

from feedloom import commits
from feedloom.snapshots import KeyedSnapshot

SCHEMA = "docid string, kind string, score long"


def table(rows):
    return sorted(map(tuple, rows), key=repr)


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture
def index(spark, tmp_path):
    made = KeyedSnapshot(spark, str(tmp_path / "index"), "docid", buckets=4)
    made.create(spark.createDataFrame([(f"d{k}", "old", k) for k in range(40)], SCHEMA))
    return made


def test_updates_in_any_order_of_compaction_equal_a_dictionary(spark, index):
    expected = {f"d{k}": ["old", k] for k in range(40)}
    random.seed(3)
    for step in range(6):
        keys = [f"d{random.randrange(45)}" for _ in range(8)]
        field, at = (("kind", 0), ("score", 1))[step % 2]
        changes = {k: (None if random.random() < 0.3 else (f"s{step}" if at == 0 else step)) for k in keys}
        kind = "string" if at == 0 else "long"
        index.update(spark.createDataFrame(list(changes.items()), f"docid string, {field} {kind}"))
        for k, value in changes.items():
            if k in expected:
                expected[k][at] = value
        if step in (2, 4):
            touched = index.compact(min_deltas=2 if step == 2 else 1)
            assert touched and index.compact(min_deltas=99) == []
        if step == 4:
            index.vacuum()
        again = KeyedSnapshot(spark, index.path, "docid", buckets=99)  # keeps its number of buckets
        assert again.buckets == 4
        assert table(again.read().collect()) == table([(k, *v) for k, v in expected.items()])


def test_an_update_writes_what_it_changes(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("docid"), F.lit("old").alias("kind"), F.sha2(F.col("id").cast("string"), 512).alias("body"))
    index = KeyedSnapshot(spark, str(tmp_path / "index"), "docid", buckets=4)
    index.create(rows)
    before = written(index.path)
    index.update(rows.where("docid % 100 = 0").select("docid", F.lit("new").alias("kind")))
    assert written(index.path) - before < 0.02 * before
    assert index.read().where("kind = 'new'").count() == 200
    # One changed document: one of four buckets is written anew.
    assert len(index.compact()) == 4
    before = written(index.path)
    index.update(rows.where("docid = 7").select("docid", F.lit("newer").alias("kind")))
    assert len(index.compact()) == 1 and 0.2 * before < 2 * (written(index.path) - before) < 0.8 * before
    assert index.read().where("docid = 7").first()["kind"] == "newer" and index.read().count() == 20_000


def test_the_base_is_not_shuffled_for_a_small_delta(spark, index):
    index.update(spark.createDataFrame([("d1", "new")], "docid string, kind string"))
    rows = index.read()
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("== Initial Plan ==")[0] and "SortMergeJoin" not in plan.split("== Initial Plan ==")[0]


def test_failed_and_concurrent_writers(spark, index, monkeypatch):
    before = table(index.read().collect())
    change = spark.createDataFrame([("d1", "new")], "docid string, kind string")
    index._write(index._bucketed(change), "delta")  # written, never renamed
    assert table(index.read().collect()) == before
    # An update takes the number that a compaction has chosen: the compaction fails, nothing is lost.
    index.update(change)
    real = index._write

    def slow(rows, kind):
        found = real(rows, kind)
        if kind == "base":
            index._write = real
            index.update(spark.createDataFrame([("d2", "other")], "docid string, kind string"))
        return found

    index._write = slow
    with pytest.raises(commits.PlaceTaken):
        index.compact()
    kinds = {r["docid"]: r["kind"] for r in index.read().collect()}
    assert (kinds["d1"], kinds["d2"], kinds["d3"]) == ("new", "other", "old")
    assert index.compact() and {r["docid"]: r["kind"] for r in index.read().collect()} == kinds
    index.vacuum()
    assert {r["docid"]: r["kind"] for r in index.read().collect()} == kinds
    assert not [n for n in commits.names(spark, index.root) if n.startswith("_attempt")]
