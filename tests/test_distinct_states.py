"""Mergeable distinct counts against sets."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom import jobs
from feedloom.operators import distinct_states as ds

def sums():
    return [F.sum("n").alias("n")]


@pytest.mark.parametrize("dense", [1, 5, 10**6])
def test_days_and_groups_merge_as_sets_do(spark, dense):
    random.seed(dense)
    ids = [0, -1, -40_000, 1, 32_768, 32_769, 2**62, -(2**63), None, *range(100, 130)]
    rows = [(d, random.choice("ab"), random.choice("xyz"), random.choice(ids), 1) for d in range(4) for _ in range(200)]
    frame = spark.createDataFrame(rows, "day int, k string, part string, id long, n long")
    states = ds.distinct_states(frame, ["day", "k", "part"], "id", sums(), dense)
    assert states.where(f"{ds.PLACES} IS NOT NULL AND {ds.BITS} IS NOT NULL").count() == 0
    for keys in (["k"], ["k", "part"], ["day"]):
        found = ds.merged_counts(states, keys, ["n"], "ids").collect()
        at = [["day", "k", "part"].index(k) for k in keys]
        expected = {}
        for row in rows:
            n, held = expected.get(tuple(row[i] for i in at), (0, set()))
            expected[tuple(row[i] for i in at)] = (n + row[4], held | {row[3]} - {None})
        assert {tuple(r[: len(keys)]): (r["n"], r["ids"]) for r in found} == {k: (n, len(s)) for k, (n, s) in expected.items()}


def test_a_dense_group_is_bitmaps_and_a_sparse_one_lists(spark):
    rows = spark.range(1, 100_001).select(F.lit("hot").alias("k"), "id", F.lit(1).alias("n"))
    rows = rows.unionByName(spark.range(5).select(F.lit("cold").alias("k"), (F.col("id") * 10**9).alias("id"), F.lit(1).alias("n")))
    states = ds.distinct_states(rows, ["k"], "id", sums())
    hot = states.where("k = 'hot'")
    # The last bucket holds 1,696 ids, fewer than a bitmap is worth.
    assert hot.count() == 4 and hot.where(f"{ds.BITS} IS NULL").count() == 1
    assert states.where(f"k = 'cold' AND {ds.BITS} IS NULL").count() == 5
    assert {tuple(r) for r in ds.merged_counts(states, ["k"], ["n"], "ids").collect()} == {("hot", 100_000, 100_000), ("cold", 5, 5)}


def test_days_that_are_over_are_not_read_again(spark, tmp_path, impressions, documents, monkeypatch):
    from feedloom.plans import geo

    def fact(day, user, clicked):
        return {"pdate": date(2024, 1, day), "user_id": user, "clicked": clicked, "doc_id": "d1" if clicked else "d2"}

    facts = impressions(*[fact(day, user, user % 2) for day in (27, 28, 29, 30) for user in range(day, day + 4)])
    facts.write.partitionBy("pdate").parquet(str(tmp_path / "tables" / "interactions"))
    tags = [("city", "p1")]
    docs = documents(*[{"doc_id": d, "channels": ["c"], "geotag": tags if d == "d1" else [], "pdate": date(2024, 1, 29)} for d in ("d1", "d2")])
    docs.write.partitionBy("pdate").parquet(str(tmp_path / "tables" / "doc_dim"))
    zips = spark.createDataFrame([("z1", "c1", date(2024, 1, d)) for d in (27, 28, 29)], "id string, city_id string, pdate date")
    zips.write.partitionBy("pdate").parquet(str(tmp_path / "tables" / "zip_geo"))
    seen = []
    real = geo.local_impressions
    monkeypatch.setattr(geo, "local_impressions", lambda rows, day, days: seen.append(day.day) or real(rows, day, days))
    for day, read in ((29, [26, 27, 28, 29]), (30, [29, 30]), (30, [29, 30])):
        seen.clear()
        run = jobs.Run(spark, str(tmp_path / "tables"), str(tmp_path / "out"), datetime(2024, 1, day))
        jobs.cross_geo(run, min_users=1, min_check=1, min_rows=1)
        assert seen == read
        landed = [r["value"].split("\t") for r in spark.read.text(run.path("cross_geo_channel/rows")).collect()]
        days = [d for d in (27, 28, 29, 30) if day - 3 <= d <= day]
        users = {u for d in days for u in range(d, d + 4)}
        assert len(landed) == 1 and landed[0][:3] == ["c1", "c", "city@p1"]
        assert [int(landed[0][k]) for k in (4, 7, 9, 12)] == [2 * len(days), len({u for u in users if u % 2}), 4 * len(days), len(users)]
