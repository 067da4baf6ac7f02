"""Bucketed layouts: same rows, and no shuffle under joins on their key."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from feedloom import commits, jobs
from feedloom.plans import geo
from feedloom.sources import bucketed
from feedloom.sources.testdata import ALL_DAYS, AS_OF, load


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("laid"))
    t = load(spark, TESTDATA)
    bucketed.write_bucketed(t.interactions, f"{root}/interactions", "doc_id", 4, ["pdate"])
    bucketed.write_bucketed(t.doc_dim, f"{root}/doc_dim", "doc_id", 4, ["pdate"])
    return root


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_facts_and_documents_meet_without_an_exchange(spark, laid):
    facts, docs = bucketed.read_together(spark, f"{laid}/interactions", f"{laid}/doc_dim")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = geo.doc_impressions(facts, AS_OF, ALL_DAYS).join(docs.select("doc_id", "channels"), "doc_id")
        plan = _plan(joined)
        assert "Exchange" not in plan and "Join" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        lists = geo.geo_top_docs(geo.doc_impressions(facts, AS_OF, ALL_DAYS), docs, "channel", AS_OF, min_check=1)
        fact_join = [line for line in _plan(lists).split("\n") if "Exchange" in line and "list_key" not in line and "base_key" not in line]
        assert not fact_join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_days_are_pruned_and_rows_kept(spark, laid):
    plain = load(spark, TESTDATA).interactions
    facts = bucketed.read_bucketed(spark, f"{laid}/interactions")
    assert sorted(map(repr, facts.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    day = facts.where(F.col("pdate") == F.lit(date(2024, 1, 30)))
    assert "PartitionFilters: [isnotnull(pdate" in _plan(day).replace("\n", " ")
    assert day.count() == plain.where(F.col("pdate") == F.lit(date(2024, 1, 30))).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("feedloom_")]


def test_tables_dealt_differently_are_refused(spark, laid, tmp_path):
    docs = load(spark, TESTDATA).doc_dim
    bucketed.write_bucketed(docs, str(tmp_path / "docs"), "doc_id", 5)
    with pytest.raises(ValueError, match="dealt differently"):
        bucketed.read_together(spark, f"{laid}/interactions", str(tmp_path / "docs"))
    with pytest.raises(ValueError, match="already"):
        bucketed.write_bucketed(docs, str(tmp_path / "docs"), "doc_id", 4)
    with pytest.raises(ValueError, match="0 layouts"):
        bucketed.read_bucketed(spark, str(tmp_path / "nothing"))


def test_a_failed_write_is_no_layout(spark, tmp_path):
    broken = spark.range(10).select(F.col("id").alias("doc_id"), F.raise_error(F.lit("lost")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        bucketed.write_bucketed(broken, str(tmp_path / "docs"), "doc_id", 4)
    assert bucketed.layouts(spark, str(tmp_path / "docs")) == []
    assert not [n for n in commits.names(spark, str(tmp_path / "docs")) if not n.startswith("_attempt")]


def test_jobs_read_layouts(spark, laid, tmp_path):
    found = []
    plain = load(spark, TESTDATA)
    for name in ("interactions", "doc_dim"):
        getattr(plain, name).write.partitionBy("pdate").parquet(str(tmp_path / "plain" / name))
    jobs.bucket_tables(jobs.Run(spark, str(tmp_path / "plain"), str(tmp_path / "laid"), datetime(2024, 1, 31)), buckets=3)
    kinds = dict.fromkeys(("interactions", "doc_dim"), "bucketed")
    for tables, formats in ((tmp_path / "plain", {}), (tmp_path / "laid", kinds)):
        run = jobs.Run(spark, str(tables), str(tmp_path / f"out{len(found)}"), datetime(2024, 1, 31), formats)
        jobs.geo_top_docs(run, min_check=1, min_rows=1)
        found.append(sorted(map(repr, spark.read.parquet(run.path("geo_top_docs/kv")).collect())))
    assert found[0] and found[0] == found[1]
