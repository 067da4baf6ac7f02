"""What the optimizer makes of the plans."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from feedloom.catalog import QUERIES
from feedloom.plans import geo
from feedloom.sources.files import with_int_flags
from feedloom.sources.testdata import load

PRUNED_LISTS = ("geo_new_docs_channel", "local_top_comments", "nonlocal_top_likes", "geo_top_docs_kv")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PRUNED_LISTS)
def test_lists_are_cut_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, TESTDATA))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_samples_are_taken_as_top_n(spark):
    for name in ("user_sample", "user_sample_hashed", "assess_dedupe"):
        assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, TESTDATA))


def test_fact_scan_is_pruned_and_narrow(spark, tmp_path):
    t = load(spark, TESTDATA)
    t.interactions.write.partitionBy("pdate").parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    plan = _plan(geo.doc_impressions(facts, date(2024, 1, 31)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(pdate" in scan and "2024-01-28" in scan
    for pushed in ("EqualTo(joined,1)", "EqualTo(checked,1)", "In(channel_name", "StringContains(nr_condition,local)"):
        assert pushed in spark_scan(spark, facts), pushed
    assert "user_id" not in scan and "cv_time" not in scan


def spark_scan(spark, facts):
    """The scan line in full: plan strings are cut to a maximum of characters."""
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        return _plan(geo.doc_impressions(facts, date(2024, 1, 31)))
    finally:
        spark.conf.set(key, before)


def test_top_docs_reads_the_fact_once(spark):
    t = load(spark, TESTDATA)
    per_doc = geo.doc_impressions(t.interactions, date(2024, 1, 31), 30)
    df = geo.geo_top_docs(per_doc, t.doc_dim, "channel", date(2024, 1, 31), min_check=1, max_rows=None)
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("events.parquet") == 1


@pytest.mark.parametrize("kind", ["int", "boolean"])
def test_flags_are_pushed_into_the_scan(spark, tmp_path, kind):
    flags = {f: F.col(f).cast(kind) for f in ("joined", "checked")}
    load(spark, TESTDATA).interactions.withColumns(flags).write.partitionBy("pdate").parquet(str(tmp_path / "facts"))
    facts = with_int_flags(spark.read.parquet(str(tmp_path / "facts")))
    value = "1" if kind == "int" else "true"
    pushed = spark_scan(spark, facts)
    for name in ("joined", "checked"):
        assert f"EqualTo({name},{value})" in pushed, pushed


@pytest.mark.parametrize("name", ["hash_publish", "tab_metric_points"])
def test_one_pass_over_the_fact(spark, name):
    frame = QUERIES[name](spark, TESTDATA)
    frame.collect()
    assert _plan(frame).split("Initial Plan")[0].count("events.parquet") == 1


def test_metric_points_read_written_tables_only(spark):
    plan = _plan(QUERIES["review_metric_points"](spark, TESTDATA))
    assert "events.parquet" not in plan and "labels.parquet" not in plan
