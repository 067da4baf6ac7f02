"""The same results when nothing is broadcast and every partition counts as skewed."""

import pytest

from conftest import TESTDATA
from feedloom.catalog import ORACLE_SQL, QUERIES
from test_oracle import _normal

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
    "spark.sql.files.maxPartitionBytes": "20000",
}
NAMES = (
    "cross_geo_channel", "geo_top_docs_kv", "hash_publish", "hot_tab_docs", "crawl_rows",
    "review_enqueue", "review_labeled", "review_7d_unique_status", "user_history", "timeliness_lookup",
)


@pytest.fixture
def shuffled(spark):
    before = {key: spark.conf.get(key, None) for key in FORCED}
    for key, value in FORCED.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_shuffled_and_split(shuffled, duck, name):
    frame = QUERIES[name](shuffled, TESTDATA)
    rows = [tuple(r) for r in frame.collect()]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    relation = duck.sql(ORACLE_SQL[name])
    assert _normal(frame.columns, rows) == _normal(relation.columns, relation.fetchall())


def test_a_hot_document_is_split_in_the_join(shuffled):
    from pyspark.sql import functions as F

    from feedloom.plans import review

    hot = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 500).cast("string"))
    lines = shuffled.range(0, 60_000, 1, 8).select(
        F.col("id").alias("line_no"),
        F.to_date(F.lit("2024-01-01")).alias("day"),
        F.lit("online").alias("arm"),
        F.lit(10).alias("width"),
        hot.alias("docid"),
    )
    reviews = shuffled.range(500).select(
        F.concat(F.col("id").cast("string"), F.lit("_from_foryou")).alias("_id"),
        F.struct(F.lit("ok").alias("status"), F.lit("r").alias("reason"), F.lit("e").alias("editor")).alias("review"),
    )
    found = review.review_lookup(lines, reviews)
    assert len(found.collect()) == 60_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_heavy_reader_parts_are_grouped_by_user_and_part(spark):
    plan = QUERIES["user_history"](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "REPARTITION_BY_COL" in plan
