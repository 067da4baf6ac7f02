"""Every registered query against its SQL on the smallest test tables."""

import pytest

from conftest import TESTDATA
from feedloom.catalog import ORACLE_SQL, QUERIES

# No query leaves the JVM or pairs everything with everything.
NEVER = (
    "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin",
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, TESTDATA)
    relation = duck.sql(ORACLE_SQL[name])
    assert {c: TYPES[t] for c, t in frame.dtypes} == dict(zip(relation.columns, map(str, relation.types)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in NEVER if node in plan]
    actual = _normal(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual == _normal(relation.columns, relation.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_time_zone_does_not_change_results(spark):
    names = ("geo_new_docs_channel", "user_history", "hot_tab_docs_fresh", "tab_metric_points", "review_payload")
    expected = {n: sorted(map(repr, QUERIES[n](spark, TESTDATA).collect())) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for n in names:
            assert sorted(map(repr, QUERIES[n](spark, TESTDATA).collect())) == expected[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
