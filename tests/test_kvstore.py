"""The store under failing, repeated and later writes."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom import kvstore


def rows(spark, pairs, ttl=100):
    data = [(k, f, v, ttl) for k, f, v in pairs]
    return spark.createDataFrame(data, "key string, field string, value string, ttl_sec int")


def alive(spark, path, as_of, wanted=None):
    return {(r["key"], r["field"]): r["value"] for r in kvstore.read(spark, path, as_of, wanted).collect()}


def test_the_last_batch_wins_and_values_expire(spark, tmp_path):
    store = str(tmp_path / "store")
    assert alive(spark, store, 0) == {}
    kvstore.publish(rows(spark, [("a", None, "1"), ("h", "x", "2"), ("h", "y", "3")]), store, 1000)
    kvstore.publish(rows(spark, [("a", None, "4"), ("h", "y", "5")], ttl=10), store, 1050)
    assert alive(spark, store, 1055) == {("a", None): "4", ("h", "x"): "2", ("h", "y"): "5"}
    # The later value has expired; the earlier one does not come back.
    assert alive(spark, store, 1060) == {("h", "x"): "2"}
    assert alive(spark, store, 1100) == {}
    assert alive(spark, store, 1055, F.col("key") == "h") == {("h", "x"): "2", ("h", "y"): "5"}
    kvstore.publish(rows(spark, []), store, 1050)
    kvstore.compact(spark, store, 1055)
    assert alive(spark, store, 1055) == {("a", None): "4", ("h", "x"): "2", ("h", "y"): "5"}
    assert kvstore.vacuum(store) > 0
    assert alive(spark, store, 1055) == {("a", None): "4", ("h", "x"): "2", ("h", "y"): "5"}


def test_a_failed_batch_leaves_nothing_to_read(spark, tmp_path):
    store = str(tmp_path / "store")
    kvstore.publish(rows(spark, [("a", None, "1")]), store, 0)
    lost = spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") == 777, F.raise_error(F.lit("lost")).cast("string")).otherwise("v").alias("value"),
        F.lit(9).alias("ttl_sec"),
    )
    with pytest.raises(Exception, match="lost"):
        kvstore.publish(lost, store, 0)
    assert alive(spark, store, 1) == {("a", None): "1"}


def test_a_task_that_runs_twice_leaves_each_key_once(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = pa.schema([("key", pa.string()), ("field", pa.string()), ("value", pa.string()), ("expires_at", pa.int64())])

    def batch(keys):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.string()), pa.array(["v"] * len(keys)), pa.array([9] * len(keys))], schema=schema)

    def failing():
        yield batch(["a", "b"])
        raise OSError("lost")

    writer = kvstore.SegmentWriter(store)
    with pytest.raises(OSError):
        writer.write(failing())
    writer.write(iter([batch(["a", "b"]), batch(["c"])]))  # its executor is lost before it can tell
    again = writer.write(iter([batch(["a", "b"]), batch(["c"])]))
    other = writer.write(iter([batch(["d"])]))
    none = writer.write(iter([]))
    assert (again.rows, other.rows, none.name) == (3, 1, None)
    assert kvstore.read(spark, store, 0).count() == 0
    writer.commit([again, other, none])
    found = kvstore.read(spark, store, 0)
    assert sorted(r["key"] for r in found.collect()) == ["a", "b", "c", "d"]
    gone = writer.write(iter([batch(["e"])]))
    writer.abort([gone, None, none])
    assert kvstore.vacuum(store) == 2  # the two attempts that no batch names
    assert kvstore.read(spark, store, 0).count() == 4


def test_segments_are_sorted_and_pruned(spark, tmp_path):
    import pyarrow.parquet as pq

    store = str(tmp_path / "store")
    many = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("v").alias("value"), F.lit(9).alias("ttl_sec"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kvstore.publish(many, store, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    segments = [pq.read_table(p).column("key").to_pylist() for p in (tmp_path / "store/segments").iterdir()]
    assert len(segments) > 1 and all(keys == sorted(keys) for keys in segments)
    spans = sorted((keys[0], keys[-1]) for keys in segments)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    one = kvstore.read(spark, store, 0, F.col("key") == "k77")
    assert "PushedFilters: [IsNotNull(key), EqualTo(key,k77)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_other_columns_and_overwriting_are_refused(spark, tmp_path):
    spark.dataSource.register(kvstore.StoreSource)
    odd = spark.createDataFrame([("a", "1")], "key string, value string")
    with pytest.raises(Exception, match="columns of a batch"):
        odd.write.format(kvstore.FORMAT).mode("append").save(str(tmp_path / "store"))
    with pytest.raises(Exception, match="a later one replaces"):
        odd.write.format(kvstore.FORMAT).mode("overwrite").save(str(tmp_path / "store"))
