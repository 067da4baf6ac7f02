"""Ranks and caps, with one key holding a third of the rows and more."""

from pyspark.sql import functions as F

from feedloom.operators import keyed_lists as lists
from feedloom.operators.ranking import ordered_cap, spread_rank, top_k


def _skewed(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
    return spark.range(n).select(
        key.alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"),
        F.format_string("d%05d", "id").alias("doc"),
    )


def _expected(rows):
    by_key = {}
    for row in rows:
        by_key.setdefault(row["key"], []).append(row)
    ranks = {}
    for key, members in by_key.items():
        members.sort(key=lambda r: (-r["score"], r["doc"]))
        ranks.update({(key, r["doc"]): i for i, r in enumerate(members, 1)})
    return ranks


def _order():
    return [F.col("score").desc(), F.col("doc")]


def test_spread_rank_numbers_every_row_of_a_hot_key(spark):
    df = _skewed(spark)
    ranked = spread_rank(df, ["key"], _order())
    actual = {(r["key"], r["doc"]): r["rk"] for r in ranked.collect()}
    assert actual == _expected(df.collect())


def test_spread_rank_splits_the_hot_key(spark):
    from feedloom.operators.ranking import _ordered_slices

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices = _ordered_slices(_skewed(spark), [F.col("key"), *_order()], "test")
        assert slices.where("key = 'hot'").select("_slice").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_spread_rank_keeps_a_null_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 1, "c")], "key string, score int, doc string")
    ranked = {(r["key"], r["doc"]): r["rk"] for r in spread_rank(df, ["key"], _order()).collect()}
    assert ranked == {(None, "b"): 1, (None, "a"): 2, ("x", "c"): 1}


def test_top_k_past_the_window_limit_is_the_same(spark):
    df = _skewed(spark)
    short = {(r["key"], r["doc"], r["rk"]) for r in top_k(df, ["key"], _order(), 30).collect()}
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        long = {(r["key"], r["doc"], r["rk"]) for r in top_k(df, ["key"], _order(), 30).collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert short == long
    assert short == {(k, d, i) for (k, d), i in _expected(df.collect()).items() if i <= 30}


def test_ordered_cap_cuts_exactly(spark):
    df = _skewed(spark)
    order = [F.col("key"), *_order()]
    everything = [r["doc"] for r in df.orderBy(*order).collect()]
    for limit in (1, 777, 2999, 3000, 5000):
        assert [r["doc"] for r in ordered_cap(df, order, limit).collect()] == everything[:limit]
    assert [r["doc"] for r in ordered_cap(df, order, None).collect()] == everything


def test_fold_keeps_order_and_cap(spark):
    df = _skewed(spark)
    kv = {
        r["key"]: (r["size"], r["value"].split("#"))
        for r in lists.kv_fold(df, F.col("key"), F.col("doc"), [-F.col("score"), F.col("doc")], 19).collect()
    }
    ranks = _expected(df.collect())
    for key, (size, docs) in kv.items():
        assert size == len(docs) <= 19
        assert [ranks[key, d] for d in docs] == list(range(1, size + 1))


def test_uncapped_fold_keeps_everything_and_writes_null_as_text(spark):
    df = spark.createDataFrame([("k", 0.5, None), ("k", 0.9, "b"), ("k", 0.5, "a")], "key string, ctr double, pid string")
    order = [-F.col("ctr"), F.col("pid")]
    row = lists.kv_parts(df, F.col("key"), F.col("pid"), order).first()
    assert tuple(row) == ("k", 0, 1, 3, "b#\\N#a")
    parts = lists.kv_parts(df, F.col("key"), F.col("pid"), order, part_size=2)
    assert sorted(map(tuple, parts.collect())) == [("k", 0, 2, 2, "b#\\N"), ("k", 1, 2, 1, "a")]
    published = sorted(r["key"] for r in lists.kv_publish(parts, "p").collect())
    assert published == ["p@k#0/2", "p@k#1/2"]


def test_size_stats(spark):
    kv = spark.createDataFrame([("b", 3, "x"), ("a", 3, "x"), ("c", 1, "x")], "key string, size int, value string")
    assert tuple(lists.kv_size_stats(kv).first()) == (3, 7, 3, "a", 7 / 3)
    assert tuple(lists.kv_size_stats(kv.where("false")).first()) == (0, 0, 0, None, None)


def test_later_variant_wins_a_key(spark, rows_of):
    first = spark.createDataFrame([("a", "1"), ("b", "1")], "key string, value string")
    second = spark.createDataFrame([("b", "2"), ("c", "2")], "key string, value string")
    merged = lists.merge_variants([first, second])
    assert rows_of(merged, "key", "value") == [("a", "1"), ("b", "2"), ("c", "2")]


def test_gate_and_publish(spark, rows_of):
    kv = spark.createDataFrame([("a", "x"), ("b", ""), ("\t", "y"), ("c", None)], "key string, value string")
    assert rows_of(lists.publish_gate(kv, "l", 4)) == [("l", 4, True)]
    assert rows_of(lists.publish_gate(kv, "l", 5)) == [("l", 4, False)]
    assert rows_of(lists.kv_publish(kv, "p")) == [("p@a", "x", 86400)]
    odd = spark.createDataFrame([(" a", "x \t"), ("b", "x\ty"), ("c\td", "x")], "key string, value string")
    assert rows_of(lists.kv_publish(odd, "p")) == [("p@a", "x", 86400)]


def test_long_hash_lists_come_in_parts(spark):
    ranked = spread_rank(_skewed(spark), ["key"], _order())
    parts = lists.hash_publish(ranked, "h", "key", F.struct("doc"), part_size=100).collect()
    import json

    whole = {}
    assert len({(r["key"], r["field"]) for r in parts}) == len(parts)
    address = lambda row: (row["field"].split("#")[0], *map(int, row["field"].split("#")[1].split("/")))
    for row in sorted(parts, key=address):
        docs = [e["doc"] for e in json.loads(row["value"])]
        assert len(docs) <= 100
        whole.setdefault(address(row)[0], []).extend(docs)
    assert all(n == -(-len(whole[k]) // 100) for k, _, n in map(address, parts))
    ranks = _expected(_skewed(spark).collect())
    assert {(k, d): i for k, docs in whole.items() for i, d in enumerate(docs, 1)} == ranks
