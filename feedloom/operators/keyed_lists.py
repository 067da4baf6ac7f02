"""Keyed lists: folding ranked rows, merging variants, gating and publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import stripped
from feedloom.operators.ranking import spread_rank, top_k

# Text of a NULL field in a landed row file, list separator,
# seconds a list and a hash stay valid.
NULL_FIELD = "\\N"
SEPARATOR = "#"
LIST_TTL_SEC = 86400
HASH_TTL_SEC = 3600 * 24 * 30 * 6
#: Elements a part of a list without a cap holds at most.
PART_SIZE = 1000


def part_address(name: Column, part: Column, n_parts: Column) -> Column:
    """``name#part/n_parts``: where a reader finds a part, and how many there are."""
    return F.concat(name, F.lit("#"), part.cast("string"), F.lit("/"), n_parts.cast("string"))


def kv_fold(
    rows: DataFrame,
    key: Column,
    item: Column,
    order: Sequence[Column],
    max_size: int,
    separator: str = SEPARATOR,
) -> DataFrame:
    """(key, size, value): the first ``max_size`` items of a key joined in ``order``.

    ``order`` is ascending (negate a number to descend) and total. Rows are cut
    per key before they are shuffled.
    """
    keyed, names = _keyed(rows, key, item, order)
    keyed = top_k(keyed, ["key"], [F.col(name) for name in names], max_size)
    return (
        keyed.groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct(*names, "item"))).alias("items"))
        .select(
            "key",
            F.size("items").alias("size"),
            F.array_join("items.item", separator).alias("value"),
        )
    )


def kv_parts(
    rows: DataFrame,
    key: Column,
    item: Column,
    order: Sequence[Column],
    part_size: int = PART_SIZE,
    separator: str = SEPARATOR,
) -> DataFrame:
    """(key, part, n_parts, size, value): all items of a key in ``order``, in parts.

    Items are numbered slice by slice, so no task holds a whole key. A short
    list is part 0 of 1. The rows are written while the plan is built.
    """
    keyed, names = _keyed(rows, key, item, order)
    ranked = spread_rank(keyed, ["key"], [F.col(name) for name in names], "rk", label="kv-parts")
    return (
        _parted(ranked, "key", part_size)
        .groupBy("key", "part", "n_parts")
        .agg(F.sort_array(F.collect_list(F.struct("rk", "item"))).alias("items"))
        .select(
            "key",
            "part",
            "n_parts",
            F.size("items").alias("size"),
            F.array_join("items.item", separator).alias("value"),
        )
    )


def _keyed(
    rows: DataFrame, key: Column, item: Column, order: Sequence[Column]
) -> tuple[DataFrame, list[str]]:
    names = [f"o{i}" for i in range(len(order))]
    keyed = rows.select(
        key.alias("key"),
        *[c.alias(name) for name, c in zip(names, order)],
        F.coalesce(item, F.lit(NULL_FIELD)).alias("item"),
    )
    return keyed, names


def _parted(ranked: DataFrame, key: str, part_size: int) -> DataFrame:
    """Adds the part of each ranked row (``rk``) and the number of parts of its key."""
    sizes = ranked.groupBy(F.col(key).alias("_sized")).agg(F.max("rk").alias("_n"))
    return (
        ranked.join(sizes, F.col(key).eqNullSafe(F.col("_sized")))
        .withColumn("part", F.floor((F.col("rk") - 1) / F.lit(part_size)).cast("long"))
        .withColumn("n_parts", F.ceil(F.col("_n") / F.lit(part_size)).cast("long"))
        .drop("_sized", "_n")
    )


def kv_size_stats(kv: DataFrame) -> DataFrame:
    """One row: number of keys, total, largest list and its first key, mean size."""
    return kv.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"),
        F.coalesce(F.max("size"), F.lit(0)).cast("long").alias("max_size"),
        F.min_by("key", F.struct(-F.col("size"), F.col("key"))).alias("max_key"),
        F.avg("size").alias("avg_size"),
    )


def merge_variants(variants: Sequence[DataFrame]) -> DataFrame:
    """One key space from variants in run order: the later variant wins a key."""
    tagged = [kv.select("key", "value", F.lit(i).alias("turn")) for i, kv in enumerate(variants)]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("key")
        .agg(F.max_by("value", "turn").alias("value"))
    )


def gate_measures() -> dict[str, Column]:
    """What the publish gate wants to know of a result, as aggregates."""
    return {"result_rows": F.count(F.lit(1))}


def passes(measured: Mapping[str, int], min_rows: int = 100) -> bool:
    """The gate on measures taken while the result was written."""
    return measured["result_rows"] >= min_rows


def publish_gate(lists: DataFrame, name: str, min_rows: int = 100) -> DataFrame:
    """(list_name, result_rows, publish): a short result must not be published."""
    return lists.agg(*[column.alias(c) for c, column in gate_measures().items()]).select(
        F.lit(name).alias("list_name"),
        "result_rows",
        (F.col("result_rows") >= min_rows).alias("publish"),
    )


def kv_publish(kv: DataFrame, prefix: str, ttl_sec: int = LIST_TTL_SEC) -> DataFrame:
    """(key, value, ttl_sec) ready for a key/value store.

    A row travels as a line ``key <tab> value`` without white space at its ends;
    one that is not two fields then (an empty value, a tab inside) is not
    written. Parts have their address in the key.
    """
    name = F.col("key")
    if "part" in kv.columns:
        name = part_address(name, F.col("part"), F.col("n_parts"))
    fields = F.split(stripped(F.concat(name, F.lit("\t"), "value")), "\t")
    return kv.select(fields.alias("fields")).where(F.size("fields") == 2).select(
        F.concat(F.lit(prefix + "@"), F.col("fields")[0]).alias("key"),
        F.col("fields")[1].alias("value"),
        F.lit(ttl_sec).alias("ttl_sec"),
    )


def hash_publish(
    ranked: DataFrame,
    hash_key: str | Column,
    field: str,
    element: Column,
    rank: str = "rk",
    part_size: int = PART_SIZE,
    ttl_sec: int = HASH_TTL_SEC,
) -> DataFrame:
    """(key, field, value, ttl_sec): a JSON array per part of a field's list.

    The published field is ``name#part/n_parts`` for a list of any length, so no
    part overwrites another and a reader knows how many there are. Empty lists
    have no row. ``hash_key`` may be a column: several hashes at once.
    """
    key = F.lit(hash_key) if isinstance(hash_key, str) else hash_key
    rows = ranked.select(
        F.struct(key.alias("key"), F.col(field).alias("field")).alias("list"),
        F.col(rank).cast("long").alias("rk"),
        element.alias("element"),
    )
    return (
        _parted(rows, "list", part_size)
        .groupBy("list", "part", "n_parts")
        .agg(F.sort_array(F.collect_list(F.struct("rk", "element"))).alias("items"))
        .select(
            "list.key",
            part_address(F.col("list.field"), F.col("part"), F.col("n_parts")).alias("field"),
            F.to_json("items.element").alias("value"),
            F.lit(ttl_sec).alias("ttl_sec"),
        )
    )
