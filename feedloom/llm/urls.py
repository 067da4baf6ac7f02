"""URL filters by a sort-merge range join.

A host is written as its labels in reverse, each ended by a dot
(``com.example.``), and a rule for a host and its subdomains is the interval of
keys that begin with it. Intervals of prefixes nest, so a sweep over sorted keys
needs one open rule per depth: for every depth the running ``last`` of the rules
of that depth is the stack, and an entry is active while the key lies in its
interval. The sweep runs twice, first over distinct hosts against the hosts of rules,
then over distinct (rule host, path) keys against the rules' paths. Each sweep is
range partitioned; what the partitions before left on the stack is carried in
through a table with one row per partition. Everything is DataFrame operations.

The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; the path follows up to ``?``, ``#`` or the end. A null url,
or one without ``://``, has an empty host and path; it, and a url that no rule
fits, has a null rule and the default verdict. Of the rules that fit, the longest
host and path together wins, then the longer host, then the lesser rule text;
rules with a null host, path or verdict are left out, repeated ones count once
(with two verdicts, ``block``). Repeated pages are judged alike. Hosts are
compared label by label; empty labels count as labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.staging import stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels in reverse, a dot after each."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _running(rows: DataFrame, order: list[str], made: dict[str, Column], label: str) -> DataFrame:
    """Columns of running ``last`` values (nulls skipped) over all rows in ``order``.

    Every range partition runs on its own; the last values before it come from
    a table with a row per partition.
    """
    ranged = stage(
        rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), label
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    own = ranged.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(n) for n, c in made.items()])
    place = F.struct(*order)
    ends = ranged.groupBy("_slice").agg(
        *[
            F.max(F.when(c.isNotNull(), F.struct(place.alias("at"), c.alias("value"))))["value"].alias(f"_end_{n}")
            for n, c in made.items()
        ]
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_slice").alias("_at"),
        *[F.last(f"_end_{n}", ignorenulls=True).over(before).alias(f"_in_{n}") for n in made],
    )
    joined = own.join(F.broadcast(carried), F.col("_slice") == F.col("_at"))
    keep = [c for c in ranged.columns if c != "_slice"]
    return joined.select(*keep, *[F.coalesce(n, f"_in_{n}").alias(n) for n in made])


def _nesting(rules: DataFrame) -> DataFrame:
    """``depth`` of every distinct prefix among the prefixes: how many others begin it.

    A prefix of ``n`` characters can only lie in those that are its own
    beginnings, so its beginnings are looked up by an equi-join.
    """
    starts = rules.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n"))
    parents = starts.select("key", F.substring("key", F.lit(1), F.col("n")).alias("parent"))
    known = rules.select(F.col("key").alias("parent"))
    return parents.join(known, "parent", "left_semi").groupBy("key").agg((F.count("*") - 1).alias("depth"))


def sweep(points: DataFrame, prefixes: DataFrame, label: str) -> DataFrame:
    """Every point's ``key`` with ``active``: the prefixes it begins with, outermost first.

    ``points`` and ``prefixes`` have one row per distinct ``key``. The stack has
    as many places as prefixes nest, which their table says before the sweep.
    """
    nested = stage(_nesting(prefixes), f"{label}-rules")
    depth = nested.agg(F.max("depth")).first()[0]
    if depth is None:
        return points.select("key", F.array().cast("array<string>").alias("active"))
    events = nested.select("key", F.lit(0).alias("kind"), "depth").unionByName(
        points.select("key", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("depth"))
    )
    made = {f"_d{d}": F.when(F.col("depth") == d, F.col("key")) for d in range(depth + 1)}
    swept = _running(events, ["key", "kind"], made, f"{label}-sweep")
    # Beginning with a prefix is lying in its interval; what is closed is not a beginning.
    stack = F.array(*[F.col(c) for c in made])
    return swept.where("kind = 1").select(
        "key", F.filter(stack, lambda p: p.isNotNull() & F.startswith(F.col("key"), p)).alias("active")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT,
) -> DataFrame:
    """Id, host, path, rule and verdict of every page.

    ``rules`` has the columns host, path (with its leading slash) and verdict.
    """
    cut = pages.select(
        F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path")
    ).withColumn("_key", host_key(F.col("_host")))
    known = (
        rules.select(F.translate("host", _UPPER, _UPPER.lower()).alias("host"), "path", "verdict")
        .na.drop()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            host_key(F.col("host")).alias("rule_key"), "path",
            F.concat("host", "path").alias("rule"), F.length("host").alias("host_size"), "verdict",
        )
    )
    hosts = sweep(
        cut.select(F.col("_key").alias("key")).distinct(),
        known.select(F.col("rule_key").alias("key")).distinct(),
        "hosts",
    )
    wanted = cut.select("_key", "_path").distinct()
    pairs = wanted.join(hosts.where(F.size("active") > 0), F.col("_key") == F.col("key")).select(
        "_key", "_path", F.explode("active").alias("rule_key")
    )
    # No host has a slash, so it can part the host of a key from its path.
    path_key = lambda path: F.concat("rule_key", F.lit("/"), path)
    paths = sweep(
        pairs.select(path_key(F.col("_path")).alias("key")).distinct(),
        known.select(path_key(F.col("path")).alias("key")).distinct(),
        "paths",
    )
    hits = paths.select("key", F.explode("active").alias("prefix")).join(
        known.withColumn("prefix", path_key(F.col("path"))), "prefix"
    )
    best = (
        pairs.withColumn("key", path_key(F.col("_path")))
        .join(hits.select("key", "rule", "host_size", "verdict"), "key")
        .groupBy("_key", "_path")
        .agg(
            F.min(
                F.struct((-F.length("rule")).alias("a"), (-F.col("host_size")).alias("b"), "rule", "verdict")
            ).alias("best")
        )
        .select(F.col("_key").alias("_k"), F.col("_path").alias("_p"), "best.rule", "best.verdict")
    )
    return cut.join(best, (F.col("_key") == F.col("_k")) & (F.col("_path") == F.col("_p")), "left").select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
