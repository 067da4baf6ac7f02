"""Connected components of a table of links, by alternating stars.

Every round hangs all larger neighbours of a node, then all smaller ones, under
the least neighbour; both are a map-side combined minimum and a join. Rounds end
when the table no longer changes, after a number that grows with the logarithm of
the largest component. Each round is written to the shared folder, no link
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.staging import stage


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame, label: str) -> DataFrame:
    """``id`` and ``component``, the least id reachable, of every id in the links ``a``, ``b``.

    Null ends are left out; a link of an id with itself makes it a component.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = stage(ends.distinct(), f"{label}-links")
    stars = links.where("a > b")
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        under = _least(large)
        small = large.join(under, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        stars = stage(small.unionByName(under.select("a", F.col("m").alias("b"))).distinct(), f"{label}-stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    members = stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("id"), F.col("b").alias("component"))
    alone = links.where("a = b").select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(roots).unionByName(alone).groupBy("id").agg(F.min("component").alias("component"))


class Forest:
    """Union-find over the rows of one task, to hand on a few links for many."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in self.parent if self.find(x) != x]
