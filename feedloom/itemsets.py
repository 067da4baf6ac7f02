"""Sets of items per owner that take a day at a time.

A day's items are landed as a delta, in buckets of (owner, slot of the item): an owner
with very many items lies in up to ``spread`` buckets, any other owner's few items in as
many buckets as there are items at most. A delta writes what the day holds and nothing
else. ``fold`` merges deltas into new base files of those buckets that they touch; each
item keeps the last day that it was seen on, so that items leave a trailing window when
that day does.

A day appears by one rename and may be landed again, in place of what it was, until it is
folded; then it is closed. Readers join base and open deltas by (owner, item).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import commits

_BUCKET, _THROUGH = "_bucket", "_through"
#: Marks a bucket whose items have all left the window; readers pass over it.
_GONE = "_gone-"


class ClosedDay(ValueError):
    """The day has been folded into the base and can't be replaced."""


class ItemSets:
    def __init__(self, spark: SparkSession, path: str, owner: str, item: str = "item", buckets: int = 64, spread: int = 16):
        """``buckets`` and ``spread`` hold for a new folder; an old one keeps those it was made with."""
        self.spark, self.path, self.owner, self.item = spark, path.rstrip("/"), owner, item
        made = next(iter(commits.numbered(spark, self.path, "dealt")), f"{buckets}x{spread}")
        self.buckets, self.spread = map(int, made.split("x"))
        self.root = f"{self.path}/dealt={made}"

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(self.item), F.lit(self.spread))
        bucket = F.pmod(F.xxhash64(F.col(self.owner), slot), F.lit(self.buckets))
        return rows.withColumn(_BUCKET, bucket.cast("int"))

    def _held(self, folder: str) -> set[int]:
        return set(map(int, commits.numbered(self.spark, folder, _BUCKET)))

    def _bases(self) -> dict[int, tuple[int, date]]:
        """For each bucket that has a base its folder's number and the last day in it."""
        found: dict[int, tuple[int, date]] = {}
        for number in sorted(map(int, commits.numbered(self.spark, self.root, "base"))):
            for day in commits.numbered(self.spark, f"{self.root}/base={number}", _THROUGH):
                folder = f"{self.root}/base={number}/{_THROUGH}={day}"
                emptied = {int(n.removeprefix(_GONE)) for n in commits.names(self.spark, folder) if n.startswith(_GONE)}
                found.update(dict.fromkeys(self._held(folder) | emptied, (number, date.fromisoformat(day))))
        return found

    def _deltas(self) -> dict[date, set[int]]:
        days = commits.numbered(self.spark, self.root, "day")
        return {date.fromisoformat(d): self._held(f"{self.root}/{name}") for d, name in sorted(days.items())}

    def closed(self) -> date | None:
        """The last day that is folded; it and all before it are closed."""
        return max((day for _, day in self._bases().values()), default=None)

    def days(self) -> list[date]:
        """Days that are landed and not vacuumed."""
        return sorted(map(date.fromisoformat, commits.numbered(self.spark, self.root, "day")))

    def open_days(self, days: Iterable[date]) -> list[date]:
        closed, landed = self.closed(), set(self.days())
        return [d for d in days if d not in landed and (closed is None or d > closed)]

    def put(self, rows: DataFrame, days: Iterable[date]) -> None:
        """Land the items (owner, item, day) of some days, read in one pass.

        A day of ``days`` without rows is landed as an empty one. Rows of other days
        are left out. Each day appears as a whole; where the job fails between two
        days, the later ones stay open.
        """
        days = sorted(set(days))
        closed = self.closed()
        if closed is not None and days and days[0] <= closed:
            raise ClosedDay(f"{days[0]} is folded into {self.root}")
        wanted = rows.where(F.col("day").isin(days)).where(F.col(self.owner).isNotNull() & F.col(self.item).isNotNull())
        dealt = self._bucketed(wanted.select(self.owner, self.item, "day").distinct())
        written = commits.attempt(
            dealt.hint("rebalance", "day", _BUCKET).sortWithinPartitions("day", _BUCKET, self.owner, self.item),
            self.root, ["day", _BUCKET],
        )
        for day in days:
            name = f"day={day.isoformat()}"
            commits.swap(self.spark, f"{written}/{name}", f"{self.root}/{name}")
        commits.remove(self.spark, written)

    def _live(self, bases: dict[int, tuple[int, date]], deltas: dict[date, set[int]]) -> dict[date, set[int]]:
        """The buckets of each delta that their base does not hold yet."""
        return {d: {b for b in held if b not in bases or d > bases[b][1]} for d, held in deltas.items()}

    def _paths(self, folder: str, live: set[int], held: set[int]) -> list[str]:
        return [folder] if live and live == held else [f"{folder}/{_BUCKET}={b}" for b in sorted(live)]

    def _rows(self, bases: dict[int, tuple[int, date]], live: dict[date, set[int]]) -> DataFrame | None:
        """Rows (owner, item, day, bucket) of base files and deltas, as they lie."""
        columns = [self.owner, self.item, F.col("day").cast("date").alias("day"), _BUCKET]
        of: dict[tuple[int, date], set[int]] = {}
        for bucket, base in bases.items():
            of.setdefault(base, set()).add(bucket)
        based, fresh = [], []
        for (number, day), wanted in sorted(of.items()):
            folder = f"{self.root}/base={number}/{_THROUGH}={day.isoformat()}"
            held = self._held(folder)
            based += self._paths(folder, wanted & held, held)
        for day, wanted in sorted(live.items()):
            if wanted:
                folder = f"{self.root}/day={day.isoformat()}"
                fresh += self._paths(folder, wanted, self._held(folder))
        read = self.spark.read.option("basePath", self.root)
        frames = [read.parquet(*paths).select(*columns) for paths in (based, fresh) if paths]
        return frames[0].unionByName(frames[1]) if len(frames) == 2 else next(iter(frames), None)

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(_BUCKET, self.owner, self.item).agg(F.max("day").alias("day"))

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame | None:
        """Distinct (owner, item, day) from ``first`` to ``last``: the last day an item was seen on.

        None where nothing is landed. Days that are folded can't be taken out again, so
        a ``last`` before them is refused.
        """
        closed = self.closed()
        if last is not None and closed is not None and last < closed:
            raise ClosedDay(f"days up to {closed} are folded into {self.root}")
        bases = self._bases()
        live = self._live(bases, self._deltas())
        rows = self._rows(bases, {d: held for d, held in live.items() if last is None or d <= last})
        if rows is None:
            return None
        kept = rows if first is None else rows.where(F.col("day") >= F.lit(first))
        return self._merged(kept).drop(_BUCKET)

    def touched(self, day: date) -> DataFrame | None:
        """The distinct owners of a landed day; None where it holds nothing."""
        if not self._deltas().get(day):
            return None
        rows = self.spark.read.parquet(f"{self.root}/day={day.isoformat()}")
        return rows.select(self.owner).distinct()

    def fold(self, through: date, first: date | None = None, min_days: int = 1) -> list[int]:
        """Merge the days up to ``through`` into the base of the buckets that at least
        ``min_days`` of them touch, and leave out items last seen before ``first``.

        Returns these buckets. Other buckets stay where they are; their deltas are read
        as before.
        """
        number = max(map(int, commits.numbered(self.spark, self.root, "base")), default=-1) + 1
        bases = self._bases()
        live = {d: held for d, held in self._live(bases, self._deltas()).items() if d <= through}
        times: dict[int, int] = {}
        for held in live.values():
            for bucket in held:
                times[bucket] = times.get(bucket, 0) + 1
        touched = sorted(b for b, n in times.items() if n >= min_days)
        if not touched:
            return []
        wanted = set(touched)
        rows = self._rows(
            {b: x for b, x in bases.items() if b in wanted}, {d: held & wanted for d, held in live.items()}
        )
        kept = self._merged(rows) if first is None else self._merged(rows).where(F.col("day") >= F.lit(first))
        dealt = kept.withColumn(_THROUGH, F.lit(through.isoformat())).hint("rebalance", _BUCKET)
        written = commits.attempt(
            dealt.sortWithinPartitions(_BUCKET, self.owner, self.item), self.root, [_THROUGH, _BUCKET]
        )
        folder = f"{written}/{_THROUGH}={through.isoformat()}"
        for bucket in wanted - self._held(folder):
            commits.make(self.spark, f"{folder}/{_GONE}{bucket}")
        try:
            commits.rename(self.spark, written, f"{self.root}/base={number}")
        except commits.PlaceTaken:
            commits.remove(self.spark, written)
            raise
        return touched

    def vacuum(self) -> None:
        """Remove base files and deltas that a later base replaces; only while nobody reads or writes."""
        bases = self._bases()
        for number in sorted(map(int, commits.numbered(self.spark, self.root, "base")))[:-1]:
            folder = f"{self.root}/base={number}"
            live = {b for b, (n, _) in bases.items() if n == number}
            for day in commits.numbered(self.spark, folder, _THROUGH):
                for bucket in self._held(f"{folder}/{_THROUGH}={day}") - live:
                    commits.remove(self.spark, f"{folder}/{_THROUGH}={day}/{_BUCKET}={bucket}")
            if not live:
                commits.remove(self.spark, folder)
        closed = self.closed()
        deltas = self._deltas()
        for day, held in self._live(bases, deltas).items():
            if closed is not None and day <= closed and not held:
                commits.remove(self.spark, f"{self.root}/day={day.isoformat()}")
        commits.clear_attempts(self.spark, self.root)
