"""A keyed table that takes partial updates without being rewritten.

The table is a base in buckets of its key and numbered deltas, each the changed
fields of changed keys only. A reader joins the last change of each field to the
base, so an update writes as much as it changes, and deltas that are small next to
the base meet it without a shuffle of the base. ``compact`` folds deltas into new
base folders of those buckets that they touch; the others stay where they are.

Base folders and deltas appear by one rename, under numbers that rise and that one
writer only can take; a reader that has opened the table sees what it has opened until
``vacuum`` removes what later folders replace. Keys are unique in each delta. Updates
of unknown keys change nothing. A null in an update is a value, a column that it lacks
is no change. Columns of the table must not begin with an underscore.
"""

from __future__ import annotations

from feedloom import commits
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE, DELTA = "base", "delta"
_KIND = "_kind"
_BUCKET = "_bucket"
_SEQ = "_seq"
_CHANGED = "_changed"


class KeyedSnapshot:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        """``buckets`` holds for a new table; an old one keeps the number it was made with."""
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        made = commits.numbered(spark, self.path, "buckets")
        self.buckets = int(next(iter(made), buckets))
        self.root = f"{self.path}/buckets={self.buckets}"

    def _folders(self) -> dict[str, dict[int, set[int]]]:
        """For each kind the numbered folders, and the buckets that they hold."""
        found: dict[str, dict[int, set[int]]] = {BASE: {}, DELTA: {}}
        for number, name in commits.numbered(self.spark, self.root, "seq").items():
            for kind in commits.numbered(self.spark, f"{self.root}/{name}", _KIND):
                held = commits.numbered(self.spark, f"{self.root}/{name}/{_KIND}={kind}", _BUCKET)
                found[kind][int(number)] = {int(b) for b in held}
        return found

    def _state(self) -> tuple[dict[int, int], dict[int, list[int]]]:
        """For each bucket the number of its base, and of each delta that came after it."""
        found = self._folders()
        base: dict[int, int] = {}
        for number, held in sorted(found[BASE].items()):
            base.update(dict.fromkeys(held, number))
        deltas = found[DELTA].items()
        return base, {b: sorted(n for n, held in deltas if b in held and n > base[b]) for b in base}

    def exists(self) -> bool:
        return bool(self._folders()[BASE])

    def _next(self) -> int:
        return max(map(int, commits.numbered(self.spark, self.root, "seq")), default=-1) + 1

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, kind: str) -> str:
        """Rows by bucket, small buckets together in a task, a large one in several."""
        dealt = rows.withColumn(_KIND, F.lit(kind)).hint("rebalance", _BUCKET)
        return commits.attempt(dealt, self.root, [_KIND, _BUCKET])

    def create(self, rows: DataFrame) -> None:
        """The first base of a table."""
        commits.rename(self.spark, self._write(self._bucketed(rows), BASE), f"{self.root}/seq={self._next()}")

    def update(self, changes: DataFrame) -> None:
        """Commit changed fields: the key and any of the other columns.

        Where several writers commit at once, the last number wins a field.
        """
        names = [c for c in changes.columns if c != self.key]
        marked = changes.withColumn(_CHANGED, F.array(*[F.lit(n) for n in names]))
        written = self._write(self._bucketed(marked), DELTA)
        while True:
            try:
                return commits.rename(self.spark, written, f"{self.root}/seq={self._next()}")
            except commits.PlaceTaken:
                continue

    def _base_rows(self, base: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/seq={n}/{_KIND}={BASE}/{_BUCKET}={b}" for b, n in sorted(base.items())]
        return self.spark.read.option("basePath", self.root).parquet(*paths).drop("seq", _KIND)

    def _last_changes(self, later: dict[int, list[int]], columns: list[str]) -> DataFrame | None:
        """For each key a struct per column with its last value; null where nothing changed it."""
        of: dict[int, list[int]] = {}
        for bucket, numbers in later.items():
            for n in numbers:
                of.setdefault(n, []).append(bucket)
        if not of:
            return None
        frames = []
        for n, held in sorted(of.items()):
            paths = [f"{self.root}/seq={n}/{_KIND}={DELTA}/{_BUCKET}={b}" for b in sorted(held)]
            rows = self.spark.read.option("basePath", self.root).parquet(*paths)
            frames.append(rows.drop("seq", _KIND).withColumn(_SEQ, F.lit(n)))
        rows = frames[0]
        for more in frames[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        known = [c for c in columns if c != self.key and c in rows.columns]
        last = [
            F.max_by(F.when(F.array_contains(_CHANGED, c), F.struct(F.col(c))), F.when(F.array_contains(_CHANGED, c), F.col(_SEQ))).alias(c)
            for c in known
        ]
        return rows.groupBy(self.key).agg(*last)

    def _merged(self, base: dict[int, int], later: dict[int, list[int]]) -> DataFrame:
        rows = self._base_rows(base)
        columns = [c for c in rows.columns if c != _BUCKET]
        changes = self._last_changes(later, columns)
        if changes is None:
            return rows
        changed = set(changes.columns) - {self.key}
        values = [
            F.when(F.col(f"c.{c}").isNotNull(), F.col(f"c.{c}")[c]).otherwise(F.col(f"b.{c}")).alias(c)
            if c in changed
            else F.col(f"b.{c}")
            for c in columns
        ]
        return rows.alias("b").join(changes.alias("c"), self.key, "left").select(*values, F.col(f"b.{_BUCKET}"))

    def read(self) -> DataFrame:
        """All rows as the last updates leave them."""
        return self._merged(*self._state()).drop(_BUCKET)

    def compact(self, min_deltas: int = 1) -> list[int]:
        """New base folders of the buckets that so many deltas touch; returns these buckets.

        The number is chosen before the deltas are listed: an update that takes it
        meanwhile makes the rename fail, and nothing is lost.
        """
        number = self._next()
        base, later = self._state()
        touched = sorted(b for b, numbers in later.items() if numbers and len(numbers) >= min_deltas)
        if touched:
            rows = self._merged({b: base[b] for b in touched}, {b: later[b] for b in touched})
            written = self._write(rows, BASE)
            try:
                commits.rename(self.spark, written, f"{self.root}/seq={number}")
            except commits.PlaceTaken:
                commits.remove(self.spark, written)
                raise
        return touched

    def vacuum(self) -> None:
        """Remove what later folders replace; only while nobody reads or writes."""
        base, later = self._state()
        commits.clear_attempts(self.spark, self.root)
        for kind, folders in self._folders().items():
            for n, held in folders.items():
                of = f"{self.root}/seq={n}/{_KIND}={kind}"
                dead = {b for b in held if (base[b] != n if kind == BASE else n not in later.get(b, []))}
                for b in dead if dead != held else ():
                    commits.remove(self.spark, f"{of}/{_BUCKET}={b}")
                # The highest number stays taken, so that numbers never come again.
                if dead == held and n != self._next() - 1:
                    commits.remove(self.spark, f"{self.root}/seq={n}")
