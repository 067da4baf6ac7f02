"""An append-only ledger of runs.

The rows of a run become visible in one rename, as ``run=<id>/attempt=<n>``. A run
that is repeated commits a further attempt, and the last one counts: its earlier rows
are neither lost while it works nor added twice. A run leaves its own rows out when it
looks up what others have written, so it finds the same again however often it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import commits


class RunLedger:
    def __init__(self, spark: SparkSession, path: str, schema: str = "docid string, source string"):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _attempts(self, run: str) -> list[int]:
        return sorted(map(int, commits.numbered(self.spark, f"{self.path}/run={run}", "attempt")))

    def runs(self) -> list[str]:
        """Runs that have committed, in order of their ids."""
        return [r for r in commits.numbered(self.spark, self.path, "run") if self._attempts(r)]

    def entries(self, without: str | None = None) -> DataFrame:
        """Rows of the last attempt of every run, with its id ``run``; those of one run may be left out."""
        found = [f"{self.path}/run={r}/attempt={self._attempts(r)[-1]}" for r in self.runs() if r != without]
        schema = f"{self.schema}, run string"
        if not found:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, attempt int").option("basePath", self.path).parquet(*found)
        return rows.drop("attempt")

    def commit(self, run: str, rows: DataFrame) -> None:
        """Make the rows of a run visible, in place of those of its earlier attempts."""
        wanted = self.spark.createDataFrame([], self.schema)
        last = max(self._attempts(run), default=0)
        commits.land(rows.select(*wanted.columns), f"{self.path}/run={run}", f"attempt={last + 1}")

    def vacuum(self) -> None:
        """Remove attempts that later ones have replaced; only while nobody reads or writes."""
        for run in commits.numbered(self.spark, self.path, "run"):
            folder = f"{self.path}/run={run}"
            commits.clear_attempts(self.spark, folder)
            for attempt in self._attempts(run)[:-1]:
                commits.remove(self.spark, f"{folder}/attempt={attempt}")


def once_per_key(entries: DataFrame, key: str = "docid") -> DataFrame:
    """Keys that more than one run has written: none, if every run has looked them up."""
    return entries.groupBy(key).agg(F.count_distinct("run").alias("runs")).where(F.col("runs") > 1)
