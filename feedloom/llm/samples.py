"""Bounded training samples of labelled texts, made into features where the texts lie."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import linear, words

#: Most labelled rows a mark is fitted on, those with the lowest hash of their id.
SAMPLE_ROWS = 8192

_SCHEMA = "key long, marks array<double>, idx binary, val binary"


def labelled_features(
    docs: DataFrame,
    labels: DataFrame,
    marks: list[str],
    features: Callable[[pa.Array], linear.Rows],
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Features of at most ``rows`` labelled texts for each mark, and their labels.

    Labels that are null, and ids that are null or unknown, teach nothing; a row
    without one label still teaches the others, its missing label is null. An id
    labelled twice counts with its highest labels, a repeated document once per
    row. Only ids are ranked; texts meet the chosen ids, a table of at most
    ``rows`` rows a mark that is small enough to be sent to every executor.
    """
    given = [F.nanvl(F.col(m).cast("double"), F.lit(None)).alias(f"_m{k}") for k, m in enumerate(marks)]
    labelled = (
        labels.select(F.col(id_col).alias("_id"), *given)
        .na.drop(subset=["_id"])
        .groupBy("_id")
        .agg(F.array(*[F.max(f"_m{k}") for k in range(len(marks))]).alias("marks"))
        .withColumn("key", F.xxhash64(F.col("_id").cast("string")))
    )
    chosen = [labelled.where(F.col("marks")[k].isNotNull()).orderBy("key", "_id").limit(rows) for k in range(len(marks))]
    known = chosen[0] if len(chosen) == 1 else reduce(DataFrame.unionByName, chosen).distinct()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    joined = texts.join(F.broadcast(known), "_id").select("key", "marks", "_text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column("_text"))
            for at, stop in words.slices(texts):
                found = features(texts.slice(at, stop - at))
                spans = list(zip(found.first[:-1], found.first[1:], strict=True))
                # Values that are all one are not sent.
                value = found.value.astype(np.float32)
                values = [b"" if (value[a:b] == 1).all() else value[a:b].tobytes() for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, stop - at),
                        batch.column("marks").slice(at, stop - at),
                        pa.array([found.index[a:b].astype(np.int32).tobytes() for a, b in spans], pa.binary()),
                        pa.array(values, pa.binary()),
                    ],
                    names=["key", "marks", "idx", "val"],
                )

    return words.bounded(joined).mapInArrow(cut, _SCHEMA)


def fit_once(
    sample: DataFrame, fit: Callable[[linear.Rows, np.ndarray], np.ndarray], outputs: int
) -> np.ndarray:
    """Run ``fit`` on the bounded sample in one task and return its ``outputs`` x dim weights.

    An empty sample gives weights of no width. A missing label comes to ``fit`` as NaN.

    The rows are put in key order first, so a task that runs again after a lost
    executor returns the same weights.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for batch in batches for r in batch.to_pylist()]
        if not found:
            return
        found.sort(key=lambda r: (r["key"], r["idx"], [(m is not None, m or 0.0) for m in r["marks"]]))
        index = [np.frombuffer(r["idx"], np.int32) for r in found]
        value = [
            np.frombuffer(r["val"], np.float32) if r["val"] else np.ones(len(x), np.float32)
            for r, x in zip(found, index, strict=True)
        ]
        firsts = [np.array([0, len(x)]) for x in index]
        marks = np.array([r["marks"] for r in found], np.float64).reshape(len(found), -1)
        rows = linear.join_rows(firsts, index, value)
        del found, index, value
        weights = fit(rows, marks)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float32).tobytes()], pa.binary())], names=["weights"]
        )

    # The schema of one row: the weights are bounded by the number of hashed features.
    cell = sample.repartition(1).mapInArrow(train, "weights binary").collect()
    if not cell:
        return np.zeros((outputs, 0), np.float32)
    return np.frombuffer(cell[0]["weights"], np.float32).reshape(outputs, -1)
