"""Quality classifier: hashed word n-gram logistic regression.

Features of a text are the counts of its words, word pairs, and runs of word
shapes (upper, title, lower, digits, punctuation, repeat of the word before),
hashed into ``2 ** BITS`` places, log-damped and scaled to length one. Weights
come from follow-the-regularised-leader updates on a bounded sample; a score is
the sigmoid of a sparse dot product.

Null and empty texts have no feature and get the sigmoid of the bias. Very long
texts are scored whole. Repeated rows are scored alike, ties cannot occur. With
no usable label every score is the prior 0.5. Only the id and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import linear, samples, words

BITS = 18
THRESHOLD = 0.7
_UPPER = np.zeros(256, np.int64)
_UPPER[ord("A") : ord("Z") + 1] = 1
_SHAPE_RUN = 3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def features(texts: pa.Array) -> linear.Rows:
    """Hashed n-gram features of a slice of texts."""
    w = words.split(texts, marks=True)
    ups = np.concatenate([[0], np.cumsum(_UPPER[w.data])])
    size, upper = w.end - w.start, ups[w.end] - ups[w.start]
    lower = words.split(words.lowered(texts), marks=True)
    same = len(lower.hash) == len(w.hash)
    h = lower.hash if same else w.hash
    digit = (w.data[w.start] >= 48) & (w.data[w.start] <= 57) if len(h) else np.zeros(0, bool)
    shape = np.select(
        [w.kind == words.MARK, digit, (upper == size) & (size > 1), upper > 0], [1, 2, 3, 4], 5
    ).astype(np.uint64)
    repeat = np.zeros(len(h), bool)
    repeat[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape[repeat] += np.uint64(8)
    parts, docs = [h], [w.doc]
    for values, run in ((h, 2), (words.mix(shape), 1), (words.mix(shape), _SHAPE_RUN)):
        found, at = words.runs_of(w, run, values)
        parts.append(found + np.uint64(run))
        docs.append(w.doc[at])
    doc, bucket, count = words.tallies(
        np.concatenate(docs), np.concatenate(parts) >> np.uint64(64 - BITS), BITS
    )
    value = np.log1p(count)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    norm = np.sqrt(np.bincount(doc, value * value, minlength=len(texts)))
    return linear.Rows(first, bucket, value / norm[doc] * 4.0 if len(doc) else value)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = samples.SAMPLE_ROWS,
) -> np.ndarray:
    """Weights learnt from at most ``rows`` labelled texts that are not held out."""
    known = labels.where(~held_out(id_col))
    sample = samples.labelled_features(docs, known, [label], features, id_col, text_col, rows)

    def fit(found: linear.Rows, marks: np.ndarray) -> np.ndarray:
        return linear.Ftrl().fit(found, (marks[:, 0] > 0).astype(float), 1 << BITS)

    return samples.fit_once(sample, fit, 1)[0]


def score(
    docs: DataFrame,
    weights: np.ndarray,
    text_col: str = "text",
    out: str = "score",
) -> DataFrame:
    """All columns of ``docs`` and the score of each whole text in column ``out``.

    A column of that name is replaced.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column(at))
            found = [np.zeros(0)]
            for a, b in words.slices(texts):
                rows = features(texts.slice(a, b - a))
                found.append(linear.predict(rows, weights, 1 << BITS) if len(weights) else np.full(b - a, 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], names=[*batch.schema.names, out])

    return words.bounded(docs).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and predictions of all documents by a model of their labels."""
    weights = train(docs, labels)
    return score(docs.select("doc_id", "text"), weights).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
