"""Toxicity by a classifier chain over label columns.

The chain predicts its categories one after the other. Every link is a linear
model on the presence of hashed words and word beginnings (an insult keeps its
stem where its ending varies), to which the log-odds of all earlier
categories are added. While the chain is trained, those come from models that
have not seen the row (``FOLDS`` folds); when it predicts, from the models
fitted on the whole sample. The labels table has one mark of toxicity, so the
chain of the query is low quality, then toxic; more label columns make a longer
chain.

Null and empty texts have no word and get the prior of each link. Very long
texts are read whole; a word counts once per text. Repeated rows are scored
alike. A category learns from the rows that have its own label, whatever other
labels they lack. A category without any has the probability 0.5; if that is
the toxic one, nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import linear, samples, words

BITS = 18
FOLDS = 3
#: Bytes of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6)
THRESHOLD = 0.4
#: Most labelled rows each category is fitted on.
SAMPLE_ROWS = 16384
CATEGORIES = ("low_quality", "toxic")
_ODDS_SCALE = 0.25


def features(texts: pa.Array) -> linear.Rows:
    """Presence of every word of a text and of the beginnings of its longer words."""
    w = words.split(words.lowered(texts))
    found = [(w.hash, w.doc)]
    for size in STEMS:
        stem, at = words.stems(w, size)
        found.append((stem, w.doc[at]))
    doc, bucket, _ = words.tallies(
        np.concatenate([d for _, d in found]), np.concatenate([h for h, _ in found]) >> np.uint64(64 - BITS), BITS
    )
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    return linear.Rows(first, bucket, np.ones(len(bucket)))


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)) * _ODDS_SCALE


def _learner() -> linear.Ftrl:
    return linear.Ftrl(alpha=1.0, l1=4.0, l2=0.0, epochs=4)


def _part(rows: linear.Rows, chosen: np.ndarray) -> linear.Rows:
    spans = [slice(rows.first[r], rows.first[r + 1]) for r in chosen]
    sizes = np.array([s.stop - s.start for s in spans], np.int64)
    take = np.concatenate([np.arange(s.start, s.stop) for s in spans]) if spans else np.zeros(0, np.int64)
    return linear.Rows(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), rows.index[take], rows.value[take])


def fit_chain(rows: linear.Rows, marks: np.ndarray) -> np.ndarray:
    """Weights of every link, one row each, padded to the width of the last link.

    A link is fitted on the rows whose mark is not NaN; the constant of a link
    that no row has a mark of is NaN.
    """
    n, links = marks.shape
    dim = 1 << BITS
    earlier = np.zeros((n, 0))
    out = np.zeros((links, dim + links))
    for k in range(links):
        known = np.flatnonzero(~np.isnan(marks[:, k]))
        unseen = np.full(n, 0.5)
        if not len(known):
            out[k, -1] = np.nan
            earlier = np.column_stack([earlier, _odds(unseen)])
            continue
        y = (marks[:, k] > 0).astype(float)
        weights = _learner().fit(_part(rows, known), y[known], dim, earlier[known])
        out[k, : dim + k] = weights[:-1]
        out[k, -1] = weights[-1]
        if k + 1 < links:
            fold = np.full(n, FOLDS)
            fold[known] = np.arange(len(known)) % FOLDS
            for f in range(FOLDS):
                learn, keep = known[fold[known] != f], known[fold[known] == f]
                if len(learn) and len(keep):
                    model = _learner().fit(_part(rows, learn), y[learn], dim, earlier[learn])
                    unseen[keep] = linear.predict(_part(rows, keep), model, dim, earlier[keep])
            # No model has seen a row without this mark.
            keep = np.flatnonzero(fold == FOLDS)
            if len(keep):
                unseen[keep] = linear.predict(_part(rows, keep), weights, dim, earlier[keep])
            earlier = np.column_stack([earlier, _odds(unseen)])
    return out


def learnt(chain: np.ndarray, link: int = -1) -> bool:
    """Whether a link had labels to learn from."""
    return chain.shape[1] > 0 and not np.isnan(chain[link, -1])


def predict_chain(rows: linear.Rows, chain: np.ndarray) -> np.ndarray:
    """Probability of every category, in chain order."""
    dim, links = 1 << BITS, len(chain)
    if not chain.shape[1]:
        return np.full((len(rows), links), 0.5)
    found = np.zeros((len(rows), links))
    earlier = np.zeros((len(rows), 0))
    for k in range(links):
        weights = np.concatenate([chain[k, : dim + k], chain[k, -1:]])
        found[:, k] = linear.predict(rows, weights, dim, earlier) if learnt(chain, k) else 0.5
        earlier = np.column_stack([earlier, _odds(found[:, k])])
    return found


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> np.ndarray:
    """The chain learnt from at most ``rows`` labelled texts a category."""
    sample = samples.labelled_features(docs, labels, list(categories), features, id_col, text_col, rows)
    return samples.fit_once(sample, fit_chain, len(categories))


def score(
    docs: DataFrame,
    chain: np.ndarray,
    categories: Sequence[str] = CATEGORIES,
    text_col: str = "text",
    prefix: str = "p_",
) -> DataFrame:
    """All columns of ``docs`` and a probability column for each category.

    Columns of those names are replaced.
    """
    names = [f"{prefix}{c}" for c in categories]
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column(at))
            found = [np.zeros((0, len(names)))]
            found += [predict_chain(features(texts.slice(a, b - a)), chain) for a, b in words.slices(texts)]
            table = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(table[:, k].copy()) for k in range(len(names))]],
                names=[*batch.schema.names, *names],
            )

    return words.bounded(docs).mapInArrow(run, schema)


def category_labels(labels: DataFrame) -> DataFrame:
    """The given labels as categories: low quality, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Category probabilities of all documents, and whether each is toxic."""
    chain = train(docs, category_labels(labels))
    return score(docs.select("doc_id", "text"), chain).select(
        "doc_id",
        *[f"p_{c}" for c in CATEGORIES],
        (F.lit(learnt(chain)) & (F.col("p_toxic") > THRESHOLD)).cast("int").alias("toxic"),
    )
