"""Importance resampling towards a target text collection.

Words are runs of digits, small letters (A-Z are lowered, nothing else) and
characters beyond ASCII. Every run of one to three words is a feature, hashed into a
fixed number of buckets; the log ratio of a bucket's share in the target to its share
in the documents, in thousandths, is its gain. A document's weight is the sum of the
gains of its features, looked up in one array, and its score adds noise that depends
on its id alone. Drawing the highest scores then draws documents in proportion to
their weights, without replacement.

The cutoff is found without sorting all rows: a quantile sketch of the scores gives a
bracket, exact counts outside it tell whether the cutoff lies within, and if not the
bracket is widened. Only the rows of the bracket are sorted to find the cutoff; what
lies above is drawn as a whole and numbered in slices.

Whole texts count, whatever their length. A null text has no words; null, repeated
and equal ids are rows of their own, a null id hashes as the empty text and ranks
last among equal scores. Rows that agree in score and id are drawn in an order that
depends on their features, then any. Fewer documents than a whole share draw nothing,
and empty tables give empty results; an empty target gives every bucket its own
smoothed share. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm import checksums, words
from feedloom.operators.ranking import spread_rank
from feedloom.staging import stage

BUCKETS = 10_000
RUN_WORDS = 3
MIN_WORDS = 20
#: Drawn share, as a fraction of whole numbers.
SHARE = (5, 100)
SEED = 42
#: The sketch places a quantile within 1 / ACCURACY of the rows.
ACCURACY = 10_000
_HASHES = 1 << 32


def _letters() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    inside = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        inside[low : high + 1] = True
    return lower, inside[lower]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, their documents, and the number of words of each document."""
    lower, inside = _letters()
    raw, offsets = words.bytes_of(texts)
    held = np.zeros(len(raw) + 1, bool)
    held[:-1] = inside[raw]
    # A word begins where its first byte follows no byte of a word or begins a text.
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    edges = offsets[1:-1]
    begins[edges] |= held[edges]
    start = np.flatnonzero(begins)
    stops = held.copy()
    stops[:-1] &= ~held[1:]
    inner = edges[edges > 0] - 1
    stops[inner] |= held[inner]
    end = np.flatnonzero(stops) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    sums = checksums.of_spans(lower[raw], start, end)
    sizes = end - start + 1
    spaced = checksums.joined(np.full(len(sums), zlib.crc32(b" "), np.uint32), sums, sizes - 1)
    found, owners, run = [sums], [doc], sums
    for n in range(1, RUN_WORDS):
        run = checksums.joined(run[:-1], spaced[n:], sizes[n:])
        same = doc[n:] == doc[: max(len(doc) - n, 0)]
        found.append(run[same])
        owners.append(doc[n:][same])
    bucket = np.concatenate(found) % np.uint32(BUCKETS)
    return bucket.astype(np.int64), np.concatenate(owners), np.bincount(doc, minlength=len(texts))


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = words.text_array(batch.column("text"))
            for a, b in words.slices(found):
                total += np.bincount(features(found.slice(a, b - a))[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = words.bounded(texts.select(F.col(text_col).cast("string").alias("text")))
    found = rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    in_source, in_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = [(t + 1.0) * in_source / ((s + 1.0) * in_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((place + 0.5) / float(_HASHES))))


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column("text"))
            for a, b in words.slices(texts):
                bucket, owner, n_words = features(texts.slice(a, b - a))
                n_features = np.bincount(owner, minlength=b - a)
                # Sums of whole numbers: order does not matter, and nothing is rounded.
                weight = np.zeros(b - a, np.int64)
                if len(bucket):
                    order = np.argsort(owner, kind="stable")
                    running = np.append(0, np.cumsum(gains[bucket[order]]))
                    ends = np.cumsum(n_features)
                    weight = running[ends] - running[ends - n_features]
                columns = [pa.array(x.astype(np.int64)) for x in (n_words, n_features, weight)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), *columns], names=["id", "n_words", "n_features", "weight"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return words.bounded(rows).mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def bracket(scores: DataFrame, wanted: int, total: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Scores ``low`` and ``high`` between which the ``wanted``-th highest lies, and how many lie above ``high``.

    The sketch proposes, exact counts decide: a bracket that they refute is widened,
    at last to all rows.
    """
    place, reach = 1 - wanted / total, 2 / accuracy
    while True:
        ends = [max(place - reach, 0.0), min(place + reach, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", ends, accuracy).alias("ends")).first().ends
        if reach >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, upto = scores.agg(
            F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("upto")
        ).first()
        if above < wanted <= upto:
            return low, high, above
        reach *= 8


def draw(weighed: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, accuracy: int = ACCURACY) -> DataFrame:
    """``rank`` of every row of a written table of ids, words, features, weights and scores; null if not drawn."""
    fit = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    total = weighed.where(fit).count()
    wanted = total * share[0] // share[1]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return weighed.select("*", undrawn)
    low, high, above = bracket(weighed.where(fit), wanted, total, accuracy)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "n_features", "weight"]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    score = F.col("score")
    within = spread_rank(weighed.where(fit & score.between(low, high)), [], order, "rank", "bracket")
    place = F.when(F.col("rank") <= wanted - above, F.col("rank") + above)
    tops = spread_rank(weighed.where(fit & (score > high)), [], order, "rank", "drawn")
    rest = weighed.where(~fit | (score < low)).select("*", undrawn)
    return rest.unionByName(within.withColumn("rank", place)).unionByName(tops)


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document."""
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    weighed = weigh(docs, gains, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    drawn = draw(stage(weighed, "resampling-scores"), share, min_words)
    return drawn.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
