"""Near copies of texts by Order MinHash and banded alignment.

A text is its sequence of five-word shingles, a repeated shingle labelled with its
occurrence. Each of ``BANDS`` hash functions samples the ``SAMPLED`` least labelled
shingles, puts them back in text order, and hashes that sequence to a bucket: texts
meet if they share those shingles in that order. A text that repeats shingles is
also sampled with every shingle once, where it first stands, so that texts which
repeat a passage a different number of times meet as well. Short texts sample
``SHORT_SAMPLED``, texts on the border both. The similarity of two texts is that of
their best alignment, matched shingles by all shingles of either, with repeats or
with every shingle once. Pairs at ``THRESHOLD`` or above are links; classes are
connected components of links, named by their least id.

Texts of equal words are one class before anything else, and only its first
document goes on. In a bucket every text is aligned with the bucket's first, not
with every other: a group of copies, however large, takes one alignment a member.
Where that leaves several classes in a bucket, the members outside its largest class
are compared with all others in blocks of bounded bytes, each block pair a task: the
shingles of a block are indexed, and pairs that share enough and are still of two
classes are aligned. So every two texts of a bucket are linked, of one class, or
compared, and no pair of rows is ever written.

Texts without a word, null texts and null ids link with nothing. Texts of fewer than
five words are one shingle. Very long texts are sampled and aligned whole. Rows under
one id are one document with the text of the least digest that has a word. Ties in a sample go by place in
the text. An empty table gives an empty result. Only id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import bitmaps, words
from feedloom.llm.components import Forest, components
from feedloom.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
SAMPLED, SHORT_SAMPLED = 5, 2
#: Texts of fewer shingles than the first sample ``SHORT_SAMPLED``, of at least the second ``SAMPLED``.
SHORT_BELOW, LONG_FROM = 9, 7
#: A block of a bucket holds about so many texts, or so many bytes of shingles, at most.
BLOCK_TEXTS, BLOCK_BYTES = 2048, 8 << 20
_OVERSAMPLE = 24
_SEEDS = np.random.default_rng(20240131).integers(1, 1 << 62, (2, BANDS)).astype(np.uint64)


def shingles(w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order and their documents; a text of fewer words is one shingle."""
    found, at = words.runs_of(w, SHINGLE)
    doc = w.doc[at]
    first = w.first_words()
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
    if not len(short):
        return found, doc
    place = np.arange(len(w.hash)) - first[w.doc] if len(w.hash) else w.doc
    whole = np.zeros(w.n_docs, np.uint64)
    np.add.at(whole, w.doc, words.mix(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    found, doc = np.concatenate([found, words.mix(whole[short])]), np.concatenate([doc, short])
    order = np.argsort(doc, kind="stable")
    return found[order], doc[order]


def labelled(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingle hashes mixed with the number of equal ones before in the same text."""
    order = np.lexsort((grams, doc))
    g, d = grams[order], doc[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(fresh)
    nth = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    out = np.empty(len(g), np.uint64)
    out[order] = np.where(nth > 0, words.mix(g + nth.astype(np.uint64)), g)
    return out


def _least(value: np.ndarray, doc: np.ndarray, count: int, first: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``count`` least values of every text, and their texts, in text order."""
    size = np.diff(first)
    near = np.flatnonzero(value <= limit)
    kept = np.bincount(doc[near], minlength=len(size))
    poor = np.flatnonzero(kept < np.minimum(size, count))
    if len(poor):
        extra = np.concatenate([np.arange(first[d], first[d + 1]) for d in poor.tolist()])
        near = np.union1d(near, extra)
    d = doc[near]
    order = near[np.lexsort((near, value[near], d))]
    begins = np.searchsorted(doc[order], np.arange(len(size)))
    rank = np.arange(len(order)) - begins[doc[order]]
    chosen = np.sort(order[rank < count])
    return chosen, doc[chosen]


def _sequence_hash(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    place = np.arange(len(doc)) - first[doc] if len(doc) else doc
    out = np.zeros(n_docs, np.uint64)
    np.add.at(out, doc, words.mix(values ^ words.mix(place.astype(np.uint64) + np.uint64(11))))
    return words.mix(out)


def sketches(marked: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Band values of long and of short texts, one row per text (see the module)."""
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    size = np.diff(first)
    share = np.minimum(_OVERSAMPLE / np.maximum(size, 1), 1.0)
    limit = np.where(share >= 1, np.uint64(2**64 - 1), (share * 2.0**64).clip(max=2.0**64 - 2048).astype(np.uint64))
    limits = np.repeat(limit, size)
    long, short = np.zeros((n_docs, BANDS), np.uint64), np.zeros((n_docs, BANDS), np.uint64)
    small = doc[np.flatnonzero(size[doc] < SHORT_BELOW)] if len(doc) else doc
    few = np.flatnonzero(size[doc] < SHORT_BELOW) if len(doc) else doc
    for band in range(BANDS):
        value = (marked ^ _SEEDS[0, band]) * (_SEEDS[1, band] | np.uint64(1))
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        at, d = _least(value, doc, SAMPLED, first, limits)
        long[:, band] = _sequence_hash(marked[at], d, n_docs) + np.uint64(band)
        if len(few):
            at, d = _least(value[few], small, SHORT_SAMPLED, np.searchsorted(small, np.arange(n_docs + 1)), limits[few])
            short[:, band] = _sequence_hash(marked[few][at], d, n_docs) + np.uint64(BANDS + band)
    return long, short


def band_lists(grams: np.ndarray, doc: np.ndarray, n_docs: int) -> list[list[int]]:
    """Bands of every text: of its labelled shingles and, where it repeats some, of every shingle once."""

    def lists(marked: np.ndarray, doc: np.ndarray, n_docs: int) -> list[list[int]]:
        size = np.bincount(doc, minlength=n_docs)
        long, short = sketches(marked, doc, n_docs)
        return [
            ([] if s < LONG_FROM else x.tolist()) + ([] if s >= SHORT_BELOW else y.tolist())
            for s, x, y in zip(size.tolist(), long.view(np.int64), short.view(np.int64), strict=True)
        ]

    marked = labelled(grams, doc)
    out = lists(marked, doc, n_docs)
    again = marked != grams
    if again.any():
        repeats = np.zeros(n_docs, bool)
        repeats[doc[again]] = True
        own = np.flatnonzero(repeats)
        once = repeats[doc] & ~again
        more = lists(grams[once], np.searchsorted(own, doc[once]), len(own))
        for d, bands in zip(own.tolist(), more, strict=True):
            # A band may sample the same shingles twice.
            out[d] = list(dict.fromkeys(out[d] + bands))
    return out


def _digests(w: words.Words) -> list[pa.Array]:
    """Two 64-bit sums over a text's words and their places: equal for equal word sequences."""
    place = (np.arange(len(w.hash)) - w.first_words()[w.doc] if len(w.hash) else w.doc).astype(np.uint64)
    out = []
    for salt in (3, 5):
        total = np.zeros(w.n_docs, np.uint64)
        np.add.at(total, w.doc, words.mix(w.hash ^ words.mix(place * np.uint64(64) + np.uint64(salt))))
        out.append(pa.array(total.view(np.int64)))
    return out


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, digest of the word sequence and band values of every text with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column("_text"))
            for a, b in words.slices(texts):
                w = words.split(words.lowered(texts.slice(a, b - a)))
                grams, doc = shingles(w)
                n = b - a
                size = np.bincount(doc, minlength=n)
                bands = band_lists(grams, doc, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, n), *_digests(w), pa.array(bands, pa.list_(pa.int64()))],
                    names=["id", "d1", "d2", "bands"],
                ).filter(pa.array(size > 0))

    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).where("id IS NOT NULL")
    return words.bounded(named).mapInArrow(run, "id long, d1 long, d2 long, bands array<long>")


def _grams(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingle sequences (four bytes a shingle) of the documents in ``ids``.

    A bitmap of the ids drops most other texts where they are read, so that only
    shingles, not texts, are shuffled to the join that decides.
    """
    wanted = bitmaps.gather(ids.select(F.xxhash64("id").alias("hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitmaps.held(wanted, batch.column("hash").to_numpy().view(np.uint64))))
            texts = words.text_array(batch.column("_text"))
            for a, b in words.slices(texts):
                w = words.split(words.lowered(texts.slice(a, b - a)))
                grams, doc = shingles(w)
                first = np.searchsorted(doc, np.arange(b - a + 1))
                raw = (grams >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        *_digests(w),
                        pa.array([raw[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                    ],
                    names=["id", "d1", "d2", "grams"],
                ).filter(pa.array(first[1:] > first[:-1]))

    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).where("id IS NOT NULL")
    hashed = words.bounded(named.withColumn("hash", F.xxhash64("id")))
    found = hashed.mapInArrow(run, "id long, d1 long, d2 long, grams binary").join(ids, "id", "left_semi")
    # Of the texts under one id, the one that was sampled.
    return found.groupBy("id").agg(F.min(F.struct("d1", "d2", "grams"))["grams"].alias("grams"))


def needed(n: int, m: int, threshold: float = THRESHOLD) -> int:
    """Matched shingles that two texts of ``n`` and ``m`` need."""
    return int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))


def alike(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether the best alignment of two shingle sequences reaches the threshold.

    An alignment with few enough gaps stays in a band around the diagonal. Each
    labelled shingle occurs once in a text, so aligning them is finding a longest
    increasing run of places; if repeats make that fall short while enough
    shingles are shared, the unlabelled sequences are aligned exactly in the band.
    Texts that differ only in how often they repeat a passage are alike too: the
    sequences are also aligned with every shingle once, where it first stands.
    """
    if not len(a) or not len(b):
        return False
    la, lb = (labelled(x.astype(np.uint64) << np.uint64(16), np.zeros(len(x), np.int64)) for x in (a, b))
    shared, run, band, least = _runs(la, lb, threshold)
    if run >= least:
        return True
    if shared >= least and _banded(a.tolist(), b.tolist(), band) >= least:
        return True
    once = [x[np.sort(np.unique(x, return_index=True)[1])] for x in (a, b)]
    if len(once[0]) == len(a) and len(once[1]) == len(b):
        return False
    _, run, _, least = _runs(*once, threshold)
    return run >= least


def _runs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[int, int, int, int]:
    """For sequences without repeats: shared shingles, aligned ones, the band, and how many are needed."""
    n, m = len(a), len(b)
    least = needed(n, m, threshold)
    band = n + m - 2 * least
    if min(n, m) < least:
        return 0, 0, band, least
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < least:
        return len(i), 0, band, least
    order = np.argsort(i)
    i, j = i[order], j[order]
    inside = j[np.abs(i - j) <= band]
    return len(i), _increasing(inside) if len(inside) >= least else 0, band, least


def _increasing(places: np.ndarray) -> int:
    if (places[1:] > places[:-1]).all():
        return len(places)
    tails: list[int] = []
    for p in places.tolist():
        at = bisect_left(tails, p)
        if at == len(tails):
            tails.append(p)
        else:
            tails[at] = p
    return len(tails)


def _banded(a: list[int], b: list[int], band: int) -> int:
    """Longest common subsequence within the band, a machine word of places at a time."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << k)
    full = (1 << len(a)) - 1
    strip = (1 << (2 * band + 1)) - 1
    row = full
    for k, x in enumerate(b):
        held = places.get(x, 0)
        if held:
            shift = k - band
            held &= strip << shift if shift >= 0 else strip >> -shift
            hit = row & held
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _aligned(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a``, ``b`` that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = [
                alike(np.frombuffer(x[k].as_py(), "<u4"), np.frombuffer(y[k].as_py(), "<u4"), threshold)
                for k in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = grams.select(F.col("id").alias("a"), F.col("grams").alias("x"))
    right = grams.select(F.col("id").alias("b"), F.col("grams").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return words.bounded(both).mapInArrow(run, "a long, b long")


def _buckets(texts: DataFrame) -> DataFrame:
    """``key``, ``id`` and the bucket's ``first`` id, of all buckets of two texts or more."""
    rows = texts.select("id", F.explode("bands").alias("key"))
    firsts = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return stage(rows.join(firsts, "key").select("key", "id", "first"), "copies-buckets")


def _blocks(buckets: DataFrame, members: DataFrame, grams: DataFrame) -> DataFrame:
    """Rows of the blocks to compare: ``key``, ``p``, ``q``, ``outer`` and the text.

    Only buckets of several classes have blocks. Block (p, q) brings the p-th part of
    a bucket's texts together with the q-th part of those outside its largest class.
    """
    classed = buckets.join(members, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("class")
    )
    sizes = (
        classed.groupBy("key", "class")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "class")).alias("core"),
            F.count("*").alias("classes"),
        )
        .where("classes > 1 AND n > 2")
        .select("key", "n", F.col("core.class").alias("core"), (F.col("n") - F.col("core.n")).alias("n_outer"))
    )
    rows = classed.join(sizes, "key").join(grams, "id")
    bytes_ = rows.groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.octet_length("grams")).alias("all_bytes"),
        F.sum(F.when(F.col("class") != F.col("core"), F.octet_length("grams")).otherwise(0)).alias("outer_bytes"),
    )
    parts = lambda n, size: F.ceil(
        F.greatest(F.col(n) / BLOCK_TEXTS, F.col(size) / BLOCK_BYTES)
    ).cast("int")
    h = F.xxhash64("id")
    placed = rows.join(bytes_, F.col("key") == F.col("_key")).select(
        "key", "id", "class", "grams", (F.col("class") != F.col("core")).alias("outer"),
        parts("n", "all_bytes").alias("ps"), parts("n_outer", "outer_bytes").alias("qs"),
    )
    members_ = placed.select(
        "key",
        F.pmod(h, "ps").cast("int").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"),
        "id", "class", "grams", F.lit(False).alias("outer"),
    )
    outers = placed.where("outer").select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("ps") - 1)).alias("p"),
        F.pmod(F.shiftright(h, 20), "qs").cast("int").alias("q"),
        "id", "class", "grams", F.lit(True).alias("outer"),
    )
    return members_.unionByName(outers)


def compare_block(
    ids: list[int], classes_: list[int], grams: list[np.ndarray], outer: list[bool], threshold: float
) -> list[tuple[int, int]]:
    """Links between the outer texts and the members of a block that lie in different classes."""
    side = np.array(outer, bool)
    members, others = np.flatnonzero(~side), np.flatnonzero(side)
    if not len(members) or not len(others):
        return []
    sizes = np.array([len(g) for g in grams])
    doc = np.repeat(np.arange(len(grams)), sizes)
    flat = np.concatenate(grams).astype(np.uint64) << np.uint64(16)
    marked = labelled(flat, doc)
    # A pair can only be alike if it shares enough shingles with repeats, or enough distinct ones.
    views = [(marked, doc, sizes)]
    once = marked == flat
    if not once.all():
        views.append((marked[once], doc[once], np.bincount(doc[once], minlength=len(grams))))
    indexes = [_Postings(terms, holder, ~side, threshold, count) for terms, holder, count in views]
    forest = Forest()
    found = []
    for x in others.tolist():
        near = np.unique(np.concatenate([index.near(x) for index in indexes]))
        for y in near.tolist():
            a, b = ids[x], ids[y]
            if a == b or forest.find(classes_[x]) == forest.find(classes_[y]):
                continue
            if alike(grams[x], grams[y], threshold):
                forest.join(classes_[x], classes_[y])
                found.append((min(a, b), max(a, b)))
    return found


class _Postings:
    """Which members of a block hold a shingle."""

    def __init__(self, terms: np.ndarray, holder: np.ndarray, member: np.ndarray, threshold: float, count: np.ndarray):
        inside = member[holder]
        order = np.argsort(terms[inside], kind="stable")
        self.terms, self.holder = terms[inside][order], holder[inside][order]
        self.own, self.first = terms, np.concatenate([[0], np.cumsum(count)])
        self.count, self.threshold = count, threshold

    def near(self, x: int) -> np.ndarray:
        """Members that share enough of the shingles of text ``x``."""
        own = self.own[self.first[x] : self.first[x + 1]]
        low, high = np.searchsorted(self.terms, own, "left"), np.searchsorted(self.terms, own, "right")
        spans = [self.holder[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True) if b > a]
        if not spans:
            return np.zeros(0, np.int64)
        shared = np.bincount(np.concatenate(spans), minlength=len(self.count))
        least = self.threshold * (self.count[x] + self.count) / (1 + self.threshold) - 1e-9
        return np.flatnonzero(shared >= np.maximum(least, 1))


def _compared(blocks: DataFrame, threshold: float) -> DataFrame:
    """Links found in the blocks, a task for each."""

    def run(table: pa.Table) -> pa.Table:
        grams = [np.frombuffer(x, "<u4") for x in table.column("grams").to_pylist()]
        ids, held, outer = (table.column(c).to_pylist() for c in ("id", "class", "outer"))
        order = sorted(range(len(ids)), key=lambda k: (ids[k], outer[k]))
        columns = [[column[k] for k in order] for column in (ids, held, grams, outer)]
        links = compare_block(*columns, threshold)
        ends = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
        return pa.table(ends, names=["a", "b"])

    # Blocks are small but take time: they are dealt to as many tasks as the session shuffles to.
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, "key", "p", "q")
    return spread.groupBy("key", "p", "q").applyInArrow(run, "a long, b long")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``id`` and ``class_id`` of every document with a word and an id."""
    sketched = stage(
        _documents(docs, id_col, text_col)
        .groupBy("id")
        .agg(F.min(F.struct("d1", "d2", "bands")).alias("s"))
        .select("id", "s.*"),
        "copies-sketches",
    )
    # Equal word sequences have equal bands, so any row's will do.
    texts = stage(
        sketched.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.min("bands").alias("bands")), "copies-texts"
    )
    buckets = _buckets(texts)
    needed_ids = buckets.select("id").distinct()
    grams = stage(_grams(docs, needed_ids, id_col, text_col), "copies-grams")
    pairs = buckets.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(_aligned(pairs, grams, threshold), "copies-links")
    members = stage(components(links, "copies"), "copies-members")
    more = stage(_compared(_blocks(buckets, members, grams), threshold), "copies-more-links")
    # A link between members of two classes joins the classes.
    named = lambda end: members.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    joined = more.join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    merged = stage(components(joined, "copies-classes").toDF("component", "whole"), "copies-merged")
    named_texts = sketched.join(texts.select("d1", "d2", F.col("id").alias("text_id")), ["d1", "d2"])
    first = (
        named_texts.join(members.withColumnRenamed("id", "text_id"), "text_id", "left")
        .select("id", F.coalesce("component", "text_id").alias("component"))
        .join(merged, "component", "left")
    )
    return first.select("id", F.coalesce("whole", "component").alias("class_id"))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, its class, and whether it is the one document that stays."""
    found = classes(docs, id_col, text_col)
    own = docs.select(F.col(id_col).alias("_own"))
    key = F.coalesce("class_id", F.col("_own").cast("long"))
    return own.join(found, F.col("_own") == F.col("id"), "left").select(
        F.col("_own").alias(id_col), key.alias("class_id"), F.coalesce(key == F.col("_own"), F.lit(True)).alias("kept")
    )
