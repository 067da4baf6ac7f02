"""Benchmark decontamination by template canonicalisation.

Numbers (digits or number words), the units after them and names (capitalised
words inside a sentence, runs of them as one) become typed placeholders, all
other words are lower-cased: what is left of a text is its template. Every run of
``WINDOW`` template words with at least ``MIN_LITERAL`` plain ones is hashed, and
windows of documents are hash-joined to windows of benchmark items. Hits of one
document and item at one distance form an alignment; it counts if ``MIN_HITS``
windows of it match and its slots are consistent: equal values in the item stand on
equal values in the document, spellings of one unit being equal; different ones may
fall together. Values that break this take away the
windows they stand in; an alignment is dropped if fewer than ``AGREEING`` of its
windows are left. So re-parameterised questions are caught, and texts that merely share
the frame of a sentence are not. Items of fewer than ``WINDOW`` words are matched
as one window of their length.

Beside the template, every run of ``WINDOW`` lower-cased words is hashed as it
stands. So a whole item is found whatever its slots and whatever the case of the
copy; of an item whose template windows all hold too few plain words, ``MIN_HITS``
such runs are enough. A window that an item repeats is compared at its first place, so
repetitive texts make no more rows than they have windows; a document must have the
window as often as the item where fewer than ``MIN_HITS`` different windows, or whole
items of verbatim ones, decide. Items of fewer than ``MIN_LITERAL`` words say too little to
be matched.

Before the join, a bitmap of fixed size, whatever the benchmark's, drops windows that
no item has; what passes is decided by the join.

Null and empty texts are clean. Documents of any length are read whole. In ``mark`` an
id may be null, repeated or text: each row is judged by its own text, under a 64-bit
key of id and text. ``find`` takes ids that are whole numbers and leaves rows without
one out; rows under one id share its findings. Item ids are whole numbers; items with
null id or text are left out. Without documents or items nothing is contaminated. Only
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import bitmaps, words
from feedloom.staging import stage

WINDOW = 8
MIN_LITERAL = 5
MIN_HITS = 3
#: Share of an alignment's windows whose slots must agree.
AGREEING = 0.8

# English number words and common units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms ounce ounces "
    "pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years dollar dollars cent cents euro euros percent mph kph degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters s h"
).split()

# Spellings of a unit by the one that stands for it; plurals in s are added below.
UNIT_STEMS = {
    "inches": "inch", "feet": "foot", "litre": "liter", "litres": "liter", "metre": "meter", "metres": "meter",
    "kilometre": "kilometer", "kilometres": "kilometer", "centimetre": "centimeter", "centimetres": "centimeter",
}
UNIT_STEMS |= {u: u[:-1] for u in UNITS if u[-1] == "s" and u[:-1] in UNITS and len(u) > 3 and u not in UNIT_STEMS}

_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0xA11CE5, 0xB0B5, 0xCAFE5))
_VERBATIM = np.uint64(0x7E47BA71)
_WINDOWS = "id long, hash long, place int, slots array<long>, verbatim boolean"


@dataclass
class Template:
    """Template words of a slice of texts: hash, document, kind of slot (0 is none) and slot value.

    ``word`` and ``word_doc`` are the lower-cased words as they stand.
    """

    hash: np.ndarray
    doc: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    word: np.ndarray
    word_doc: np.ndarray


def _known(names: list[str]) -> np.ndarray:
    return np.sort(words.split(pa.array([" ".join(names)])).hash)


def _stemmed(h: np.ndarray) -> np.ndarray:
    """Hashes of units, every spelling as its stem."""
    spelt, stems = (words.split(pa.array([" ".join(x)])).hash for x in (UNIT_STEMS, UNIT_STEMS.values()))
    order = np.argsort(spelt)
    at = np.minimum(np.searchsorted(spelt[order], h), len(spelt) - 1)
    return np.where(spelt[order][at] == h, stems[order][at], h)


def template(texts: pa.Array) -> Template:
    w = words.split(texts)
    low = words.split(words.lowered(texts))
    h = low.hash if len(low.hash) == len(w.hash) else w.hash
    n = len(h)
    if not n:
        return Template(h, w.doc, np.zeros(0, np.int64), h, h, w.doc)
    data = np.append(w.data, np.uint8(0))
    first, second = data[w.start], data[np.minimum(w.start + 1, len(data) - 1)]
    size = w.end - w.start
    digit = (first >= 48) & (first <= 57)
    number = digit | np.isin(h, _known(NUMBER_WORDS))
    latin = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    third = data[np.minimum(w.start + np.where(latin, 2, 1), len(data) - 1)]
    shout = ((third >= 65) & (third <= 90)) | ((third >= 48) & (third <= 57))
    title = (((first >= 65) & (first <= 90)) | latin) & (size > 1) & ~shout
    stops = np.zeros(256, np.int64)
    stops[list(b".!?\n\r")] = 1
    seen = np.concatenate([[0], np.cumsum(stops[w.data])])
    opens = np.ones(n, bool)
    opens[1:] = (w.doc[1:] != w.doc[:-1]) | (seen[w.start[1:]] > seen[w.end[:-1]])
    name = title & ~opens & ~number
    follows = np.zeros(n, bool)
    follows[1:] = number[:-1] & (w.doc[1:] == w.doc[:-1])
    unit = follows & np.isin(h, _known(UNITS)) & ~number
    slot = np.select([number, unit, name], [1, 2, 3], 0)
    # Parts of one number ("1,000", "2.5") and runs of names are one slot.
    joined = np.zeros(n, bool)
    near = (w.doc[1:] == w.doc[:-1]) & (w.start[1:] - w.end[:-1] == 1)
    between = data[w.end[:-1]]
    joined[1:] = near & (
        (digit[1:] & digit[:-1] & ((between == ord(".")) | (between == ord(","))))
        | (name[1:] & name[:-1] & (between == ord(" ")))
    )
    head = np.flatnonzero(~joined)
    place = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
    marks = np.array([0, _NUMBER, _UNIT, _NAME], np.uint64)
    said = np.where(unit, _stemmed(h), h)
    # Values of different kinds of slots are never equal.
    value = np.add.reduceat(words.mix(said + place.astype(np.uint64)), head) ^ marks[slot[head]]
    slot = slot[head]
    return Template(np.where(slot > 0, words.mix(marks[slot]), h[head]), w.doc[head], slot, value, h, w.doc)


def windows(t: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the windows with enough plain words."""
    frame = words.Words(t.hash, t.doc, *[t.doc] * 3, t.hash, t.doc)
    found, at = words.runs_of(frame, size)
    plain = np.concatenate([[0], np.cumsum(t.slot == 0)])
    rich = plain[at + size] - plain[at] >= MIN_LITERAL
    return found[rich] + np.uint64(size), at[rich]


def verbatim(t: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of all runs of ``size`` words as they stand."""
    frame = words.Words(t.word, t.word_doc, *[t.word_doc] * 3, t.word, t.word_doc)
    found, at = words.runs_of(frame, size)
    return words.mix(found ^ _VERBATIM) + np.uint64(size), at


def _slots(t: Template, at: np.ndarray, size: int) -> pa.ListArray:
    """Values of the slots of each window, in order."""
    place = at[:, None] + np.arange(size)
    held = t.slot[place] > 0 if len(t.slot) else np.zeros(place.shape, bool)
    offsets = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(t.value[place[held]].view(np.int64)))


def _window_rows(
    table: DataFrame, id_col: str, text_col: str, sizes: list[int] | None, bitmap: np.ndarray | None
) -> DataFrame:
    """Windows of all texts; without ``sizes`` a text shorter than a window is one window.

    ``bitmap`` drops windows whose place is not set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column("_text"))
            for a, b in words.slices(texts):
                t = template(texts.slice(a, b - a))
                ids = batch.column("_id").slice(a, b - a)
                for look, own in ((windows, t.doc), (verbatim, t.word_doc)):
                    first = np.searchsorted(own, np.arange(b - a + 1))
                    count = np.diff(first)
                    lengths = {min(int(c), WINDOW) for c in count if c >= MIN_LITERAL}
                    for size in sorted(lengths) if sizes is None else sizes:
                        found, at = look(t, size)
                        keep = np.ones(len(at), bool)
                        if sizes is None and size < WINDOW:
                            keep = count[own[at]] == size
                        if bitmap is not None:
                            keep &= bitmaps.held(bitmap, found)
                        found, at = found[keep], at[keep]
                        doc = own[at]
                        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(at) + 1, np.int32)), pa.array([], pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array(doc)),
                                pa.array(found.view(np.int64)),
                                pa.array((at - first[doc]).astype(np.int32)),
                                _slots(t, at, size) if look is windows else none,
                                pa.array(np.full(len(at), look is verbatim)),
                            ],
                            names=["id", "hash", "place", "slots", "verbatim"],
                        )

    named = table.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return words.bounded(named.where("_id IS NOT NULL AND _text IS NOT NULL")).mapInArrow(run, _WINDOWS)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and an item it holds (``id``, ``item``, ``hits``), without repeats."""
    rows = _window_rows(benchmark, item_col, item_text_col, None, None)
    # A window that an item repeats stands for itself where it is first.
    firsts = rows.groupBy("id", "hash", "verbatim").agg(
        F.min("place").alias("place"), F.min_by("slots", "place").alias("slots"), F.count_distinct("place").alias("times")
    )
    items = stage(firsts, "benchmark-windows")
    totals = items.groupBy(F.col("id").alias("item")).agg(
        F.count_if(~F.col("verbatim")).alias("n_windows"), F.count_if(F.col("verbatim")).alias("n_verbatim")
    )
    # Window lengths that occur: WINDOW and those of shorter items, fewer than WINDOW in all.
    lengths = benchmark.select(F.col(item_col).cast("long").alias("_id"), F.col(item_text_col).alias("_text"))
    sizes = sorted({WINDOW, *(r["n"] for r in _short_lengths(lengths).collect())})
    hits = _window_rows(docs, id_col, text_col, sizes, bitmaps.gather(items))
    joined = hits.select("id", "hash", F.col("place").alias("at"), F.col("slots").alias("said")).join(
        items.select(F.col("id").alias("item"), "hash", "place", "slots", "verbatim", "times"), "hash"
    )
    # Few windows match; written, they are found once for the counts and the slots.
    aligned = stage(joined.withColumn("shift", F.col("at") - F.col("place")), "benchmark-hits")
    pairs = F.transform(F.arrays_zip("slots", "said"), lambda p: F.struct(p["slots"].alias("s"), p["said"].alias("d")))
    keys = ["id", "item", "verbatim", "shift"]
    hit_counts = aligned.groupBy(*keys).agg(F.count_distinct("place").alias("hits"))
    held = aligned.select(*keys, "place", F.explode(pairs).alias("p")).select(*keys, "place", "p.s", "p.d")
    slots = held.select(*keys, "s", "d").distinct()
    uneven = (
        slots.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("s").alias("n_s")).where("n <> n_s")
    )
    # Where slots disagree, the value that stands most often on each of the item's stays.
    odd = held.join(uneven.select(*keys), keys, "left_semi").distinct()
    counted = odd.groupBy(*keys, "s", "d").agg(F.count("*").alias("n"))
    agreed = counted.groupBy(*keys, "s").agg(F.max(F.struct("n", "d"))["d"].alias("d"))
    broken = (
        odd.join(agreed, [*keys, "s", "d"], "left_anti")
        .groupBy(*keys)
        .agg(F.count_distinct("place").alias("n_broken"))
    )
    # Of a window that the item repeats, the document must have as many.
    lacking = (
        aligned.where("times > 1")
        .groupBy("id", "item", "verbatim", "hash", "times")
        .agg(F.count_distinct("at").alias("n"))
        .where("n < times")
        .select("id", "item", "verbatim", F.lit(True).alias("lacks"))
        .distinct()
    )
    few = lambda n: F.least(F.lit(MIN_HITS), n)
    least = (
        F.when(~F.col("verbatim"), few("n_windows"))
        .when(F.col("n_windows") == 0, few("n_verbatim"))
        .otherwise(F.col("n_verbatim"))
    )
    return (
        hit_counts.join(broken, keys, "left")
        .withColumns({"all": F.col("hits"), "hits": F.col("hits") - F.coalesce("n_broken", F.lit(0))})
        .where(F.col("hits") >= AGREEING * F.col("all"))
        .join(totals, "item")
        .join(lacking, ["id", "item", "verbatim"], "left")
        # Three different windows of one alignment say enough whatever is repeated.
        .where((F.col("hits") >= least) & (F.col("lacks").isNull() | (~F.col("verbatim") & (F.col("hits") >= MIN_HITS))))
        .groupBy("id", "item")
        .agg(F.max("hits").alias("hits"))
    )


def _short_lengths(items: DataFrame) -> DataFrame:
    """Lengths below ``WINDOW`` that items have, in template words or in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_array(batch.column("_text"))
            found: set[int] = set()
            for a, b in words.slices(texts):
                t = template(texts.slice(a, b - a))
                for own in (t.doc, t.word_doc):
                    found |= {int(c) for c in np.bincount(own, minlength=b - a) if MIN_LITERAL <= c < WINDOW}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["n"])

    return items.mapInArrow(run, "n long").distinct()


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document with the items it holds, in order; each row is judged by its own text, whatever its id."""
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), "text")
    keyed = docs.select("doc_id", "text", key.alias("_key"))
    found = (
        find(keyed, benchmark, "_key")
        .groupBy(F.col("id").alias("_id"))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return keyed.join(found, F.col("_key") == F.col("_id"), "left").select(
        "doc_id",
        F.col("_id").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("item_ids"),
        F.col("_id").isNull().alias("kept"),
    )
