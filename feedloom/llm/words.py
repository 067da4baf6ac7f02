"""Words of whole texts as numpy columns: 64-bit hashes, documents, byte places.

A word is a run of letters and digits; bytes of other scripts count as letters,
and every character of a script that is written without spaces is a word of its
own. With ``marks`` a run of punctuation is a word too. Texts are cut into
slices of about a MB and hashed in short byte segments, so memory follows the
slice, not the text; a text is never shortened.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
#: Most bytes of rows that tasks of these operators are handed at once.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_SEGMENT = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

# The two lowest bits say what a byte belongs to; a lone character begins a word of its own.
SPACE, WORD, MARK, LONE = 0, 1, 2, 5
_KIND = 3


def _classes(marks: bool) -> np.ndarray:
    table = np.full(256, MARK if marks else SPACE, np.uint8)
    table[list(b" \t\n\r\x0b\x0c\x00")] = SPACE
    for low, high in ((b"0", b"9"), (b"a", b"z"), (b"A", b"Z")):
        table[low[0] : high[0] + 1] = WORD
    table[0x80:] = WORD
    table[0xE3:0xEA] = LONE
    return table


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base & _MASK, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words in text order; ``doc`` counts from the first text of the slice."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def first_words(self) -> np.ndarray:
        """Index of each document's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def bounded(rows: DataFrame) -> DataFrame:
    """The same rows, in a session that hands tasks batches of ``BATCH_BYTES`` at most.

    Batches are bounded by rows alone otherwise, and long texts fill a worker's memory.
    """
    rows.sparkSession.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return rows


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and each text's offsets in them."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[places[0] : places[-1]]
    return raw, places - places[0]


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array in which null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer text is a range of its own."""
    _, offsets = bytes_of(texts)
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield at, stop
        at = stop


def split(texts: pa.Array, marks: bool = False) -> Words:
    """The words of a slice of texts, hashed as they stand (lower the texts before)."""
    data, offsets = bytes_of(texts)
    kind = _classes(marks)[data]
    other = MARK if marks else SPACE
    lead = np.flatnonzero(data == 0xE2)
    lead = lead[lead + 2 < len(data)]
    lead = lead[(data[lead + 1] == 0x80) | (data[lead + 1] == 0x81)]
    for k in range(3):
        kind[lead + k] = other
    lead = np.flatnonzero(data == 0xC2)
    for k in range(2):
        kind[lead[lead + k < len(data)] + k] = other
    group = kind & _KIND
    begins = np.ones(len(data), bool)
    np.not_equal(group[1:], group[:-1], out=begins[1:])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    if kind.max(initial=0) == LONE:
        begins |= kind == LONE
    runs = np.flatnonzero(begins)
    ends = np.append(runs[1:], len(data)) if len(runs) else runs
    own = group[runs] != SPACE
    start, end = runs[own], ends[own]
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(_hashes(data, start, end), doc, start, end, group[start], data, offsets)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    at = 0
    powers = _powers(min(_SEGMENT, len(data)) or 1)
    while at < len(start):
        base = start[at]
        stop = max(int(np.searchsorted(end, base + _SEGMENT, side="right")), at + 1)
        size = int(end[stop - 1] - base)
        up, down = powers if size <= _SEGMENT else _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        sums[1:] = data[base : base + size]
        sums[1:] += np.uint64(1)
        sums[1:] *= up[:size]
        np.cumsum(sums, out=sums)
        s = start[at:stop] - base
        out[at:stop] = (sums[end[at:stop] - base] - sums[s]) * down[s]
        at = stop
    return mix(out)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def runs_of(words: Words, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words in one document, and the first word of each."""
    h = words.hash if hashes is None else hashes
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + h[k : k + n]
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return mix(total[at]), at


def stems(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of every longer word, and those words."""
    at = np.flatnonzero(words.end - words.start > size)
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + words.data[words.start[at] + k]
    return mix(total), at


def tallies(doc: np.ndarray, bucket: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs in order, and how often each occurs."""
    key = (doc.astype(np.uint64) << np.uint64(bits)) | bucket.astype(np.uint64)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64), count
