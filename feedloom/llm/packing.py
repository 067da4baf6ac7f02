"""Lexical retrieval packing with a sharded BM25 index.

The document frequencies of hashed terms and the mean length are counted over
all documents first (a table of ``2 ** BITS`` numbers). Then every document is
tokenised once and signed: two of its terms, each drawn by a hash with odds of
its squared idf, so documents draw the same term with the chance of their
weighted overlap. Documents are shuffled by the first, sorted by both, and cut
in this order into shards of bounded bytes and documents: those that share
telling content lie side by side, and a term that many documents draw goes on
over several shards. Rows travel as ids and terms; texts do not. Partitions that one
term makes too large are split by adaptive execution; without it documents stay
in the partitions they were read in, which costs neighbours and nothing else.

In its shard whole windows are cut from a document's front, its tail waits.
Tails are then seeds in the order of the shard: the inverted index scores all
documents by all terms they share with the seed, unused ones of a score above 0
follow, best first, and their tails fill the window greedily; the last one is cut
to fit and its rest waits again. If no neighbour is left, the next waiting tail in
order is taken; a window that the shard cannot fill goes on in the next shard. So
every sequence is full but the last of each partition, and no token is lost or
repeated.

Null and empty texts are one end token. Very long texts are encoded in pieces
that end where no token can. Repeated rows are documents of their own, ties go
to the lower place in order, null ids come first. An empty table gives no
piece. Only the id and text columns are read. A partition lost with an executor is
packed again to the same pieces: its rows are sorted before anything else, and
weights lie on a grid of 2 ** -24, so that their sums are exact in any order.
"""

from __future__ import annotations

import base64
import json
import math
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import words

BITS = 18
WINDOW = 1024
END_ID = 0
#: Bytes of ids and terms, and documents, that a shard holds at most, but one document at least.
SHARD_BYTES = 4 << 20
SHARD_DOCS = 2048
#: Partitions at most; beyond, they grow.
MOST_PARTITIONS = 100_000
K1, B = 1.2, 0.75
_FIRST_LOOK = 32
_TERM_BITS = 32
_GRID = float(1 << 24)
_SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
#: Pairs of postings that are added up at once, and terms of a block of the product.
_PAIRS = 1 << 21
_BLOCK = 1024
_END = END_ID.to_bytes(4, "little")
_PIECE_CHARS = 1 << 20
#: Characters of white space in a row from which on the faster library is not asked: its pattern may run out of stack.
_LONG_BLANK = 50_000
_BLANKS = re.compile(r"\s{2,}")
_SAFE_CUT = re.compile(r"(?<=[^\W\d_])(?= [^\W\d_])")


def _safe_pieces(text: str) -> Iterator[str]:
    """Pieces of a long text, cut between a letter and a blank before a letter."""
    at = 0
    while len(text) - at > _PIECE_CHARS:
        cut = _SAFE_CUT.search(text, at + _PIECE_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _long_blank(text: str) -> bool:
    return len(text) > _LONG_BLANK and any(m.end() - m.start() > _LONG_BLANK for m in _BLANKS.finditer(text))


def encoder(json_path: str, ranks_path: str | None = None, pattern: str | None = None):
    """A function from a text to the ids that the ``tokenizers`` library gives it.

    ``ranks_path`` may name the same byte-level vocabulary as ranks, with the
    pattern that splits texts before the merges; plain texts are then encoded by
    the faster library with equal ids. Texts with a special string or a very long
    run of white space always go to ``tokenizers`` itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = []

    def exact(text: str) -> np.ndarray:
        if not loaded:
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(json_path))
            loaded[0].no_truncation()
            loaded[0].no_padding()
        return np.array(loaded[0].encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks_path is None:
        return exact
    import tiktoken

    with open(json_path, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file)["added_tokens"]]
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or _long_blank(text):
            return exact(text)
        ids = array("I")
        for piece in _safe_pieces(text):
            ids.extend(array("I", fast.encode_ordinary(piece)))
        return np.frombuffer(ids, np.uint32)

    return encode


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int, int, int]:
    """Per hashed term the documents that hold it; documents, words and bytes in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((1 << BITS) + 3, np.int64)
        for batch in batches:
            texts = words.text_array(batch.column(0))
            for a, b in words.slices(texts):
                w = words.split(words.lowered(texts.slice(a, b - a)))
                _, bucket, _ = words.tallies(w.doc, w.hash >> np.uint64(64 - BITS), BITS)
                found[: 1 << BITS] += np.bincount(bucket, minlength=1 << BITS)
                found[1 << BITS :] += [b - a, len(w.hash), len(w.data)]
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["place", "n"])

    # At most 2 ** BITS + 3 rows, whatever the number of documents.
    total = words.bounded(docs.select(text_col)).mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros((1 << BITS) + 3, np.int64)
    table = total.toArrow()
    out[table.column("place").to_numpy()] = table.column("n").to_numpy()
    n_docs, n_words, n_bytes = (int(x) for x in out[1 << BITS :])
    return out[: 1 << BITS], n_docs, n_words, n_bytes


class Index:
    """BM25 scores of the documents of one shard, with statistics of the whole corpus.

    ``idf`` is looked up by the highest bits of a term, as ``shift`` says.
    """

    def __init__(
        self,
        doc: np.ndarray,
        term: np.ndarray,
        tf: np.ndarray,
        length: np.ndarray,
        idf: np.ndarray,
        mean: float,
        shift: int = 0,
    ):
        self.n_docs = len(length)
        norm = K1 * (1 - B + B * length / max(mean, 1e-9))
        weight = idf[term >> shift] * tf * (K1 + 1) / (tf + norm[doc])
        # Distinct keys that hold their entry sort faster than an order of entries.
        key = np.sort((term.astype(np.uint64) << np.uint64(32)) | np.arange(len(term), dtype=np.uint64))
        order = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        key >>= np.uint64(32)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.docs = doc[order].astype(np.int64)
        self.weights = np.rint(weight[order].astype(np.float64) * _GRID) / _GRID
        self.first = first
        self.holders = np.diff(np.append(first, len(key)))
        self._all = self._by_rare_terms()
        self._add_common_terms()

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all documents of the shard for the terms of ``seed``, each counted once."""
        return self._all[seed]

    def _common(self) -> int:
        """Documents from which on a term is common: it takes a column of a matrix, not a list of pairs."""
        return max(16, self.n_docs // 16)

    def _by_rare_terms(self) -> np.ndarray:
        n = self.n_docs
        total = np.zeros(n * n)
        keys, weights, size = [], [], 0
        # A term that one document of the shard holds leads nowhere.
        for held in range(2, min(self._common(), self.holders.max(initial=0) + 1)):
            terms = self.first[self.holders == held]
            step = max(1, _PAIRS // held**2)
            for k in range(0, len(terms), step):
                at = terms[k : k + step, None] + np.arange(held)
                d = self.docs[at]
                keys.append((d[:, :, None] * n + d[:, None, :]).ravel())
                weights.append(np.repeat(self.weights[at][:, None, :], held, axis=1).ravel())
                size += len(keys[-1])
                if size >= _PAIRS:
                    total += np.bincount(np.concatenate(keys), np.concatenate(weights), n * n)
                    keys, weights, size = [], [], 0
        if size:
            total += np.bincount(np.concatenate(keys), np.concatenate(weights), n * n)
        return total.reshape(n, n)

    def _add_common_terms(self) -> None:
        common = np.flatnonzero(self.holders >= self._common())
        for k in range(0, len(common), _BLOCK):
            block = common[k : k + _BLOCK]
            held = self.holders[block]
            column = np.repeat(np.arange(len(block)), held)
            at = np.repeat(self.first[block] - (np.cumsum(held) - held), held) + np.arange(len(column))
            weight = np.zeros((self.n_docs, len(block)))
            weight[self.docs[at], column] = self.weights[at]
            self._all += (weight > 0).astype(np.float64) @ weight.T


@dataclass
class Cursor:
    """The sequence that is being filled. Numbers never repeat in a partition; ``base`` is added to new ones."""

    base: int = 0
    free: int = 0
    sequence: int = 0
    used: int = 0

    def new(self) -> int:
        self.free += 1
        return self.base + self.free - 1


def fill(sizes: np.ndarray, index: Index, window: int, cursor: Cursor) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; the last window may stay open."""
    left = sizes % window
    for d in np.flatnonzero(sizes >= window):
        for start in range(0, int(sizes[d] - left[d]), window):
            yield int(d), start, window, cursor.new(), 0
    unused = left > 0
    waiting = 0
    for seed in range(len(sizes)):
        while unused[seed]:
            ranked: Iterator[int] | None = None
            d = seed
            while d >= 0:
                if not cursor.used:
                    cursor.sequence = cursor.new()
                took = int(min(left[d], window - cursor.used))
                yield d, int(sizes[d] - left[d]), took, cursor.sequence, cursor.used
                left[d] -= took
                unused[d] = left[d] > 0
                cursor.used = (cursor.used + took) % window
                if not cursor.used:
                    break
                ranked = ranked or _neighbours(index.scores(seed), unused)
                d = next((x for x in ranked if unused[x]), -1)
                if d < 0:
                    while waiting < len(sizes) and not unused[waiting]:
                        waiting += 1
                    d = waiting if waiting < len(sizes) else -1


def _neighbours(scores: np.ndarray, unused: np.ndarray) -> Iterator[int]:
    """Unused documents that share a term, by falling score and rising place."""
    found = np.flatnonzero((scores > 0) & unused)
    first = found
    if len(found) > _FIRST_LOOK:
        least = np.partition(scores[found], -_FIRST_LOOK)[-_FIRST_LOOK]
        first = found[scores[found] >= least]
        found = found[scores[found] < least]
    else:
        found = found[:0]
    yield from first[np.lexsort((first, -scores[first]))].tolist()
    if len(found):
        yield from found[np.lexsort((found, -scores[found]))].tolist()


def _least(doc: np.ndarray, value: np.ndarray, term: np.ndarray, n_docs: int) -> np.ndarray:
    """The term of least value of every document, mixed; 0 for documents without terms."""
    out = np.zeros(n_docs, np.uint64)
    if len(doc):
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        least = np.repeat(np.minimum.reduceat(value, first), np.diff(np.append(first, len(doc))))
        at = np.flatnonzero(value == least)[::-1]
        out[doc[at]] = words.mix(term[at].astype(np.uint64))
    return out.view(np.int64)


def signatures(doc: np.ndarray, term: np.ndarray, idf: np.ndarray, n_docs: int) -> list[np.ndarray]:
    """Two terms of every document, drawn by hash with odds of the squared idf (``doc`` in order)."""
    odds = idf[term >> (_TERM_BITS - BITS)].astype(np.float64) ** 2 + 1e-12
    out = []
    for salt in _SALTS:
        even = ((words.mix(term.astype(np.uint64) ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        out.append(_least(doc, -np.log(even) / odds, term, n_docs))
    return out


def _binary(parts: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Runs of an array as binary values; ``begins`` ends with the length."""
    offsets = pa.py_buffer((begins * parts.itemsize).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, offsets, pa.py_buffer(parts)]).cast(pa.binary())


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as the largest needs: 1, 2 or 4."""
    top = int(values.max(initial=0))
    return values.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def _shards(batches: Iterator[pa.RecordBatch], most_bytes: int, most_docs: int) -> Iterator[pa.Table]:
    """Rows in order, cut into tables of at most these bytes and rows, but one row at least."""
    held, count, size = [], 0, 0
    for batch in batches:
        row_bytes = sum(np.diff(words.bytes_of(batch.column(n))[1]) for n in ("_ids", "_terms", "_tf"))
        first = 0
        for k, n in enumerate(row_bytes.tolist()):
            if count and (size + n > most_bytes or count == most_docs):
                yield pa.Table.from_batches([*held, batch.slice(first, k - first)])
                held, count, size, first = [], 0, 0, k
            count, size = count + 1, size + n
        held.append(batch.slice(first))
    if count:
        yield pa.Table.from_batches(held)


def _shard_index(shard: pa.Table, idf: np.ndarray, mean: float) -> Index:
    terms, counts, number = [], [], []
    for t, c in zip(shard.column("_terms").to_pylist(), shard.column("_tf").to_pylist(), strict=True):
        terms.append(np.frombuffer(t, "<u4"))
        number.append(len(terms[-1]))
        counts.append(np.frombuffer(c, f"<u{len(c) // max(number[-1], 1) or 1}"))
    doc = np.repeat(np.arange(len(number)), number)
    term = np.concatenate(terms).astype(np.int64)
    length = shard.column("_words").to_numpy()
    return Index(doc, term, np.concatenate(counts).astype(np.float64), length, idf, mean, _TERM_BITS - BITS)


def sign_and_encode(
    docs: DataFrame, idf: np.ndarray, json_path: str, ranks_path: str | None, pattern: str | None
) -> DataFrame:
    """Per document (columns id and text): signature, ids, distinct terms with their counts, number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, pattern)
        for batch in batches:
            texts = words.text_array(batch.column(1))
            for a, b in words.slices(texts):
                part = texts.slice(a, b - a)
                w = words.split(words.lowered(part))
                doc, term, tf = words.tallies(w.doc, w.hash >> np.uint64(64 - _TERM_BITS), _TERM_BITS)
                begins = np.searchsorted(doc, np.arange(b - a + 1))
                ids = [_narrow(encode(text.as_py())) for text in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        *[pa.array(x) for x in signatures(doc, term, idf, b - a)],
                        pa.array([x.itemsize for x in ids], pa.int32()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        _binary(term.astype("<u4"), begins),
                        _binary(_narrow(tf), begins),
                        pa.array(np.bincount(w.doc, minlength=b - a), pa.int64()),
                    ],
                    names=schema.names,
                )

    fields = {"_first": T.LongType(), "_second": T.LongType(), "_width": T.IntegerType(), "_ids": T.BinaryType()}
    fields |= {"_terms": T.BinaryType(), "_tf": T.BinaryType(), "_words": T.LongType()}
    schema = T.StructType([T.StructField("_id", docs.schema[0].dataType)] + [T.StructField(n, t) for n, t in fields.items()])
    return words.bounded(docs).mapInArrow(run, schema)


def deal(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, np.ndarray, float]:
    """Signed and encoded documents in the order that shards are cut from; idf by term bucket; mean length.

    A partition is about one shard, so that terms part well. Adaptive execution merges
    partitions up to its advisory size, and splits those that one term makes larger.
    """
    frequency, n_docs, n_words, n_bytes = document_frequencies(docs, text_col)
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    # What one document holds leads nowhere, and no signature should rest on it.
    idf[frequency < 2] = 0
    partitions = min(math.ceil((n_bytes + 64 * n_docs) / shard_bytes), MOST_PARTITIONS)
    own = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    signed = sign_and_encode(own, idf, json_path, ranks_path, pattern)
    dealt = signed.hint("rebalance", max(partitions, 1), "_first")
    return dealt.sortWithinPartitions("_first", "_second", "_id", "_ids"), idf, n_words / max(n_docs, 1)


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their token ids (little-endian, four bytes each)."""
    ordered, idf, mean = deal(docs, json_path, ranks_path, pattern, shard_bytes, id_col, text_col)
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 43
        cursor = Cursor()
        for number, shard in enumerate(_shards(batches, shard_bytes, SHARD_DOCS)):
            names = shard.column("_id").combine_chunks()
            widths = shard.column("_width").to_pylist()
            tokens = [np.frombuffer(x, f"<u{n}") for x, n in zip(shard.column("_ids").to_pylist(), widths, strict=True)]
            sizes = np.array([len(t) + 1 for t in tokens], np.int64)
            index = _shard_index(shard, idf, mean)
            del shard
            # The shard where a sequence begins is noted above its number.
            cursor.base = base | (number & 2047) << 32
            pieces: list[tuple[int, int, int, int, int]] = []
            for piece in fill(sizes, index, window, cursor):
                pieces.append(piece)
                if len(pieces) == 4096:
                    yield batch(names, tokens, sizes, pieces)
                    pieces = []
            if pieces:
                yield batch(names, tokens, sizes, pieces)

    def batch(names, tokens, sizes, pieces) -> pa.RecordBatch:
        d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        ids = [
            tokens[k][s : s + n].astype("<u4").tobytes() + (_END if s + n == sizes[k] else b"") for k, s, n, _, _ in pieces
        ]
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(d)),
                *[pa.array(x) for x in (start, length, sizes[d], sequence, offset)],
                pa.array(ids, pa.binary()),
            ],
            names=schema.names,
        )

    return words.bounded(ordered).mapInArrow(run, schema)
