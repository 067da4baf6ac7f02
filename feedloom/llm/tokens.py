"""Token counts through a digest cache.

Contents are known by their SHA-256, tokenizers by the SHA-256 of their file and
the version of their library. Counts that the cache holds are joined; each
distinct content that it lacks is encoded once, by the row with the lowest id,
and appended. The only normalisation is that a null text is the empty text:
anything more would change counts.

Ids that are null or repeated are rows like others, and equal texts share their
count. Empty texts have no token. Texts of any length are counted whole, in
batches of bounded bytes. An empty table gives an empty result. Only the id and
text columns are read. What a run appends appears by one rename: a run that fails adds
nothing, runs may append at once, and counts that two of them append for the same
content agree and are read once.

The common byte-level pattern cuts texts into words by their classes of characters, so
that a word surely ends where a Latin or Cyrillic letter, an ASCII digit or mark meets
another of these, and before a blank that follows anything but white space. Texts are
cut there into units whose counts add up to the count of the text, and each distinct
unit that a worker does not remember is handed to the library once. The memory is
bounded; when it is full, units met in one batch only are forgotten. Tokenizers that say
anything else of their words, and those of ``sentencepiece``, are given whole texts.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import commits
from feedloom.llm import bpe, words
from feedloom.staging import staging_root

_CACHE = "content binary, tokenizer binary, n_tokens long"
_BATCH_BYTES = 1 << 20
#: A worker that remembers units of more bytes than this forgets the rare ones before its next batch.
MEMORY_BYTES = 8 << 20
#: Longer units go through the whole tokenizer and are not remembered.
_UNIT_BYTES = 64
_LETTER, _DIGIT, _MARK, _QUOTE, _BLANK, _WIDE = range(1, 7)
#: White space beyond ASCII, by its bytes as one number; the Mongolian separator counted as such once.
_WIDE_BLANKS = [
    int.from_bytes(chr(c).encode("utf-8", "surrogatepass")) for c in range(0x80, 0x10000) if chr(c).isspace() or c == 0x180E
]
#: First bytes of letters of two bytes; only the signs of multiplication and division are none.
_LETTER_LEADS = [*range(0xC3, 0xCA), 0xD0, 0xD1]
#: Units that are one word of the pattern, whatever stands around them.
_ONE_WORD = r"^ ?(?:[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{400}-\x{47F}]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)$"
#: Units that may hold white space other than a first blank.
_ODD = r"[\x00-\x1F]|. |^ *$|[\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _classes() -> bytes:
    table = bytearray(256)
    for c in range(0x21, 0x7F):
        table[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _MARK
    table[ord("'")], table[ord(" ")] = _QUOTE, _BLANK
    table[0x80:] = bytes([_WIDE]) * 0x80
    return bytes(table)


def _cuts(between_words: bool) -> np.ndarray:
    """Whether a unit ends between two classes, by ``8 * class + next class``.

    A quote may begin an ending like 's with the letters behind it, and goes with marks.
    """
    table = np.zeros((8, 8), bool)
    table[[_LETTER, _DIGIT, _MARK, _QUOTE, _WIDE], _BLANK] = True
    if between_words:
        table[_LETTER, [_DIGIT, _MARK, _QUOTE]] = True
        table[_DIGIT, [_LETTER, _MARK, _QUOTE]] = True
        table[_MARK, [_LETTER, _DIGIT]] = True
    return table.ravel()


_CLASSES = _classes()
_IS_LEAD = np.isin(np.arange(256), _LETTER_LEADS)
_CUTS = {kind: _cuts(kind) for kind in (False, True)}


def tokenizer_digest(path: str) -> bytes:
    """Digest of a tokenizer file and of the library that reads it."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library} {version(library)}\n".encode() + file.read()).digest()


def _parts_at_blanks(said: dict) -> bool:
    """Whether a tokenizer's file says that no token joins a blank to something other than white space before it."""
    words_as = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    cutter = said.get("pre_tokenizer") or {}
    odd = [
        t
        for t in said.get("added_tokens") or []
        if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])
    ]
    plain = said.get("normalizer") is None and said["model"]["type"] == "BPE" and not said["model"].get("dropout")
    return plain and not odd and all(cutter.get(k) == v for k, v in words_as.items())


def unit_starts(data: np.ndarray, offsets: np.ndarray, between_words: bool = True) -> np.ndarray:
    """First bytes of the units of UTF-8 texts that lie side by side; without ``between_words`` only blanks begin units."""
    kind = np.frombuffer(bytearray(data.tobytes().translate(_CLASSES)), np.uint8)
    lead = np.flatnonzero(_IS_LEAD[data])
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kind[lead] = kind[lead + 1] = _LETTER
    starts = np.zeros(len(data), bool)
    starts[1:] = _CUTS[between_words][(kind[:-1] << 3) | kind[1:]]
    at = np.flatnonzero(starts[1:] & (kind[:-1] == _WIDE)) + 1
    last = data[at - 1].astype(np.int64) | data[np.maximum(at - 2, 0)].astype(np.int64) << 8
    longer = last | data[np.maximum(at - 3, 0)].astype(np.int64) << 16
    starts[at[np.isin(last, _WIDE_BLANKS) | np.isin(longer, _WIDE_BLANKS)]] = False
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(starts)


class UnitCounts:
    """Token counts of texts as sums over their units; a unit that is remembered is not encoded again."""

    def __init__(self, library, special: list[str]):
        self._library = library
        self._special = [s.encode() for s in special]
        self._letters = str.maketrans(dict(enumerate(bpe.byte_letters())))
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.large_binary())
        self._counts = np.zeros(0, np.int64)
        self._again = np.zeros(0, bool)

    def _forget_rare(self) -> None:
        """Keep the units that were met again; where they are most of the memory too, forget them all."""
        often = self._again
        self._known, self._counts = self._known.filter(pa.array(often)), self._counts[often]
        self._again = np.zeros(len(self._counts), bool)
        if self._known.nbytes > MEMORY_BYTES // 2:
            self._forget()

    def _of_words(self, found: list[str]) -> list[int]:
        """Counts of words in byte letters."""
        tokenize = self._library.model.tokenize
        return [len(tokenize(w)) for w in found]

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Counts of distinct units."""
        counts = np.zeros(len(units), np.int64)
        units = units.cast(pa.large_string())
        one = pc.match_substring_regex(units, _ONE_WORD)
        odd = pc.or_(pc.match_substring_regex(units, _ODD), pc.greater(pc.binary_length(units), _UNIT_BYTES))
        for s in self._special:
            odd = pc.or_(odd, pc.match_substring(units, s.decode()))
        one = pc.and_not(one, odd).to_numpy(zero_copy_only=False)
        odd = odd.to_numpy(zero_copy_only=False)
        if one.any():
            lines = "\n".join(units.filter(pa.array(one)).to_pylist()).encode()
            counts[one] = self._of_words(lines.decode("latin-1").translate(self._letters).split("Ċ"))
        if odd.any():
            whole = self._library.encode_batch_fast(units.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)
            counts[odd] = [len(e) for e in whole]
        even = np.flatnonzero(~one & ~odd)
        if len(even):
            # A line's end is a word of its own before and behind anything but white space.
            lines = "\n".join(units.take(pa.array(even)).to_pylist())
            found = [w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(lines)]
            ends = np.array([w == "Ċ" for w in found])
            if ends.sum() != len(even) - 1:
                raise ValueError("the tokenizer joins lines")
            lengths = np.where(ends, 0, self._of_words(found))
            counts[even] = np.add.reduceat(lengths, np.append(0, np.flatnonzero(ends)))
        return counts

    def _of_units(self, units: pa.Array) -> np.ndarray:
        """Counts of distinct units."""
        if self._known.nbytes > MEMORY_BYTES:
            self._forget_rare()
        place = pc.index_in(units, self._known)
        new = place.is_null()
        counts = np.zeros(len(units), np.int64)
        old = place.is_valid().to_numpy(zero_copy_only=False)
        place = place.drop_null().to_numpy()
        counts[old] = self._counts[place]
        self._again[place] = True
        learnt = units.filter(new)
        counts[~old] = found = self._learn(learnt)
        short = pc.less_equal(pc.binary_length(learnt), _UNIT_BYTES)
        self._known = pa.concat_arrays([self._known, learnt.filter(short)])
        found = found[short.to_numpy(zero_copy_only=False)]
        self._counts = np.append(self._counts, found)
        self._again = np.append(self._again, np.zeros(len(found), bool))
        return counts

    def __call__(self, texts: pa.Array) -> np.ndarray:
        data, offsets = words.bytes_of(texts)
        whole = data.tobytes()
        starts = unit_starts(data, offsets, not any(s in whole for s in self._special))
        ends = np.append(starts, len(data)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(whole)]
        ).dictionary_encode()
        counts = self._of_units(units.dictionary)
        sums = np.append(0, np.cumsum(counts[units.indices.to_numpy()]))
        return np.diff(sums[np.searchsorted(starts, offsets)])


@functools.lru_cache(maxsize=2)
def counter(path: str, digest: bytes = b"") -> Callable[[pa.Array], np.ndarray]:
    """A function from an array of texts to their token counts, for .json and .model files.

    A worker keeps it, and what it remembers, from task to task; a file of another digest is read anew.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        if _parts_at_blanks(said):
            return UnitCounts(tokenizer, [t["content"] for t in said.get("added_tokens") or []])

        def count(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def count(texts: list[str]) -> list[int]:
            return [len(ids) for ids in model.encode(texts, num_threads=1)]

    def in_slices(texts: pa.Array) -> np.ndarray:
        slices = words.slices(texts, _BATCH_BYTES)
        return np.array([n for a, b in slices for n in count(texts.slice(a, b - a).to_pylist())], np.int64)

    return in_slices


def lasting_cache(spark: SparkSession, tokenizer: str) -> str:
    """The folder of a tokenizer's counts under the session's shared folder; it outlives the application."""
    return f"{staging_root(spark)}/token-counts/{tokenizer_digest(tokenizer).hex()}"


def stored_counts(spark: SparkSession, cache: str) -> DataFrame:
    """All counts that finished runs have appended to a cache."""
    runs = commits.numbered(spark, cache, "run")
    if not runs:
        return spark.createDataFrame([], _CACHE)
    return spark.read.schema(_CACHE).option("basePath", cache).parquet(*[f"{cache}/{r}" for r in runs.values()]).drop("run")


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, ``n_bytes`` and ``n_tokens`` of every row; misses are appended to the cache folder.

    The cache is written while the plan is built, so that its rows outlive lost
    executors and later runs find them.
    """
    spark = docs.sparkSession
    digest = tokenizer_digest(tokenizer)
    file_digest = F.lit(bytearray(digest))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col), F.unhex(F.sha2(text, 256)).alias("_content"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    known = stored_counts(spark, cache).where(F.col("tokenizer") == file_digest).select(F.col("content").alias("_content"))
    misses = (
        keyed.groupBy("_content")
        .agg(F.min(id_col).alias("_first"))
        .join(known, "_content", "left_anti")
        .select(F.col("_content").alias("_missed"), "_first")
    )
    texts = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_content", F.unhex(F.sha2("_text", 256)))
    chosen = texts.join(misses, (F.col("_content") == F.col("_missed")) & F.col("_id").eqNullSafe(F.col("_first")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(tokenizer, digest)
            numbers = pa.array(count(words.text_array(batch.column("_text"))))
            yield pa.RecordBatch.from_arrays([batch.column("_content"), numbers], names=["content", "n_tokens"])

    encoded = (
        words.bounded(chosen.select("_content", "_text"))
        .mapInArrow(encode, "content binary, n_tokens long")
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
        .select("content", file_digest.alias("tokenizer"), "n_tokens")
    )
    written = commits.attempt(encoded, cache)
    if spark.read.schema(_CACHE).parquet(written).isEmpty():
        commits.remove(spark, written)
    else:
        commits.rename(spark, written, f"{cache}/run=r{uuid.uuid4().hex}")
    counts = (
        stored_counts(spark, cache)
        .where(F.col("tokenizer") == file_digest)
        .groupBy(F.col("content").alias("_content"))
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keyed.join(counts, "_content").select(id_col, "n_bytes", "n_tokens")
