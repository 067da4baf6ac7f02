"""BPE by forced boundaries: cuts that no merge can cross part a text into fragments.

Two neighbouring bytes that stand inside no token of the vocabulary are never
merged, so a cut between them is certain. White space stands in no token of a
vocabulary that drops it, which parts a text into short units before anything
else; a unit is normalised and cut into words as the tokenizer's file says, and
every word is cut once more at each pair of bytes that no token holds. Fragments
are encoded on their own, the last one of a word with the word's end, and their
ids are put together again. Equal units and fragments of a task are encoded once;
the memory of them is bounded and is forgotten as a whole when it is full.

Ids equal those of the library, special strings inside texts are its special
tokens, and no text is shortened. A null text is the empty text and has no ids.
Rows with null, repeated or equal ids stay rows of their own; ids may be of any
type. An empty table gives an empty result. Only the id and text columns are read,
so other columns may have any name.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import words

#: A task that remembers more bytes than this forgets them before its next slice.
MEMORY_BYTES = 128 << 20
#: A long text is encoded in runs of about so many bytes.
RUN_BYTES = 1 << 20
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: Normalisers that treat what stands between white space by itself.
_LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(0x100 + others.index(b)) for b in range(256)]


def joined_pairs(tokens: Iterable[str], suffix: str = "") -> np.ndarray:
    """Which letters (by code point) stand next to each other inside some token.

    A pair that is not marked is a forced boundary.
    """
    bare = [t[: -len(suffix)] if suffix and t.endswith(suffix) else t for t in tokens]
    held = np.zeros((0x200, 0x200), bool)
    codes = np.frombuffer("￿".join(bare).encode("utf-16-le", "surrogatepass"), "<u2")
    pairs = (codes[:-1] < 0x200) & (codes[1:] < 0x200)
    held[codes[:-1][pairs], codes[1:][pairs]] = True
    return held


def _local(normaliser: dict | None) -> bool:
    if normaliser is None:
        return True
    if normaliser["type"] == "Sequence":
        return all(map(_local, normaliser["normalizers"]))
    return normaliser["type"] in _LOCAL or normaliser.get("pattern") == {"Regex": r"\s+"}


class Codec:
    """The vocabulary of a tokenizer file, and what has been encoded with it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        odd = [t["content"] for t in said["added_tokens"] if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or odd:
            raise ValueError(f"{path} is not a BPE that fragments can be encoded with: {odd or model['type']}")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self._last = self.library.model
        self._inner = models.BPE(vocab=model["vocab"], merges=merges) if suffix else self._last
        self._held = joined_pairs(model["vocab"], suffix)
        letters = byte_letters()
        blank = [ord(letters[b]) for b in b" \t\n\r\x0b\x0c"]
        lone = not self._held[blank].any() and not self._held[:, blank].any()
        self.parts_at_space = bool(lone and suffix and _local(said["normalizer"]))
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self._special = special
        longest_first = sorted(special, key=len, reverse=True)
        self._specials = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if special else None
        self._forget()

    def _forget(self) -> None:
        self._units: dict[bytes, bytes] = {}
        self._ends: dict[str, bytes] = {}
        self._inners: dict[str, bytes] = {}
        self._bytes = 0

    def _words(self, text: str) -> list[str | int]:
        """Words in byte letters, and ids of special strings."""
        out: list[str | int] = []
        for part in self._specials.split(text) if self._specials else [text]:
            if part in self._special:
                out.append(self._special[part])
            elif part:
                out += [w for w, _ in self._cut_words(self._normal(part))]
        return out

    def _normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer else text

    def _cut_words(self, plain: str) -> list[tuple[str, tuple[int, int]]]:
        return self.library.pre_tokenizer.pre_tokenize_str(plain)

    def fragments(self, found: list[str]) -> tuple[list[str], list[int]]:
        """The words cut at every forced boundary, and the number of fragments before each word's end."""
        whole = "".join(found)
        codes = np.frombuffer(whole.encode("utf-16-le"), "<u2")
        ends = np.cumsum([len(w) for w in found])
        cut = np.ones(len(codes), bool)
        cut[:-1] = ~self._held[codes[:-1], codes[1:]]
        cut[ends - 1] = True
        stops = np.flatnonzero(cut) + 1
        firsts = np.append(0, stops[:-1])
        pieces = [whole[a:b] for a, b in zip(firsts.tolist(), stops.tolist(), strict=True)]
        return pieces, (np.searchsorted(stops, ends) + 1).tolist()

    def _ids(self, pieces: Iterable[str], last: bool) -> dict[str, bytes]:
        """Ids of fragments; they are remembered together with the units they come from."""
        known = self._ends if last else self._inners
        tokenize = (self._last if last else self._inner).tokenize
        for piece in set(pieces).difference(known):
            ids = known[piece] = array("i", [t.id for t in tokenize(piece)]).tobytes()
            self._bytes += 2 * len(piece) + len(ids) + 150
        return known

    def _ids_of_words(self, found: Iterable[str]) -> dict[str, bytes]:
        distinct = [w for w in dict.fromkeys(found) if w]
        if not distinct:
            return {}
        pieces, stops = self.fragments(distinct)
        firsts = [0, *stops[:-1]]
        ends = self._ids([pieces[b - 1] for b in stops], last=True)
        lone = {w: ends[w] for w, a, b in zip(distinct, firsts, stops, strict=True) if b - a == 1}
        cut = [(w, pieces[a : b - 1], pieces[b - 1]) for w, a, b in zip(distinct, firsts, stops, strict=True) if b - a > 1]
        inner = self._ids([p for _, before, _ in cut for p in before], last=False)
        return lone | {w: b"".join([*[inner[p] for p in before], ends[end]]) for w, before, end in cut}

    def _learn(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct units; those without special strings or odd blanks are cut into words together."""
        text = b" ".join(units).decode()
        if not self.parts_at_space or text.split() != text.split(" ") or (self._specials and self._specials.search(text)):
            odd = {u: self._words(t) for u in units if self._is_odd(t := u.decode())}
        else:
            odd = {}
        even = [u for u in units if u not in odd]
        plain = self._normal(b" ".join(even).decode())
        starts = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), "<u4") == 0x20)
        if even and len(starts) != len(even) - 1:
            raise ValueError("normalising changed the number of words")
        cut = self._cut_words(plain) if even else []
        unit = np.searchsorted(starts, [a for _, (a, _) in cut], side="right")
        firsts = np.searchsorted(unit, np.arange(len(even) + 1)).tolist()
        found = [w for w, _ in cut]
        ids = self._ids_of_words(found + [w for ws in odd.values() for w in ws if isinstance(w, str)])
        for number in self._special.values():
            ids[number] = array("i", [number]).tobytes()
        whole = [ids[w] if w else b"" for w in found]
        learnt = {u: b"".join(whole[a:b]) for u, a, b in zip(even, firsts[:-1], firsts[1:], strict=True)}
        return learnt | {u: b"".join([ids[w] for w in ws if w != ""]) for u, ws in odd.items()}

    def _is_odd(self, unit: str) -> bool:
        special = self._specials is not None and self._specials.search(unit) is not None
        return special or not self.parts_at_space or unit.split() != [unit]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, as 32-bit integers."""
        if not self.parts_at_space:
            if self._bytes > MEMORY_BYTES:
                self._forget()
            known = self._learn(list(set(texts)))
            return [known[t] for t in texts]
        split = [t.split() for t in texts]
        if self._bytes > MEMORY_BYTES:
            self._forget()
        new = list(set(chain.from_iterable(split)).difference(self._units))
        for unit, ids in self._learn(new).items() if new else ():
            self._units[unit] = ids
            self._bytes += len(unit) + len(ids) + 200
        known = self._units
        return [b"".join([known[u] for u in units]) for units in split]

    def runs(self, text: bytes) -> Iterator[bytes]:
        """A text cut at white space into runs of about ``RUN_BYTES``, where the vocabulary allows it."""
        at = 0
        while at < len(text):
            space = _SPACE.search(text, at + RUN_BYTES) if self.parts_at_space else None
            stop = space.start() if space else len(text)
            yield text[at:stop]
            at = stop

    def letters(self) -> pa.Array:
        """The string of every id."""
        size = self.library.get_vocab_size(with_added_tokens=True)
        return pa.array([self.library.id_to_token(i) for i in range(size)], pa.large_string())


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids`` (array of int) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(tokenizer)
            texts = words.text_array(batch.column("text"))
            data, offsets = words.bytes_of(texts)
            data = data.tobytes()
            for a, b in words.slices(texts):
                if b - a == 1:
                    found = [b"".join([codec.encode([x])[0] for x in codec.runs(data[offsets[a] : offsets[b]])])]
                else:
                    found = codec.encode([data[offsets[k] : offsets[k + 1]] for k in range(a, b)])
                ends = np.cumsum([0, *[len(ids) // 4 for ids in found]])
                ids = np.frombuffer(b"".join(found), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), lists], names=["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return words.bounded(rows).mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """Id, ``ids`` and the text ``decoded`` of every row of ids, special tokens included.

    A file without a decoder says that tokens are written with a space between them.
    """
    rows = encoded.select(F.col(id_col).alias("id"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = letters = None
        for batch in batches:
            codec = codec or Codec(tokenizer)
            ids = batch.column("ids")
            if codec.library.decoder is None:
                letters = codec.letters() if letters is None else letters
                spelt = pa.LargeListArray.from_arrays(
                    pc.cast(ids.offsets, pa.int64()), letters.take(ids.values.cast(pa.int64()))
                )
                texts = pc.binary_join(spelt, pa.scalar(" ", pa.large_string())).cast(pa.string())
            else:
                texts = pa.array([codec.library.decode(x, skip_special_tokens=False) for x in ids.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids, texts], names=["id", "ids", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    out = words.bounded(rows).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")
