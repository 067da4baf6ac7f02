"""Chat formatting by columnar byte assembly.

Turns become ``<|im_start|>role``, a newline, the text, ``<|im_end|>`` and a
newline. Inside roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``, in roles a newline becomes ``\\n``, so no text can forge a marker and
``read_back`` restores every text. Of a batch of turns, segment lengths and
cumulative offsets are computed in numpy; headers and contents are scattered
into one preallocated buffer that becomes an Arrow column without a copy.

A conversation is the rows of one id in turn order, ties in order of role and
text, so equal rows all stay. Its rows meet in one sorted, spilled partition and
are streamed: a conversation longer than a batch continues in further parts, in
no task is it held whole. Null roles and texts are empty, a null id is a
conversation of its own, null turns come first. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import words

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNT_ROLE = "assistant"
#: Turns assembled into one part at most about this many bytes long (one turn may be longer).
PART_BYTES = 8 << 20
PARTS = "conv_id long, part long, text string, loss array<struct<start:long,end:long>>"


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "<|", "<\\|")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    pieces = text.split("\\\\")
    return "\\".join(p.replace("\\|", "|").replace("\\n", "\n") for p in pieces)


def _fixed(out: np.ndarray, at: np.ndarray, text: str) -> None:
    raw = np.frombuffer(text.encode(), np.uint8)
    out[at[:, None] + np.arange(len(raw))] = raw


def _scattered(out: np.ndarray, at: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> None:
    size = np.diff(offsets)
    out[np.arange(len(raw)) + np.repeat(at - offsets[:-1], size)] = raw


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns as bytes, the offset of each turn, and the place of each escaped text."""
    role = pc.replace_substring(escape(roles), "\n", "\\n")
    role_raw, role_at = words.bytes_of(role)
    text_raw, text_at = words.bytes_of(escape(texts))
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(len(START) + role_size + 1 + text_size + len(END))
    turn_at = np.concatenate([[0], ends])
    begin = turn_at[:-1]
    out = np.empty(int(turn_at[-1]), np.uint8)
    text_begin = begin + len(START) + role_size + 1
    _fixed(out, begin, START)
    _scattered(out, begin + len(START), role_raw, role_at)
    out[text_begin - 1] = ord("\n")
    _scattered(out, text_begin, text_raw, text_at)
    _fixed(out, text_begin + text_size, END)
    return out, turn_at, text_begin


def _char_place(raw: np.ndarray) -> np.ndarray:
    """Number of code points before each byte."""
    return np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Formatted conversations in parts, in order of ``part`` within an id.

    ``loss`` holds the code point ranges of the part that a model learns from:
    the escaped texts of the assistant, without headers or end marks.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            all_texts = words.text_array(batch.column("text"))
            for a, b in words.slices(all_texts, PART_BYTES):
                roles = words.text_array(batch.column("role")).slice(a, b - a)
                raw, turn_at, text_at = assemble(roles, all_texts.slice(a, b - a))
                chars = _char_place(raw)
                ids = batch.column("conv_id").slice(a, b - a).to_pylist()
                learnt = pc.equal(roles, LEARNT_ROLE).to_numpy(zero_copy_only=False)
                text_end = turn_at[1:] - len(END)
                first = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]]
                numbers, spans = [], []
                for k, stop in zip(first, [*first[1:], len(ids)], strict=True):
                    part = part + 1 if ids[k] == last else 0
                    last = ids[k]
                    numbers.append(part)
                    own = [t for t in range(k, stop) if learnt[t]]
                    base = chars[turn_at[k]]
                    spans.append([{"start": int(chars[text_at[t]] - base), "end": int(chars[text_end[t]] - base)} for t in own])
                offsets = turn_at[[*first, len(ids)]]
                texts = pa.LargeStringArray.from_buffers(
                    len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[k] for k in first], pa.int64()),
                        pa.array(numbers, pa.int64()),
                        texts.cast(pa.string()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names=["conv_id", "part", "text", "loss"],
                )

    return ordered.mapInArrow(run, PARTS)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a part, found by its markers and unescaped."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        cut = text.index("\n", at)
        end = text.index(END, cut)
        yield unescape(text[at + len(START) : cut]), unescape(text[cut + 1 : end])
        at = end + len(END)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """Digests of turns and learnt text, one row per conversation, streamed from its parts.

    ``ordered`` says that the rows still lie as ``format_conversations`` left them;
    else they are brought into order first.
    """
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row(s: list) -> dict:
            return {
                "conv_id": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3],
                "loss_sha256": s[4].hexdigest(), "formatted_chars": s[5],
            }

        for batch in batches:
            done = []
            for conv, text, loss in zip(*[batch.column(c) for c in ("conv_id", "text", "loss")], strict=True):
                conv, text, loss = conv.as_py(), text.as_py(), loss.as_py()
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(state)], schema=_ARROW)

    return formatted.select("conv_id", "part", "text", "loss").mapInArrow(run, _DIGESTS)


_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
