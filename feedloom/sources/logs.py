"""Log lines as typed rows.

A log mixes lines of several kinds. A format says by which text the lines of one kind
are known, how their fields are cut, and of what type they are. Lines of the kind that
can't be read are kept apart, with the reason, and counted; other lines are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import stripped

VALUE, LINE, PROBLEM = "value", "line_no", "problem"


@dataclass(frozen=True)
class LogFormat:
    """``marker`` is in every line of the kind. Fields are the groups of ``pattern``, or what ``sep`` parts.

    A field that is empty, or written ``null`` where ``null_text`` says so, is null.
    """

    marker: str
    columns: str
    pattern: str = ""
    sep: str = "\t"
    null_text: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(self.columns)


def _fields(line: Column, log: LogFormat, names: list[str]) -> tuple[Column, list[Column]]:
    """Whether the line can be cut, and its fields as text."""
    if log.pattern:
        return line.rlike(log.pattern), [F.regexp_extract(line, log.pattern, k + 1) for k in range(len(names))]
    parts = F.split(line, log.sep, -1)
    return F.size(parts) == len(names), [F.get(parts, F.lit(k)) for k in range(len(names))]


def _typed(log: LogFormat) -> tuple[Column, dict[str, Column]]:
    """Why a line of the kind can't be read, and its fields."""
    schema = log.schema
    names = [f.name for f in schema]
    cut, texts = _fields(stripped(F.col(VALUE)), log, names)
    texts = [F.when(t != "", t) for t in texts]
    if log.null_text is not None:
        texts = [F.when(t != log.null_text, t) for t in texts]
    typed = [t.try_cast(f.dataType) for t, f in zip(texts, schema, strict=True)]
    odd = [
        F.when(t.isNotNull() & v.isNull(), F.lit(f"bad {f.name}"))
        for t, v, f in zip(texts, typed, schema, strict=True)
        if not isinstance(f.dataType, T.StringType)
    ]
    problem = F.when(~cut, F.lit("not in the format"))
    return F.coalesce(problem, *odd) if odd else problem, dict(zip(names, typed, strict=True))


def _of_kind(log: LogFormat) -> Column:
    return F.col(VALUE).contains(log.marker)


def read_log(lines: DataFrame, log: LogFormat) -> DataFrame:
    """The lines of one kind: ``line_no``, their typed fields, ``problem`` and ``value``.

    ``problem`` is null for lines that were read; the fields of the others are null.
    Lines are stripped of white space at their ends first.
    """
    problem, fields = _typed(log)
    found = lines.where(_of_kind(log)).select(LINE, VALUE, problem.alias(PROBLEM), *[v.alias(n) for n, v in fields.items()])
    good = F.col(PROBLEM).isNull()
    return found.select(LINE, *[F.when(good, F.col(n)).alias(n) for n in fields], PROBLEM, VALUE)


def log_rows(read: DataFrame) -> DataFrame:
    return read.where(F.col(PROBLEM).isNull()).drop(PROBLEM, VALUE)


def quarantined(read: DataFrame) -> DataFrame:
    """Lines that could not be read, as they are, and why."""
    return read.where(F.col(PROBLEM).isNotNull()).select(LINE, PROBLEM, VALUE)


def log_counts(lines: DataFrame, log: LogFormat) -> DataFrame:
    """One row: lines, those of the kind, and those of them that could not be read."""
    problem, _ = _typed(log)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(_of_kind(log)).alias("of_kind"),
        F.count_if(_of_kind(log) & problem.isNotNull()).alias("quarantined"),
    )
