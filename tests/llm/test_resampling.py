"""Importance resampling against plain Python, and the cutoff against a whole sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import checksums, queries, resampling

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    found = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_resample(docs, target):
    """Every row as (id, n_features, weight, score, rank), by sorting all of them."""
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(plain_features(text)[1])
    for text in target:
        wanted.update(plain_features(text)[1])
    s_all, t_all = source.total() + 10000, wanted.total() + 10000
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in range(10000)]
    rows, fit = [], []
    for key, text in docs:
        n, found = plain_features(text)
        weight = sum(gain[b] for b in found)
        digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
        score = weight + math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None])
        if n >= 20:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=repr)


def found_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=200), min_size=1, max_size=30))
def test_checksums_of_strings_and_of_joined_strings(strings):
    data = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings])
    end = np.cumsum(sizes)
    sums = checksums.of_spans(data, end - sizes, end)
    assert sums.tolist() == [zlib.crc32(s) for s in strings]
    both = checksums.joined(sums[:-1], sums[1:], sizes[1:])
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(strings, strings[1:])]


def test_checksums_over_long_strings():
    a, b = b"x" * 70_001, b"yz" * 123_457
    sums = checksums.joined(*[np.array([zlib.crc32(s)], np.uint32) for s in (a, b)], np.array([len(b)]))
    assert sums.tolist() == [zlib.crc32(a + b)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abZ09 .\n`{ é漢\x7f ", max_size=60), max_size=8))
def test_features_are_those_of_the_regular_expression(texts):
    bucket, owner, n_words = resampling.features(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        n, expected = plain_features(text)
        assert n_words[k] == n and sorted(bucket[owner == k].tolist()) == sorted(expected)


def odd_rows():
    word = "abcdefghijklmnopqrst"
    texts = [" ".join(word[(i * k + j) % 20] * (1 + (i + j) % 3) for j in range(15 + i % 12)) for i in range(400) for k in (1, 7)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, *[(None, texts[0] * 2)] * 3, (5, texts[9] * 3), (5, texts[9] * 3), (-7, None), (-8, ""), (-9, "long " * 300_000), (-10, "q" * 1_500_000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(odd_rows(), "doc_id long, text string")
    return rows.withColumns({c: F.lit("clash") for c in ("id", "score", "rank", "n_words", "weight", "_slice", "bucket")})


def test_rows_equal_plain_python(spark, odd):
    target = ["a b c d e f", None, "", "cc dd ee aa bb " * 9]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    assert found_rows(resampling.resample(odd, frame)) == plain_resample(odd_rows(), target)


def test_any_bracket_gives_the_same_rows(spark, odd):
    weighed = odd.select(F.monotonically_increasing_id().alias("id")).withColumns(
        {"n_words": F.lit(20) + F.col("id") % 3, "n_features": F.lit(1), "weight": F.lit(2), "score": (F.col("id") * 37) % 11}
    )
    weighed = resampling.stage(weighed, "test")
    rows = [r["id"] for r in weighed.orderBy(F.col("score").desc(), "id").collect()]
    for share in ((0, 100), (5, 100), (1, 1)):
        for accuracy in (2, 10_000):
            drawn = resampling.draw(weighed, share, 20, accuracy).where("rank IS NOT NULL")
            got = [r["id"] for r in drawn.orderBy("rank").collect()]
            assert got == rows[: len(rows) * share[0] // share[1]], (share, accuracy)


def test_a_refuted_bracket_is_widened(spark, monkeypatch):
    scores = spark.range(1000).select(F.col("id").alias("score"))
    asked = []

    def wrong(column, ends, accuracy):
        asked.append(ends)
        return F.array(F.max(column), F.max(column)) if len(asked) < 3 else F.array(F.min(column), F.max(column))

    monkeypatch.setattr(resampling.F, "percentile_approx", wrong)
    low, high, above = resampling.bracket(scores, 50, 1000, 100)
    assert (low, high, above) == (0, 999, 0) and len(asked) == 3


def test_empty_tables(spark, odd):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(odd.where("false"), target).count() == 0
    some = resampling.resample(odd, target.where("false"))
    assert found_rows(some) == plain_resample(odd_rows(), [])


def test_the_query_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = queries.op12_resampling(spark, FOLDER)
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
    assert found_rows(found) == plain_resample(docs, target)
