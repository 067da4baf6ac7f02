"""Word hashes and linear models against plain versions."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import linear, words


def _texts(w):
    return [(int(d), bytes(w.data[s:e]).decode()) for d, s, e in zip(w.doc, w.start, w.end, strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9é\n.,!ñ", max_size=30), max_size=6))
def test_words_are_runs_of_letters_and_digits(texts):
    w = words.split(pa.array(texts, pa.string()))
    expected = [(i, x) for i, t in enumerate(texts) for x in re.findall(r"[^\W_]+", t)]
    assert _texts(w) == expected
    by_text = {}
    for (_, x), h in zip(expected, w.hash.tolist(), strict=True):
        assert by_text.setdefault(x, h) == h
    assert len(set(by_text.values())) == len(by_text)


def test_marks_lone_characters_and_general_punctuation():
    w = words.split(pa.array(["Hi!!  «you» a—b “c”", "漢字 x"]), marks=True)
    assert [x for _, x in _texts(w)] == ["Hi", "!!", "«", "you", "»", "a", "—", "b", "“", "c", "”", "漢", "字", "x"]


def test_a_word_longer_than_a_segment_and_sliced_arrays():
    long = "x" * 700_000
    texts = pa.array(["skip", f"a {long} b", "", f"{long} c"])
    w = words.split(texts.slice(1))
    assert w.hash[1] == w.hash[3] and len(w.hash) == 5 and w.n_docs == 3
    assert list(words.slices(texts, 1000)) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert w.first_words().tolist() == [0, 3, 3, 5]


def test_runs_stay_in_their_document():
    w = words.split(pa.array(["a b c", "b c", "x", ""]))
    found, at = words.runs_of(w, 2)
    assert at.tolist() == [0, 1, 3] and found[1] == found[2] != found[0]


def test_models_learn_and_forget_noise():
    rng = np.random.default_rng(1)
    first = np.arange(0, 2001, 5)
    index = rng.integers(10, 500, 2000)
    labels = np.tile([0.0, 1.0], 200)
    index[::5] = np.where(labels > 0, 3, 4)
    rows = linear.Rows(first, index, np.ones(2000))
    weights = linear.Ftrl(alpha=1.0, l1=4.0, l2=0.0).fit(rows, labels, 512)
    assert weights[3] > 1 and weights[4] < -1 and (weights[10:500] == 0).mean() > 0.9
    assert ((linear.predict(rows, weights, 512) > 0.5) == labels).all()
    empty = linear.Rows(np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0))
    assert empty.dot(weights).tolist() == [0.0]
