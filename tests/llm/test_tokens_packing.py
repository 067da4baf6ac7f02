"""Token counts and packing against the tokenizer library itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import packing, queries, tokens

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    (1, None), (2, ""), (3, "same"), (3, "same"), (4, "same"), (None, "same"), (None, None), (5, "a <|endoftext|> b"),
    (6, "naïve 漢字 🙂\n\n  x"), (7, " " * 5000 + "x"), (8, "long words here, " * 90_000), (9, "it's 123 \t end"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.withColumns({c: F.lit("clash") for c in ("n_tokens", "_content", "_text", "_id", "start", "ids")})


def test_counts_equal_the_library(spark, tmp_path, odd, library):
    cache = str(tmp_path / "cache")
    found = tokens.count_tokens(odd, PATH, cache)
    expected = sorted(
        (str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD
    )
    assert sorted((str(r[0]), r["n_bytes"], r["n_tokens"]) for r in found.collect()) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() == len({t or "" for _, t in ODD})
    # What is known is not encoded again, and another tokenizer has its own counts.
    assert tokens.count_tokens(odd, PATH, cache).count() == len(ODD)
    assert spark.read.parquet(cache).count() == stored.count()
    other = tokens.count_tokens(odd, public_tokenizers.path("piece_bpe_32k.model"), cache)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r["n_tokens"] for r in other.where("doc_id = 9").collect()} == {len(model.encode(ODD[-1][1]))}
    assert spark.read.parquet(cache).count() == 2 * stored.count()


def test_counts_of_an_empty_table(spark, tmp_path, odd):
    assert tokens.count_tokens(odd.where("false"), PATH, str(tmp_path / "none")).count() == 0


def test_a_second_run_of_the_query_encodes_nothing(spark, monkeypatch, tmp_path):
    root = str(tmp_path / "shared")
    monkeypatch.setattr(tokens, "staging_root", lambda _: root)
    cache = tokens.lasting_cache(spark, PATH)
    first = sorted(map(tuple, queries.op10_tokens(spark, FOLDER).collect()))
    runs = tokens.commits.names(spark, cache)
    assert sorted(map(tuple, queries.op10_tokens(spark, FOLDER).collect())) == first
    assert tokens.commits.names(spark, cache) == runs and len(runs) == 1
    # Counts come from the cache: what it says is taken.
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").distinct().count()
    assert tokens.stored_counts(spark, cache).count() == texts
    # An attempt that failed is not read.
    tokens.stored_counts(spark, cache).withColumn("n_tokens", F.lit(-1).cast("long")).write.parquet(f"{cache}/_attempt-x")
    assert sorted(map(tuple, queries.op10_tokens(spark, FOLDER).collect())) == first


def test_the_query_counts_every_document(spark, library):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op10_tokens(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024)


class Recorder:
    """A tokenizer that notes all text it is given."""

    def __init__(self, inner, given):
        self._inner, self._given, self.model, self.pre_tokenizer = inner, given, self, self

    def __getattr__(self, name):
        inner = self._inner
        owner = {"tokenize": inner.model, "pre_tokenize_str": inner.pre_tokenizer}.get(name, inner)

        def call(texts, **options):
            self._given.append("".join(texts))
            return getattr(owner, name)(texts, **options)

        return call if name in ("tokenize", "pre_tokenize_str", "encode_batch_fast") else getattr(inner, name)


def test_words_that_are_known_are_not_encoded_again(monkeypatch, library):
    given = []

    class Recorded:
        from_file = staticmethod(lambda path: Recorder(Tokenizer.from_file(path), given))

    monkeypatch.setattr("tokenizers.Tokenizer", Recorded)
    rng = np.random.default_rng(4)
    known = [f"{a}{b}" for a in "wörd часть it's plain 12".split() for b in ("", "s", ",", ".")]
    texts = [" ".join(rng.choice(known, 300)) for _ in range(100)]
    count = tokens.counter.__wrapped__(PATH)
    found = [n for a in range(0, 100, 20) for n in count(pa.array(texts[a : a + 20])).tolist()]
    assert found == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert given and sum(map(len, given)) < sum(map(len, texts)) / 100


PIECES = st.sampled_from([*"ab1'.,-é漢×я²\u0308\u200b\u3000\u180e\xa0\x85\x1c\x00 \t\n", "  ", "   ", "'s", "'ll", "\r\n", "<|endoftext|>", "<|"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join) | st.text(max_size=40), max_size=4))
def test_sums_over_units_equal_the_library(texts):
    count, library = test_sums_over_units_equal_the_library.both
    assert count(pa.array(texts, pa.string())).tolist() == [len(library.encode(t, add_special_tokens=False)) for t in texts]


test_sums_over_units_equal_the_library.both = (tokens.counter.__wrapped__(PATH), Tokenizer.from_file(PATH))


@pytest.mark.parametrize("form", ["{}", "a{}  b", "{}a,{}1 {}'s", "é{}я {}!{}", "'{}s\n {} "])
def test_every_character_is_cut_as_the_library_cuts_it(library, form):
    texts = [form.replace("{}", chr(c)) for c in range(0x3100)]
    found = tokens.counter.__wrapped__(PATH)(pa.array(texts))
    assert found.tolist() == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_forgetting_units_and_slices_change_no_count(monkeypatch, library):
    monkeypatch.setattr(tokens, "MEMORY_BYTES", 100)
    texts = [t or "" for _, t in ODD] * 2
    wanted = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    count = tokens.counter.__wrapped__(PATH)
    for _ in range(2):
        assert count(pa.array(texts).slice(3)).tolist() == wanted[3:]
    assert count(pa.array([], pa.string())).tolist() == []


def test_units_met_again_are_kept_when_the_memory_is_full(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_BYTES", 4000)
    count = tokens.counter.__wrapped__(PATH)
    for k in range(40):
        count(pa.array([" often met" + "".join(f" rare{chr(97 + i)}{chr(97 + k % 26)}x{chr(97 + k // 26)}" for i in range(20))]))
        assert k == 0 or {b" often", b" met"} <= set(count._known.to_pylist())
        assert count._known.nbytes < 6000 and len(count._known) == len(count._counts) == len(count._again)


def test_a_replaced_file_is_read_anew(spark, tmp_path):
    path, docs = tmp_path / "t.json", spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    for n, name in ((0, "byte_bpe_50k.json"), (1, "word_bpe_49k.json")):
        path.write_bytes(open(public_tokenizers.path(name), "rb").read())
        text = f"some unusualish words {n}, here"
        found = tokens.count_tokens(docs.withColumn("text", F.lit(text)), str(path), str(tmp_path / "cache")).first()
        assert found["n_tokens"] == len(Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False))


def test_tokenizers_of_other_words_are_given_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    count, library = tokens.counter.__wrapped__(path), Tokenizer.from_file(path)
    assert not isinstance(count, tokens.UnitCounts)
    texts = [(t or "")[:5000] for _, t in ODD]
    assert count(pa.array(texts)).tolist() == [len(library.encode(t, add_special_tokens=False)) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_ranks_give_the_ids_of_the_library(text):
    encode = packing.encoder(PATH, RANKS, public_tokenizers.PATTERN)
    exact = packing.encoder(PATH)
    assert encode(text).tolist() == exact(text).tolist()


def test_pieces_of_a_long_text_are_cut_where_no_token_can_be(monkeypatch):
    text = "alpha beta, 12 gamma's\n\n  delta epsilon zeta eta " * 60
    whole = packing.encoder(PATH)(text)
    monkeypatch.setattr(packing, "_PIECE_CHARS", 40)
    assert len(list(packing._safe_pieces(text))) > 20
    assert packing.encoder(PATH, RANKS, public_tokenizers.PATTERN)(text).tolist() == whole.tolist()


def _check(pieces, texts, library):
    """Every id in exactly one piece, sequences gapless and at most a window long."""
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in own])
        assert [p["offset"] for p in own] == [0, *ends[:-1]] and ends[-1] <= 1024
    left = {}
    for i, t in texts:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        left.setdefault((i, len(ids)), []).append(ids)
    covered = {}
    for p in pieces:
        for n in range(p["start"], p["start"] + p["length"]):
            key = (p["doc_id"], p["doc_tokens"], n)
            covered[key] = covered.get(key, 0) + 1
        ids = left[p["doc_id"], p["doc_tokens"]][0]
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    assert covered == {(i, n, k): len(copies) for (i, n), copies in left.items() for k in range(n)}
    return by_sequence


def test_packing_loses_and_repeats_nothing(spark, library):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    pieces = queries.op3_packing(spark, FOLDER).collect()
    sequences = _check(pieces, texts, library)
    total = sum(p["length"] for p in pieces)
    assert len(sequences) * 1024 - total < 1024


def test_packing_odd_rows_in_many_shards(spark, odd, library):
    pack = lambda rows, size: packing.pack(
        rows, PATH, RANKS, public_tokenizers.PATTERN, shard_bytes=size
    ).withColumn("ids_crc32", F.crc32("ids"))
    pieces = pack(odd.where("doc_id <> 8 OR doc_id IS NULL"), 2000).collect()
    _check(pieces, [x for x in ODD if x[0] != 8], library)
    assert len({p["sequence_id"] >> 32 for p in pieces}) > 1
    long = pack(odd.where("doc_id = 8"), packing.SHARD_BYTES).collect()
    assert sum(p["length"] for p in long) == long[0]["doc_tokens"]
    assert pack(odd.where("false"), 2000).count() == 0


def test_packing_is_the_same_when_a_task_runs_again(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pack = lambda rows: sorted(map(tuple, packing.pack(rows, PATH, RANKS, public_tokenizers.PATTERN, shard_bytes=100_000).collect()))
    assert pack(docs) == pack(docs.repartition(5))


def test_neighbours_are_those_of_plain_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 30, rng.integers(5, 20)) for _ in range(12)]
    doc = np.concatenate([np.full(len(np.unique(d)), i) for i, d in enumerate(docs)])
    term = np.concatenate([np.unique(d) for d in docs])
    tf = np.concatenate([np.unique(d, return_counts=True)[1] for d in docs])
    length = np.array([len(d) for d in docs])
    df = np.bincount(term, minlength=30)
    idf = np.log1p((12 - df + 0.5) / (df + 0.5))
    index = packing.Index(doc, term, tf, length, idf.astype(np.float32), length.mean())
    for seed in range(12):
        plain = np.zeros(12)
        for t in np.unique(docs[seed]):
            if df[t] > 1:
                n = np.array([(d == t).sum() for d in docs])
                plain += idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / length.mean()))
        assert np.allclose(index.scores(seed), plain, atol=1e-5)


def _postings(docs):
    doc = np.concatenate([np.full(len(np.unique(d)), i) for i, d in enumerate(docs)])
    term = np.concatenate([np.unique(d) for d in docs])
    tf = np.concatenate([np.unique(d, return_counts=True)[1] for d in docs])
    return doc, term, tf, np.array([len(d) for d in docs])


def test_texts_of_many_terms_are_scored_by_all_of_them(monkeypatch):
    monkeypatch.setattr(packing, "_PAIRS", 5000)
    monkeypatch.setattr(packing, "_BLOCK", 30)
    rng = np.random.default_rng(5)
    docs = [(rng.random(rng.integers(300, 900)) ** 3 * 1500).astype(np.int64) for _ in range(80)]
    doc, term, tf, length = _postings(docs)
    assert np.median(np.bincount(doc)) > 200
    df = np.bincount(term, minlength=1500)
    assert (df >= 16).sum() > 60 and ((df > 1) & (df < 16)).sum() > 60
    idf = np.log1p((80 - df + 0.5) / (df + 0.5))
    index = packing.Index(doc, term, tf, length, idf, length.mean())
    n = np.zeros((80, 1500))
    n[doc, term] = tf
    weight = idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length[:, None] / length.mean()))
    plain = (n > 0) @ np.where(df > 1, weight, 0).T
    found = np.array([index.scores(seed) for seed in range(80)])
    assert np.allclose(found, plain, atol=1e-4)
    # Sums are exact, so the order of documents cannot change them.
    turn = rng.permutation(80)
    place = np.argsort(turn)
    doc, term, tf, length = _postings([docs[k] for k in turn])
    other = packing.Index(doc, term, tf, length, idf, length.mean())
    assert all((other.scores(place[seed])[place] == found[seed]).all() for seed in range(80))


def test_the_best_neighbours_come_first():
    """Every window of one shard is filled in the order that plain scores give."""
    rng = np.random.default_rng(9)
    doc, term, tf, length = _postings([rng.integers(0, 200, 60) for _ in range(40)])
    index = packing.Index(doc, term, tf, length, np.ones(200), length.mean())
    pieces = list(packing.fill(np.full(40, 10), index, 50, packing.Cursor()))
    used = set()
    for k in range(0, 40, 5):
        seed, *rest = (p[0] for p in pieces[k : k + 5])
        assert seed == min(set(range(40)) - used)
        free = sorted(set(range(40)) - used - {seed}, key=lambda d: (-index.scores(seed)[d], d))
        assert rest == free[:4]
        used |= {seed, *rest}


def test_an_open_window_goes_on_in_the_next_shard():
    cursor = packing.Cursor()
    none = np.zeros(0, np.int64)
    index = lambda n: packing.Index(none, none, none, np.zeros(n), np.zeros(1), 0.0)
    first = list(packing.fill(np.array([3, 14]), index(2), 10, cursor))
    second = list(packing.fill(np.array([5, 4]), index(2), 10, cursor))
    assert first == [(1, 0, 10, 0, 0), (0, 0, 3, 1, 0), (1, 10, 4, 1, 3)]
    assert second == [(0, 0, 3, 1, 7), (0, 3, 2, 2, 0), (1, 0, 4, 2, 2)]


def _places(docs, size):
    """Shard of every document, and the terms of each."""
    ordered, _, _ = packing.deal(docs, PATH, RANKS, public_tokenizers.PATTERN, size)

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        for number, shard in enumerate(packing._shards(batches, size, packing.SHARD_DOCS)):
            where = pa.array(np.full(len(shard), base + number))
            yield pa.RecordBatch.from_arrays([shard.column("_id").combine_chunks(), where], names=["id", "shard"])

    return dict(map(tuple, ordered.mapInArrow(run, "id long, shard long").collect()))


def test_documents_that_share_telling_content_share_a_shard(spark):
    """Where a best neighbour stands out (half of the seed's own score), it is in reach of 0.8 of the seeds."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    ids, texts = zip(*sorted(map(tuple, docs.collect())), strict=True)
    found = [np.unique((t or "").lower().split(), return_counts=True) for t in texts]
    vocabulary = {w: k for k, w in enumerate(sorted({w for words, _ in found for w in words}))}
    doc = np.concatenate([np.full(len(w), k) for k, (w, _) in enumerate(found)])
    term = np.array([vocabulary[w] for words, _ in found for w in words])
    tf = np.concatenate([c for _, c in found])
    length = np.bincount(doc, tf, minlength=len(ids))
    df = np.bincount(term)
    idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
    weight = idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[doc] / length.mean()))
    full = np.zeros((len(ids), len(vocabulary)), np.float32)
    full[doc, term] = weight
    scores = (full > 0).astype(np.float32) @ full.T
    own = scores.diagonal().copy()
    np.fill_diagonal(scores, -1)
    best = scores.argmax(1)
    clear = np.flatnonzero((own > 0) & (scores.max(1) >= own / 2))
    assert len(clear) > 100
    place = _places(docs, 100_000)
    shard = np.array([place[i] for i in ids])
    sizes = np.unique(shard, return_counts=True)[1]
    assert len(sizes) > 15
    assert (shard[clear] == shard[best[clear]]).mean() >= 0.8
    assert (sizes / len(ids)).max() < 0.2


def test_a_hot_group_and_tiny_texts_stay_in_bounded_shards(spark, monkeypatch, library):
    monkeypatch.setattr(packing, "SHARD_DOCS", 50)
    rows = [(k, "one text that a third of all rows hold " * 3 if k % 3 == 0 else f"w{k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = packing.pack(docs, PATH, RANKS, public_tokenizers.PATTERN, shard_bytes=3000).withColumn("ids_crc32", F.crc32("ids"))
    _check(pieces.collect(), rows, library)
    place = _places(docs, 3000)
    assert sorted(place) == list(range(900))
    assert np.unique(list(place.values()), return_counts=True)[1].max() <= 50


def test_ranks_give_the_ids_of_the_library_for_all_documents_and_unbroken_texts(spark):
    encode = packing.encoder(PATH, RANKS, public_tokenizers.PATTERN)
    exact = packing.encoder(PATH)
    rng = np.random.default_rng(2)
    unbroken = ["ab" * 500_000, "".join(rng.choice(list("etaoinshr"), 1_000_000)), " " * 1_000_000, " \n" * 400_000 + "x", "=" * 1_000_000]
    texts = [t for (t,) in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    for text in texts + unbroken:
        assert (encode(text or "") == exact(text or "")).all()
