"""The pipeline, stage by stage, on odd rows too."""

import inspect

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontamination, nearcopies, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None), (10_001, ""), (10_002, None), (10_003, "same words in this text " * 3), (10_003, "same words in this text " * 3)]
    rows = spark.createDataFrame(odd, "doc_id long, text string")
    both = docs.unionByName(rows, allowMissingColumns=True)
    return both.withColumns({c: F.lit("clash") for c in ("score", "p_toxic", "id", "class_id", "component", "hash")})


def _ids(frame):
    return sorted(repr(r["doc_id"]) for r in frame.collect())


def test_stages_are_as_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_copies", "decontamination", "packing"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_filters_keep_what_the_operators_keep(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    chain = toxicity.train(docs, toxicity.category_labels(labels))
    clean = toxicity.score(docs, chain).where(F.col("p_toxic") <= toxicity.THRESHOLD)
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert kept.columns == docs.columns and _ids(kept) == _ids(clean)
    good = quality.score(docs, quality.train(docs, labels)).where(F.col("score") >= quality.THRESHOLD)
    kept = corpus_pipeline.drop_low_quality(spark, docs, FOLDER)
    assert kept.columns == docs.columns and _ids(kept) == _ids(good)
    first = nearcopies.mark(docs.where("doc_id IS NOT NULL")).where("kept").select("doc_id").distinct()
    kept = corpus_pipeline.keep_one_copy(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert _ids(kept) == sorted([*_ids(first), "None"])
    held = decontamination.mark(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("kept")
    kept = corpus_pipeline.drop_contaminated(spark, docs, FOLDER)
    assert kept.columns == docs.columns and _ids(kept) == _ids(held)


PASSAGE = " ".join(f"word{k} of{k}" for k in range(40))


def test_different_texts_under_one_id_and_none(spark):
    other = " ".join(f"else{k} or{k}" for k in range(40))
    rows = [(1, PASSAGE), (1, other), (2, PASSAGE + " end"), (None, other + " end"), (None, "alone " * 3), (None, None), (3, None), (3, ""), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.keep_one_copy(spark, docs, FOLDER).collect()]
    assert sorted(kept, key=repr) == sorted([(1, PASSAGE), (1, other), (None, "alone " * 3), (None, None), (3, None), (3, "")], key=repr)


def test_ids_that_are_text(spark):
    rows = [("b", PASSAGE), ("a", PASSAGE + " end"), ("c", "something else entirely in here"), (None, PASSAGE + " and")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert _ids(corpus_pipeline.keep_one_copy(spark, docs, FOLDER)) == ["'a'", "'c'"]


def test_passages_in_rows_without_an_id(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 200").first()["text"]
    docs = spark.createDataFrame([(None, f"before {item} after"), (4, f"so {item}"), (4, "clean text"), (None, "also clean")], "doc_id long, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, FOLDER)
    assert sorted(r["text"] for r in kept.collect()) == ["also clean", "clean text"]


def test_a_run_packs_what_the_filters_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert pieces.columns == queries.op3_packing(spark, FOLDER).columns
    packed = {r["doc_id"] for r in pieces.collect()}
    assert 0 < len(packed) < docs.count()
    marked = decontamination.mark(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert not packed & {r["doc_id"] for r in marked.where("contaminated").collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    seen = [labels[i] for i in packed if i in labels]
    assert sum(r["quality"] for r in seen) >= 0.95 * len(seen)


def test_every_stage_takes_an_empty_table(spark, docs):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs.where("false"), FOLDER).count() == 0, name


def test_labels_without_a_value_drop_nothing(spark, docs, tmp_path):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    none = labels.withColumns({c: F.lit(None).cast("int") for c in ("quality", "toxic")})
    none.write.parquet(f"{tmp_path}/labels.parquet")
    for step in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_low_quality):
        assert _ids(step(spark, docs, str(tmp_path))) == _ids(docs)
