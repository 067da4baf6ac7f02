"""The training-data pipeline: documents in, packed pieces out.

Each stage works on all that the one before kept, as ``run`` writes it and reads
it again. Toxic documents go, then low quality, then all but one document of a
group of near copies, then documents with benchmark passages; the rest is packed.
A classifier that no label could teach drops nothing.
Nulls, empty texts and ties are treated as the operators say; extra columns of
documents are carried along by every filter. Near copies and benchmark passages are
looked for row by row: ids may be null, repeated over different texts, or no numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm import decontamination, nearcopies, quality, queries, toxicity
from feedloom.staging import stage


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.train(docs, toxicity.category_labels(_labels(spark, sf_dir)))
    if not toxicity.learnt(chain):
        return docs
    scored = toxicity.score(docs, chain, prefix=(mark := f"p{uuid.uuid4().hex[:8]}_"))
    return scored.where(F.col(f"{mark}toxic") <= toxicity.THRESHOLD).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = quality.train(docs, _labels(spark, sf_dir))
    if not len(weights):
        return docs
    scored = quality.score(docs, weights, out=(mark := f"s{uuid.uuid4().hex[:8]}"))
    return scored.where(F.col(mark) >= quality.THRESHOLD).select(*docs.columns)


def _row_key() -> Column:
    """A 64-bit key of a row's id and text: rows that differ are compared as documents of their own,
    also where they share an id or have none."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), "text")


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one of least id; rows equal in id and text are one."""
    key = f"k{uuid.uuid4().hex[:8]}"
    keyed = docs.withColumn(key, _row_key())
    named = keyed.select(F.col(key).alias("id"), "doc_id", "text")
    found = stage(nearcopies.classes(named, "id"), "pipeline-classes")
    several = found.where("id <> class_id").select("class_id").distinct()
    members = stage(found.join(several, "class_id", "left_semi"), "pipeline-members")
    ids = named.select("id", "doc_id").join(members, "id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id"))["id"].alias("first")
    stays = ids.groupBy("class_id").agg(first)
    copies = members.join(stays, "class_id").where("id <> first").select(F.col("id").alias(key))
    kept = keyed.join(stage(copies, "pipeline-copies"), key, "left_anti")
    row = f"r{uuid.uuid4().hex[:8]}"
    once = Window.partitionBy(key).orderBy(key)
    return kept.withColumn(row, F.row_number().over(once)).where(F.col(row) == 1).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = f"k{uuid.uuid4().hex[:8]}"
    keyed = docs.withColumn(key, _row_key())
    named = keyed.select(F.col(key).alias("doc_id"), "text")
    found = decontamination.find(named, benchmark).select(F.col("id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def pack_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_copies", keep_one_copy),
    ("decontamination", drop_contaminated),
    ("packing", pack_pieces),
]

#: No SQL can train the classifiers or align texts; the stages have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
