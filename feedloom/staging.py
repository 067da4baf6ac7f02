"""Written intermediate tables.

A few operators read an aggregated table more than once. They write it first
into the shared folder named by ``spark.checkpoint.dir``: that cuts the
lineage, survives lost executors and computes the input once. Tables lie under
one folder per application; a job removes it when it ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import cache
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="feedloom-")


def staging_root(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only on a local master."""
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_DIR} must name a folder all executors share")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"{_CHECKPOINT_DIR} must be set where executors are processes of their own")
    return _local_folder()


def _application_root(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove the tables this application has staged; frames on them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_counted(df: DataFrame, label: str, measures: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Any]]:
    """``stage``, and measures of the rows from the pass that writes them."""
    seen = Observation()
    staged = stage(df.observe(seen, *[column.alias(name) for name, column in measures.items()]), label)
    return staged, dict(seen.get)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{_application_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
