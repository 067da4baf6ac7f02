"""Document facets: the categories and geotags a document counts for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import within

DIMENSIONS = ("channel", "first_cat", "second_cat")


def categories(dimension: str) -> Column:
    """The document's categories along one dimension, as an array."""
    if dimension == "channel":
        return F.col("channels")
    if dimension in ("first_cat", "second_cat"):
        return F.map_keys(F.col(f"text_category.{dimension}"))
    raise ValueError(f"unknown dimension {dimension!r}, expected one of {DIMENSIONS}")


def non_state_geotags() -> Column:
    """Geotags other than states; a NULL type is dropped with them."""
    return F.filter(F.col("geotag"), lambda tag: tag["type"] != "state")


def type_pid(tag: Column) -> Column:
    """``type@pid``, NULL when either part is."""
    return F.concat(tag["type"], F.lit("@"), tag["pid"])


def latest_snapshot(doc_dim: DataFrame) -> DataFrame:
    """One row per document: the one of its newest partition."""
    rest = [c for c in doc_dim.columns if c != "doc_id"]
    return (
        doc_dim.groupBy("doc_id")
        .agg(F.max_by(F.struct(*rest), F.col("pdate")).alias("_doc"))
        .select("doc_id", "_doc.*")
    )


def doc_facets(
    doc_dim: DataFrame,
    dimension: str,
    as_of: date,
    doc_days: int,
    dedupe_docs: bool = False,
) -> DataFrame:
    """(doc_id, categories, geos), still one row per document snapshot.

    A document without geotags, or with a NULL array of them, has no geos and
    keeps its categories.

    The arrays stay unexploded so that the fact side is joined to narrow rows
    and fans out only afterwards.
    """
    docs = doc_dim.where(within(F.col("pdate"), as_of, doc_days))
    if dedupe_docs:
        docs = latest_snapshot(docs)
    return docs.select(
        "doc_id",
        categories(dimension).alias("categories"),
        F.coalesce(
            F.transform(non_state_geotags(), type_pid), F.array().cast("array<string>")
        ).alias("geos"),
    )


def list_keys(dimension: str) -> Column:
    """The document's ``category@type@pid`` keys, one per category and geotag.

    Categories and pids that are NULL have no key. The array stays on the
    document row, so joins and filters see one row per document.
    """
    places = F.transform(non_state_geotags(), type_pid)
    keys = F.transform(
        categories(dimension),
        lambda category: F.transform(
            places, lambda place: F.concat(category, F.lit("@"), place)
        ),
    )
    return F.filter(F.flatten(keys), lambda key: key.isNotNull())
