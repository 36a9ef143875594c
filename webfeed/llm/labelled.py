"""Bounded samples of labelled rows, for classifiers; folds come from crc32 of the doc_id as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` (a null doc_id as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """(doc_id, text, label): at most ``most`` labelled documents, those whose id has the smallest hash.

    The ids are chosen on the labels alone, so only the few chosen rows are sent to the documents.
    An id that has labels of both kinds is left out. Of documents that repeat an id one counts, that whose text
    has the smallest hash, so the bound holds whatever the rows.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("l_id")) \
        .agg(F.min(column).cast("int").alias("label"), F.max(column).cast("int").alias("other")) \
        .where("label = other").orderBy(F.xxhash64("l_id"), "l_id").limit(most).select("l_id", "label")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    return found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
                                       F.first("label").alias("label"))
