"""Shared Spark helpers: text keys, written intermediate tables, connected components."""

from __future__ import annotations

import numpy as np
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.session import new_scratch_path

#: Prefix of working columns that stand beside a caller's columns.
OWN = "__wf_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """128 bits of hash of a text (null as empty), as two longs."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def with_key(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, text): the row key is doc_id (may be null) with 128 bits of text hash.

    Rows that agree in doc_id and text share a key, and every operator gives them one result.
    """
    k1, k2 = text_hashes(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _key_columns(df: DataFrame, k1: Column, k2: Column, prefix: str) -> tuple[DataFrame, list[str]]:
    """``df`` with the row key as four columns that are never null."""
    doc_id = F.col("doc_id").cast("long")
    added = {"i": F.coalesce(doc_id, F.lit(0)), "z": doc_id.isNull(), "k1": k1, "k2": k2}
    return df.withColumns({prefix + n: c for n, c in added.items()}), [prefix + n for n in added]


def keep_columns(docs: DataFrame, decided: DataFrame, how: str, once: bool = False) -> DataFrame:
    """``docs`` joined to ``decided`` (doc_id, k1, k2) by row key, semi or anti; only columns of ``docs``.

    ``once``: of rows with one key one stays.
    """
    left, mine = _key_columns(docs, *text_hashes(F.col("text")), OWN)
    right, theirs = _key_columns(decided, F.col("k1"), F.col("k2"), OWN + "d")
    joined = left.join(right.select(*theirs),
                       [F.col(a) == F.col(b) for a, b in zip(mine, theirs, strict=True)], how)
    return (joined.dropDuplicates(mine) if once else joined).drop(*mine)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the lineage, survives lost executors."""
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast of ``value``, of a bounded size, that tasks read by :func:`received`.

    Code travels with it: the workers need not have the classes of ``value``.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return cloudpickle.loads(sent.value)


#: Parts of a filter that are made apart.
FILTER_SLICES = 64


def bit_filter(hashes: DataFrame) -> bytes:
    """Bits of a ``words.BitFilter`` over a column ``hash``, sized by the number of rows up to a fixed bound.

    The places of the bits are shuffled by slice of the filter, so that each slice is made once and the driver
    gets every bit once, however many rows there are.
    """
    rows = written(hashes.sparkSession, hashes, "hashes")
    size = W.BitFilter.size_for(rows.count())
    bits, width = W.BitFilter.empty(size), size // 8 // FILTER_SLICES
    parts = rows.mapInArrow(W.filter_places(size, FILTER_SLICES), "slice int, places binary").repartition("slice") \
        .mapInArrow(W.filter_slices(size, FILTER_SLICES), "slice int, bits binary")
    for part in parts.toLocalIterator():
        bits[part["slice"] * width:(part["slice"] + 1) * width] = np.frombuffer(part["bits"], np.uint8)
    return bits.tobytes()


def components(spark: SparkSession, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): connected components of undirected ``edges``; the label is the smallest node.

    Alternating large-star and small-star steps until the edges stop changing. Each
    step joins every edge to the minimum of its ends' neighbourhoods. These are
    pre-aggregated and written before the join, whose two sides are then plain
    shuffles: a hot node meets one row, and Spark can split its edges over tasks.
    """
    e = written(spark, edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = written(spark, both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v").distinct(), "edges")
        low = written(spark, large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        seen = Observation()
        e = written(spark, small.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "edges")
        if seen.get == before:
            break
        before = seen.get
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
