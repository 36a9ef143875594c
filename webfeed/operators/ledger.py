"""Validation ledger: what earlier validations found in files that have not changed since.

The ledger is a Parquet table that is only appended to::

    file_key, length, modified, md5, records (null: not counted), checked_at

A file counts as unchanged while its path, length and modification time are the same. A validation with a ledger
reads the content of the other files only, appends what it finds, and compares sizes, digests and records with
what the manifests say now, so a corrected manifest needs no content either. A file that was rewritten with the
same length and time is noticed by a full validation, which reads everything and replaces what the ledger says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.files import raw_path
from ..sources.files import Files, not_found

_SCHEMA = T.StructType().add("file_key", "string").add("length", "long").add("modified", "timestamp") \
    .add("md5", "string").add("records", "long").add("checked_at", "timestamp")
_KEY = ["file_key", "length", "modified"]


def entries(spark: SparkSession, path: str) -> DataFrame:
    """``file_key, length, modified, md5, records``: what the last validation found in every version of a file."""
    try:
        rows = spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as e:
        if not not_found(e):
            raise
        rows = spark.createDataFrame([], _SCHEMA)
    counted_at = F.when(F.col("records").isNotNull(), F.col("checked_at"))
    found = rows.groupBy(*_KEY, "md5").agg(F.max("checked_at").alias("at"), F.max_by("records", counted_at).alias("records"))
    return found.groupBy(*_KEY).agg(F.max_by(F.struct("md5", "records"), "at").alias("last")).select(*_KEY, "last.*")


def checked(spark: SparkSession, path: str, files: Files, counted: list[str], full: bool,
            read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """``file_key, actual_size, actual_md5, actual_records`` of ``files``, from the ledger as far as it knows them.

    ``counted`` names the files whose records are asked for; ``read`` gives the same columns of named files by
    reading them. What it gives is appended to the ledger.
    """
    count = raw_path().isin([files.exist[n] for n in counted]) if counted else F.lit(False)
    # what the file index says: no content is read
    now = files.select(files.name().alias("file_key"), "length", F.col("modificationTime").alias("modified"),
                       count.alias("count")).dropDuplicates(["file_key"])
    todo = now if full else now.join(entries(spark, path), _KEY, "left").where(
        F.col("md5").isNull() | (F.col("count") & F.col("records").isNull()))
    names = [r.file_key for r in todo.select("file_key").collect()]
    if names:
        found = read(names).withColumnsRenamed({"actual_size": "length", "actual_md5": "md5", "actual_records": "records"})
        found.join(now, ["file_key", "length"]).withColumn("checked_at", F.current_timestamp()) \
            .select(*[F.col(f.name).cast(f.dataType) for f in _SCHEMA.fields]).write.mode("append").parquet(path)
    return now.join(entries(spark, path), _KEY).select(
        "file_key", F.col("length").alias("actual_size"), F.col("md5").alias("actual_md5"),
        F.col("records").alias("actual_records"))
