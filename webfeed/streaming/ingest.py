"""Incremental ingestion: append each newly delivered day to a Parquet table.

The vendor writes a delivery's manifest last, so a file stream over manifest
names sees a day only once it is complete. Each micro-batch collects the new
days (metadata), reads their hits with :func:`read_feed` (optionally
validated) and overwrites exactly those ``delivery_date`` partitions of the
target, so a retried batch rewrites the same partitions: together with the
stream checkpoint, every delivery lands once.

The file stream knows a manifest by its name only, so the state of every ingested
manifest (name -> modification time and length) is kept in ``<checkpoint>/deliveries``:
whenever the ingestion starts, and with every batch, manifests that are no longer as
they were ingested are found by the file index and their days are ingested again.

    q = ingest_deliveries(spark, "s3a://bucket/feeds/", "suite", "s3a://lake/hits/",
                          checkpoint="s3a://lake/_chk/hits/", validate=True)
    q.awaitTermination()
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import paths
from ..errors import SchemaMismatchError
from ..functions.files import input_file_name
from ..functions.manifest import manifest_date
from ..options import selection
from ..sources.feed import read_feed
from ..sources.files import not_found
from ..sources.manifest import manifest_files

_STATE = T.StructType().add("manifest_name", "string").add("delivery_date", "date").add("modified", "timestamp") \
    .add("length", "long").add("ingested_at", "timestamp")


def _new_days(batch: DataFrame, feedname: str) -> list:
    name_re = "^" + paths.java_regex_literal(feedname) + r"_\d{4}-\d{2}-\d{2}\.txt$"
    return sorted(r.d for r in batch.select(F.col("manifest_name").alias("n"))
                  .where(F.col("n").rlike(name_re))
                  .select(manifest_date(F.col("n")).alias("d")).where(F.col("d").isNotNull())
                  .distinct().collect())


def check_target(spark: SparkSession, hits: DataFrame, target: str) -> None:
    """Refuse hits whose columns or types are not those of the table already at ``target``.

    A batch sees only its own deliveries; without this a later batch could change the table's columns.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return
    try:
        there = spark.read.parquet(target).schema
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # the folder is still empty
            return
        raise
    old, new = ({f.name: f.dataType.simpleString() for f in x.fields} for x in (there, hits.schema))
    if old != new:
        changed = sorted(n for n in old.keys() | new.keys() if old.get(n) != new.get(n))
        raise SchemaMismatchError(f"deliveries do not share the columns of {target}: {', '.join(changed)} differ")


def _write_days(spark: SparkSession, directory: str, feedname: str, target: str, days: list,
                validate: bool, column_types: dict | None) -> None:
    hits = read_feed(spark, directory, feedname, dates=days, validate=validate, column_types=column_types,
                     with_delivery_date=True)
    check_target(spark, hits, target)
    (hits.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("delivery_date").parquet(target))


def _state(spark: SparkSession, folder: str) -> DataFrame:
    """Every ingested manifest as it was when its hits were read last."""
    try:
        rows = spark.read.schema(_STATE).parquet(folder)
    except AnalysisException as e:
        if not not_found(e):
            raise
        rows = spark.createDataFrame([], _STATE)
    return rows.groupBy("manifest_name").agg(F.max_by(F.struct("modified", "length"), "ingested_at").alias("was")) \
        .select("manifest_name", "was.*")


def redelivered_days(spark: SparkSession, directory: str, feedname: str, state: str) -> list:
    """Days whose manifests are not as they were ingested."""
    now = manifest_files(spark, directory, feedname)
    before = _state(spark, state).withColumnsRenamed({"modified": "modified_then", "length": "length_then"})
    changed = now.join(before, "manifest_name").where("modified <> modified_then OR length <> length_then")
    return sorted(r.delivery_date for r in changed.select("delivery_date").distinct().collect())


def _ingest(spark: SparkSession, directory: str, feedname: str, target: str, days: list, state: str,
            validate: bool, column_types: dict | None) -> None:
    """Write the days, and remember their manifests as they were before the hits were read."""
    rows = manifest_files(spark, directory, feedname).where(F.col("delivery_date").isin(days)).collect()
    _write_days(spark, directory, feedname, target, days, validate, column_types)
    spark.createDataFrame([(r.manifest_name, r.delivery_date, r.modified, r.length) for r in rows],
                          T.StructType(_STATE.fields[:4])) \
        .withColumn("ingested_at", F.current_timestamp()).write.mode("append").parquet(state)


def reingest_deliveries(spark: SparkSession, directory: str, feedname: str, target: str, *, dates,
                        validate: bool = False, column_types: dict | None = None) -> None:
    """Overwrite the partitions of ``dates`` with what is delivered now.

    For days that :func:`ingest_deliveries` does not look at again: those of tables that it did not write.
    """
    _write_days(spark, directory, feedname, target, sorted(selection(dates=dates).dates), validate, column_types)


def ingest_deliveries(spark: SparkSession, directory: str, feedname: str, target: str, *,
                      checkpoint: str, validate: bool = False, column_types: dict | None = None,
                      max_deliveries_per_batch: int = 7, available_now: bool = True) -> StreamingQuery:
    """Start a stream that appends new deliveries of ``feedname`` to ``target``.

    Every batch must have the columns and types of the target. A day delivered again after its batch succeeded
    replaces its partition: before the stream starts, or (of a stream that keeps running) with its next batch.
    ``available_now=True`` processes what is there and stops (scheduled runs); otherwise the stream keeps
    polling the folder.
    """
    pattern = (paths.glob_escape(directory.rstrip("/")) + "/" + paths.glob_escape(feedname)
               + "_[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9].txt")
    manifests = (spark.readStream.format("text").option("wholetext", "true")
                 .option("maxFilesPerTrigger", max_deliveries_per_batch).load(pattern)
                 .select(input_file_name().alias("manifest_name")))

    state = checkpoint.rstrip("/") + "/deliveries"

    def write(session: SparkSession, days: list) -> None:
        for lo in range(0, len(days), max_deliveries_per_batch):
            _ingest(session, directory, feedname, target, days[lo:lo + max_deliveries_per_batch], state, validate, column_types)

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        days = _new_days(batch, feedname)
        if days:
            again = redelivered_days(batch.sparkSession, directory, feedname, state)
            write(batch.sparkSession, sorted({*days, *again}))

    write(spark, redelivered_days(spark, directory, feedname, state))

    writer = manifests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
