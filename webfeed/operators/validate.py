"""Delivery validation: file presence, size, MD5 digest and record counts.

:func:`validation_report` returns one row per file listed in the selected
manifests::

    delivery_date date, kind string ('data' | 'lookup'), file_name string,
    file_exists boolean, expected_size bigint, actual_size bigint, size_ok boolean,
    expected_md5 string, actual_md5 string, md5_ok boolean,
    expected_records bigint, actual_records bigint, records_ok boolean, ok boolean

All work is Spark jobs; what the manifests promise is read from one manifest scan, and the driver holds
only names:

* presence comes from the ``binaryFile`` file index (no content read, no job).
  Spark's scans skip zero-byte files, so a listed file with no scan row is empty:
  size 0, the digest of no bytes;
* data files are read once: the task that feeds the digest with the stored bytes
  counts the records in the decoded ones (:mod:`~webfeed.functions.records`,
  the counts of the read's CSV settings), so a damaged file is reported with the
  records before the damage. Archives, and files whose records are not asked
  for, are ``md5(content)`` in the JVM;
* files up to ``md5_inline_max_bytes`` (their real length) come as ``binaryFile``
  content, many per task; larger files are streamed in Python tasks in 8 MiB
  chunks, one file per task, so memory stays flat however big a file is;
* data files in another compression than gzip are counted by Spark's own scan,
  those with a wrong size or digest by one that skips what cannot be read.

A validated read thus makes two passes over the hits: the check, and the query.
Files are keyed by their path relative to the directory.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import paths
from ..errors import ValidationError
from ..functions import records
from ..functions.files import normal_name, raw_path, relative_name
from ..options import DateSelection
from ..plans.broadcast import bounded_broadcast, row_bytes
from ..plans.scan import CSV_OPTIONS
from ..session import TaskFolder, task_folder
from ..sources.archive import MAX_CONTENT
from ..sources.files import Files, root_path
from .ledger import checked
from ..sources.manifest import Delivery, load_deliveries, manifests

MD5_INLINE_MAX_BYTES = 128 * 1024 * 1024
_CHUNK = 8 * 1024 * 1024

# Bad files of one delivery that reach the driver as examples.
EXAMPLES = 10
# MD5 of zero bytes: the digest of an empty file, which scans return no row for.
EMPTY_MD5 = hashlib.md5(b"").hexdigest()


def expected_files(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
                   kinds: tuple[str, ...] = ("data", "lookup")) -> DataFrame:
    """Files the manifests promise, one row per listed file (lazy; one scan, nothing reaches the driver)."""
    def listed(kind: str, files: str) -> Column:
        return F.transform(files, lambda e: F.struct(
            F.lit(kind).alias("kind"), e["name"].alias("file_name"), normal_name(e["name"]).alias("file_key"),
            e["size"].alias("expected_size"), e["md5"].alias("expected_md5"),
            (e["record_count"] if kind == "data" else F.lit(None).cast("bigint")).alias("expected_records")))

    every = [listed(kind, files) for kind, files in (("data", "data_files"), ("lookup", "lookup_files")) if kind in kinds]
    return manifests(spark, directory, feedname, sel).select("delivery_date", F.inline(F.concat(*every)))


# Data files whose content a pass can decode: gzip, or no compression. Spark tells by the last extension.
_OTHER_CODECS = re.compile(r"\.(bz2|deflate|lz4|snappy|zst)$")
_CHECKED = "file_key string, actual_size bigint, actual_md5 string, actual_records bigint"


def _check_files(folder: TaskFolder | None):
    """Task: data files (``content``, or only their names) -> size, digest and records from one pass."""
    def task(batches):
        for b in batches:
            keys, found = b.column("file_key").to_pylist(), []
            for i, key in enumerate(keys):
                if "content" in b.schema.names:
                    found.append(records.checked(records.pieces(b.column("content")[i].as_buffer()), key.endswith(".gz")))
                    continue
                with folder.open(key) as f:
                    found.append(records.checked(iter(lambda f=f: f.read(_CHUNK), b""), key.endswith(".gz")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[0] for x in found], pa.string()), pa.array([x[2] for x in found], pa.int64())],
                names=["file_key", "actual_size", "actual_md5", "actual_records"])
    return task


def _stream_md5(folder: TaskFolder | None):
    """Task: MD5 of big files read in chunks (memory independent of size)."""
    def task(batches):
        import hashlib

        for b in batches:
            digests = []
            for key in b.column("file_key").to_pylist():
                h = hashlib.md5()
                with folder.open(key) as f:
                    while chunk := f.read(_CHUNK):
                        h.update(chunk)
                digests.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("file_key"), b.column("actual_size"), pa.array(digests, pa.string())],
                                             names=["file_key", "actual_size", "actual_md5"])
    return task


def file_digests(spark: SparkSession, files: Files, directory: str, inline_max: int = MD5_INLINE_MAX_BYTES,
                 data: list[str] | None = None, only: list[str] | None = None) -> DataFrame:
    """``file_key, actual_size, actual_md5, actual_records`` of every file (of those in ``only``) that is not empty.

    Records are counted of the files named in ``data``, in the same pass. The ``length`` filters are pushed
    into the ``binaryFile`` scan, which skips the content of files it filters out: small files are read whole,
    big ones (if there is any) are never loaded whole but streamed in Python tasks. No shuffle: the
    scan packs files into tasks by size, so a file bigger than the split size has a task of its own.
    """
    key, length = files.name().alias("file_key"), F.col("length")
    names = set(files.exist) if only is None else set(only)
    counted = names & set(data or ())
    folder = task_folder(spark, directory)
    if folder is None:  # a store that tasks do not know: every size by Spark's client
        inline_max = MAX_CONTENT

    def among(chosen: set[str]) -> Column:
        return F.lit(True) if len(chosen) == len(files.exist) else raw_path().isin([files.exist[n] for n in sorted(chosen)])

    big = not files.select(key, where=among(names) & (length > inline_max)).isEmpty()
    small, large = length <= inline_max, length > inline_max
    parts = []
    if names - counted or not names:
        rest = among(names - counted)
        parts.append(files.select(key, length.alias("actual_size"), F.md5("content").alias("actual_md5"),
                                  F.lit(None).cast("bigint").alias("actual_records"), where=rest & small))
        if big:
            parts.append(files.select(key, length.alias("actual_size"), where=rest & large)
                         .mapInArrow(_stream_md5(folder), "file_key string, actual_size bigint, actual_md5 string")
                         .withColumn("actual_records", F.lit(None).cast("bigint")))
    if counted:
        check = _check_files(folder)
        parts.append(files.select(key, "content", where=among(counted) & small).mapInArrow(check, _CHECKED))
        if big:
            parts.append(files.select(key, where=among(counted) & large).mapInArrow(check, _CHECKED))
    return reduce(lambda a, b: a.unionByName(b), parts)


def file_row_counts(spark: SparkSession, directory: str, names: list[str], damaged: list[str]) -> DataFrame:
    """``file_key, actual_records``: rows per data file under the read's CSV settings.

    PERMISSIVE parsing never drops a row, so the count does not depend on the
    column schema; a one-column schema is used and nothing is parsed. A file in
    ``damaged`` yields the rows before the damage.
    """
    skip = set(damaged)
    parts = []
    for chosen, tolerant in (([n for n in names if n not in skip], "false"),
                             ([n for n in names if n in skip], "true")):
        if chosen:
            reader = spark.read.schema("_c0 string").options(**CSV_OPTIONS).option("ignoreCorruptFiles", tolerant)
            files = Files(spark, directory, chosen, reader.csv)
            found = files.select(raw_path().alias("uri"))
            if found is not None:
                parts.append(found)
    if not parts:
        return spark.createDataFrame([], "file_key string, actual_records bigint")
    counts = reduce(lambda a, b: a.unionAll(b), parts).groupBy("uri").agg(F.count(F.lit(1)).alias("actual_records"))
    return counts.select(relative_name(root_path(spark, directory), F.col("uri")).alias("file_key"), "actual_records")


def validation_report(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None, *,
                      check_md5: bool = True, check_records: bool = True,
                      kinds: tuple[str, ...] = ("data", "lookup"),
                      md5_inline_max_bytes: int = MD5_INLINE_MAX_BYTES,
                      deliveries: list[Delivery] | None = None,
                      ledger: str | None = None, full: bool = False) -> DataFrame:
    """Per-file report of the selected deliveries (see module docstring); lazy.

    ``deliveries``: those of ``sel``, where the caller has them. With a ``ledger`` (a folder, see
    :mod:`~webfeed.operators.ledger`) the content of files that have not changed since an earlier validation is
    not read again, unless ``full``; what must be read is read at once. Every side joined to the expected files has at
    most one row per listed file, holding that file's name: row count and bytes are known on the driver, so it is
    broadcast when both are small (:mod:`~webfeed.plans.broadcast`) and shuffled otherwise.
    """
    if deliveries is None:
        deliveries = load_deliveries(spark, directory, feedname, sel)
    data_names = sorted({paths.normal(n) for d in deliveries for n in d.data_names})
    names = sorted({*(data_names if "data" in kinds else ()),
                    *(paths.normal(n) for d in deliveries for n in d.lookup_names if "lookup" in kinds)})
    per_row = row_bytes(names)

    def bounded(df: DataFrame) -> DataFrame:
        return bounded_broadcast(df, len(names), per_row)

    files = Files(spark, directory, names, spark.read.format("binaryFile").load)
    counted = [n for n in data_names if n in files.exist] if check_records and "data" in kinds else []
    other = [n for n in counted if _OTHER_CODECS.search(n)]
    here = [n for n in counted if not _OTHER_CODECS.search(n)]
    if not files.exist:
        actual = spark.createDataFrame([], _CHECKED)
    elif ledger is not None and (check_md5 or here):
        actual = checked(spark, ledger, files, here, full, lambda only: file_digests(
            spark, files, directory, md5_inline_max_bytes, here, only))
    elif check_md5 or here:
        actual = file_digests(spark, files, directory, md5_inline_max_bytes, here)
    else:
        actual = files.select(files.name().alias("file_key"), F.col("length").alias("actual_size"),
                              F.lit(None).cast("string").alias("actual_md5"), F.lit(None).cast("bigint").alias("actual_records"))
    missing = [paths.normal(n) for n in files.missing(names)]
    expected = expected_files(spark, directory, feedname, sel, kinds) \
        .withColumn("file_exists", ~F.col("file_key").isin(missing) if missing else F.lit(True))
    report = expected.join(bounded(actual), "file_key", "left")
    if other:
        wrong = ~F.col("actual_size").eqNullSafe(F.col("expected_size"))
        if check_md5:
            wrong = wrong | ~F.col("actual_md5").eqNullSafe(F.col("expected_md5"))
        damaged = [r.file_key for r in report.where(wrong & F.col("file_exists") & F.col("file_key").isin(other))
                   .select("file_key").distinct().collect()]
        counts = file_row_counts(spark, directory, other, damaged).withColumnRenamed("actual_records", "scanned")
        report = report.join(bounded(counts), "file_key", "left") \
            .withColumn("actual_records", F.coalesce("actual_records", "scanned"))  # each file once, however often listed

    exists = F.col("file_exists")
    empty = exists & F.col("actual_size").isNull()  # listed in the index, no scan row
    is_data = F.col("kind") == "data"
    actual_size = F.when(exists, F.coalesce("actual_size", F.lit(0)).cast("bigint"))
    actual_md5 = F.when(empty, F.lit(EMPTY_MD5)).otherwise(F.col("actual_md5")) if check_md5 \
        else F.lit(None).cast("string")
    size_ok = exists & (actual_size == F.col("expected_size"))
    md5_ok = (exists & (actual_md5 == F.col("expected_md5"))) if check_md5 \
        else F.lit(None).cast("boolean")
    actual_records = F.when(is_data & exists & F.lit(check_records), F.coalesce("actual_records", F.lit(0)).cast("bigint"))
    records_ok = (F.when(is_data, exists & (actual_records == F.col("expected_records")))
                  if check_records else F.lit(None).cast("boolean"))
    ok = size_ok & F.coalesce(md5_ok, F.lit(True)) & F.coalesce(records_ok, F.lit(True))
    return report.select(
        "delivery_date", "kind", "file_name", "file_exists",
        "expected_size", actual_size.alias("actual_size"), size_ok.alias("size_ok"),
        "expected_md5", actual_md5.alias("actual_md5"), md5_ok.alias("md5_ok"),
        "expected_records", actual_records.alias("actual_records"),
        records_ok.alias("records_ok"), ok.alias("ok"),
    )


def delivery_summary(report: DataFrame) -> DataFrame:
    """One row per delivery: rows read from its data files, the number of its bad files and some of these.

    The list that is cut to ``EXAMPLES`` holds one delivery's bad files, never more than its manifest lists.
    """
    bad = F.struct("file_name", "file_exists", "size_ok", "md5_ok", "records_ok",
                   "actual_size", "expected_size", "actual_md5", "expected_md5",
                   "actual_records", "expected_records")
    found = F.collect_list(F.when(~F.col("ok"), bad))
    return report.groupBy("delivery_date").agg(
        F.sum(F.when(F.col("kind") == "data", F.col("actual_records"))).alias("records_read"),
        F.count_if(~F.col("ok")).alias("n_bad"), F.slice(F.array_sort(found), 1, EXAMPLES).alias("bad_files"))


def _fault(f) -> str:
    if not f.file_exists:
        return "file missing"
    what = []
    if not f.size_ok:
        what.append(f"size {f.actual_size} != {f.expected_size}")
    if f.md5_ok is False:
        what.append(f"md5 {f.actual_md5} != {f.expected_md5}")
    if f.records_ok is False:
        what.append(f"records {f.actual_records} != {f.expected_records}")
    return ", ".join(what)


def enforce(report: DataFrame, deliveries: list[Delivery], check_total: bool = True) -> None:
    """Raise :class:`ValidationError` naming the bad files (of each delivery the first ``EXAMPLES``, and how
    many more) and every wrong total; the report itself lists all."""
    messages, failures = [], []
    summary = {r.delivery_date: r for r in delivery_summary(report).collect()}
    for d in deliveries:
        row = summary.get(d.delivery_date)
        shown = row.bad_files if row else []
        failures += shown
        messages += [f"{d.delivery_date} {f.file_name}: {_fault(f)}" for f in shown]
        if row and row.n_bad > len(shown):
            messages.append(f"{d.delivery_date}: {row.n_bad - len(shown)} more bad files")
        read = (row.records_read if row else 0) or 0
        if check_total and read != d.total_records:
            messages.append(f"{d.delivery_date} {d.manifest_name}: Total-Records {d.total_records}, read {read}")
    if messages:
        raise ValidationError("validation failed:\n  " + "\n  ".join(messages), failures)
