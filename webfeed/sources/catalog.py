"""Delivery catalogue: a persisted index of a feed's deliveries and files, kept up to date by increments.

The folder ``path`` holds two Parquet tables that are only appended to::

    deliveries  seq, delivery_date, manifest_name, modified, length, total_records, n_files, header array<string>, problem
    files       seq, delivery_date, file_key, length (null: absent), modified, expected_size, expected_md5, expected_records

:meth:`Catalog.refresh` looks at manifests modified after the high-water mark (the latest modification time it has,
less ``SLACK``), compares name, time and length with what it has, and opens only those that are new or were delivered
again. Their rows get the next ``seq``. Of a day the rows of its greatest ``seq`` are alive, so a day that is
delivered again replaces its rows; the ``deliveries`` rows are appended last and make those of ``files`` count, so
a refresh that is lost half-way leaves nothing behind that is read.

:meth:`Catalog.read` reads the hits without listing the feed's folder: the rows of ``files`` are dealt over tasks,
which open the files (:mod:`~webfeed.sources.lines`), and ``from_csv`` parses their records. The driver sees one row
per distinct header; neither the plan nor the driver's memory grows with the folder. Up to ``DIRECT_FILES`` files
are read by the native scan of :func:`~webfeed.sources.feed.read_feed`, with the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date as Date
from datetime import timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import paths
from ..errors import DeliveryError, ManifestError
from ..functions.types import feed_schema
from ..operators.validate import enforce, expected_files, validation_report
from ..options import DateSelection, selection
from ..plans.scan import CSV_OPTIONS, FeedScanPlan, ScanGroup, check_headers
from ..session import check_streamable, task_folder
from . import files as named_files
from .files import Files, not_found
from .header import distinct_headers
from .lines import columns_of, parsed, record_lines, spread
from .manifest import Delivery, load_deliveries, manifest_files

#: How much earlier than the high-water mark a manifest may be modified and still be noticed.
SLACK = timedelta(days=1)
#: Deliveries taken in at a time: what a refresh holds on the driver.
AT_ONCE = 366
#: Stored bytes of the files that a task reads.
TASK_BYTES = 128 << 20

_DELIVERIES = T.StructType() \
    .add("seq", "long").add("delivery_date", "date").add("manifest_name", "string").add("modified", "timestamp") \
    .add("length", "long").add("total_records", "long").add("n_files", "integer") \
    .add("header", T.ArrayType(T.StringType())).add("problem", "string")
_FILES = T.StructType() \
    .add("seq", "long").add("delivery_date", "date").add("file_key", "string").add("length", "long") \
    .add("modified", "timestamp").add("expected_size", "long").add("expected_md5", "string").add("expected_records", "long")


def _header_id(header: Column) -> Column:
    """A short name of a header (names hold no tab)."""
    return F.when(header.isNotNull(), F.md5(F.concat_ws("\t", header)))


class Catalog:
    """The catalogue of one feed, in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, directory: str, feedname: str):
        self.spark, self.path, self.directory, self.feedname = spark, path.rstrip("/"), directory, feedname

    # --- tables ---------------------------------------------------------------

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if not_found(e):
                return self.spark.createDataFrame([], schema)
            raise

    def deliveries(self, sel: DateSelection | None = None) -> DataFrame:
        """One row per delivery: the last one that a refresh has seen of its day."""
        rows = self._table("deliveries", _DELIVERIES)
        if sel is not None and sel.kind == "range":
            rows = rows.where(F.col("delivery_date").between(F.lit(sel.start), F.lit(sel.end)))
        elif sel is not None and sel.kind != "all":
            rows = rows.where(F.col("delivery_date").isin(sel.expected_dates()))
        last = Window.partitionBy("delivery_date").orderBy(F.col("seq").desc())
        return rows.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n")

    def files(self, sel: DateSelection | None = None) -> DataFrame:
        """One row per data file that a delivery lists, with the number of its columns and a digest of its header."""
        rows = self._table("files", _FILES)
        alive = self.deliveries(sel).select("delivery_date", "seq", F.size("header").alias("n_columns"),
                                            _header_id(F.col("header")).alias("header_id"))
        return rows.join(alive, ["delivery_date", "seq"])

    # --- refresh --------------------------------------------------------------

    def _changed(self, full: bool) -> list:
        """(day, name, modified, length) of manifests that are new or not as the catalogue has them."""
        known = self.deliveries()
        mark = F.to_utc_timestamp(F.max("modified") - F.lit(SLACK), F.current_timezone())
        since = None if full else known.agg(F.date_format(mark, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
        same = ["manifest_name", "modified", "length"]
        return manifest_files(self.spark, self.directory, self.feedname, since) \
            .join(known.select(*same), same, "left_anti").select("delivery_date", *same).orderBy("delivery_date").collect()

    def refresh(self, validate: bool = False, full: bool = False, at_once: int = AT_ONCE,
                ledger: str | None = None) -> int:
        """Take in deliveries that are new or were delivered again; how many.

        ``validate`` checks their files before anything is written (with a ``ledger`` only those that it does not know);
        ``full`` also looks at manifests older
        than the high-water mark (copied with an old modification time).
        """
        changed = self._changed(full)
        for lo in range(0, len(changed), at_once):
            self._take(changed[lo:lo + at_once], validate, ledger)
        return len(changed)

    def _take(self, changed: list, validate: bool, ledger: str | None) -> None:
        spark, sel = self.spark, DateSelection(dates=tuple(r.delivery_date for r in changed))
        found = load_deliveries(spark, self.directory, self.feedname, sel)
        problem = {d.delivery_date: "; ".join(d.problems) or (
            None if len(d.lookup_names) == 1 else f"lists {len(d.lookup_names)} lookup archives, expected exactly 1") for d in found}
        good = [d for d in found if problem[d.delivery_date] is None]
        if validate and good:
            days = DateSelection(dates=tuple(d.delivery_date for d in good))
            enforce(validation_report(spark, self.directory, self.feedname, days, deliveries=good,
                                      ledger=ledger), good)
        headers = self._headers(good, validate, problem)
        seq = 1 + max(self._table(t, s).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
                      for t, s in (("deliveries", _DELIVERIES), ("files", _FILES)))
        self._append("files", self._file_rows(sel, found).withColumn("seq", F.lit(seq).cast("long")), _FILES)
        seen = {r.delivery_date: r for r in changed}
        rows = [(seq, d.delivery_date, d.manifest_name, seen[d.delivery_date].modified, seen[d.delivery_date].length,
                 d.total_records, len(d.data_names), headers.get(d.delivery_date), problem[d.delivery_date]) for d in found]
        self._append("deliveries", spark.createDataFrame(rows, _DELIVERIES), _DELIVERIES)

    def _headers(self, good: list[Delivery], validated: bool, problem: dict) -> dict:
        """Header of every delivery; what is wrong with one goes to ``problem``. Of validated archives, each once."""
        if not good:
            return {}
        first: dict = {}
        chosen = {d.archive: first.setdefault((d.lookup_digests[0], d.lookup_sizes[0]) if validated else d.archive, d.archive)
                  for d in good}
        kinds = {a: (header, wrong) for header, wrong, archives in
                 distinct_headers(self.spark, self.directory, sorted(set(chosen.values()))) for a in archives}
        for d in good:
            if kinds[chosen[d.archive]][1] is not None:
                problem[d.delivery_date] = f"no hit-table header: {d.archive} ({kinds[chosen[d.archive]][1]})"
        return {d.delivery_date: kinds[chosen[d.archive]][0] for d in good if problem[d.delivery_date] is None}

    def _file_rows(self, sel: DateSelection, found: list[Delivery]) -> DataFrame:
        """Data files of the deliveries with what the file system says about them."""
        spark = self.spark
        names = sorted({paths.normal(n) for d in found for n in d.data_names})
        files = Files(spark, self.directory, names, spark.read.format("binaryFile").load)
        expected = expected_files(spark, self.directory, self.feedname, sel, ("data",)) \
            .select("delivery_date", "file_key", "expected_size", "expected_md5", "expected_records")
        there = files.select(files.name().alias("file_key"), "length", F.col("modificationTime").alias("modified")) \
            if files.exist else spark.createDataFrame([], "file_key string, length long, modified timestamp")
        missing = [paths.normal(n) for n in files.missing(names)]
        # A file of no bytes is in the index, but a scan has no row of it.
        length = F.when(F.col("file_key").isin(missing) if missing else F.lit(False), F.lit(None)) \
            .otherwise(F.coalesce("length", F.lit(0)))
        return expected.join(there.dropDuplicates(["file_key"]), "file_key", "left").withColumn("length", length)

    def _append(self, name: str, rows: DataFrame, schema: T.StructType) -> None:
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(f"{self.path}/{name}")

    # --- read -----------------------------------------------------------------

    def _checked(self, sel: DateSelection) -> list:
        """(header, days, first day, files, missing) by header, after the checks of a feed read."""
        chosen = self.deliveries(sel)
        bad = chosen.where("problem IS NOT NULL").orderBy("delivery_date").limit(10).collect()
        if bad:
            raise ManifestError("bad manifest(s):\n  " + "\n  ".join(f"{r.manifest_name}: {r.problem}" for r in bad))
        kinds = chosen.groupBy("header", _header_id(F.col("header")).alias("header_id")).agg(
            F.count(F.lit(1)).alias("days"), F.min("delivery_date").alias("first"), F.sum("n_files").alias("n_files")) \
            .orderBy("first").collect()
        expected = sel.expected_dates()
        if expected is None and not kinds:
            raise DeliveryError(f"the catalogue has no delivery of feed {self.feedname!r} in {self.directory}")
        if expected is not None and sum(k.days for k in kinds) < len(expected):
            wanted = self.spark.createDataFrame([(d,) for d in expected], "delivery_date date")
            lost = wanted.join(chosen, "delivery_date", "left_anti").orderBy("delivery_date").collect()
            raise DeliveryError(f"feed {self.feedname!r} has no delivery for "
                                f"{', '.join(r.delivery_date.isoformat() for r in lost)} in the catalogue")
        check_headers(self.spark, [(list(k.header), [k.first]) for k in kinds])
        absent = self.files(sel).where("length IS NULL").orderBy("file_key").limit(10).collect()
        if absent:
            raise DeliveryError("data files listed in a manifest are missing: " + ", ".join(r.file_key for r in absent))
        return kinds

    def read(self, *, date: str | Date | None = None, dates: str | Iterable[str | Date] | None = None,
             start: str | Date | None = None, end: str | Date | None = None,
             column_types: dict[str, T.DataType] | None = None, with_delivery_date: bool = False,
             task_bytes: int = TASK_BYTES, direct: int | None = None) -> DataFrame:
        """Hit rows as :func:`~webfeed.sources.feed.read_feed` gives them, by what the last refresh has seen."""
        sel = selection(date=date, dates=dates, start=start, end=end)
        kinds = self._checked(sel)
        if sum(k.n_files for k in kinds) <= (named_files.DIRECT_FILES if direct is None else direct):
            return self._scan(sel, kinds, column_types).to_dataframe(self.spark, with_delivery_date)
        folder = task_folder(self.spark, self.directory)
        if folder is None:
            check_streamable(self.directory)
        columns = list(kinds[0].header)
        parts = []
        for k in kinds:
            schema = feed_schema(k.header, column_types)
            mine = self.files(sel).where(F.col("header_id") == k.header_id)
            rows = record_lines(spread(mine, task_bytes), folder) \
                .select(parsed(F.col("line"), schema, CSV_OPTIONS).alias("r"), "delivery_date")
            parts.append(rows.select(*columns_of(F.col("r"), schema),
                                     *([F.col("delivery_date")] if with_delivery_date else [])))
        order = [F.col(paths.quoted(c)) for c in (*columns, *(["delivery_date"] if with_delivery_date else []))]
        return reduce(lambda a, b: a.unionAll(b), [p.select(*order) for p in parts])

    def _scan(self, sel: DateSelection, kinds: list, column_types: dict | None) -> FeedScanPlan:
        """The native scan of a few files."""
        by_header: dict[str, dict] = {k.header_id: {} for k in kinds}
        for r in self.files(sel).select("header_id", "delivery_date", "file_key").collect():
            by_header[r.header_id].setdefault(r.delivery_date, []).append(r.file_key)
        groups = tuple(ScanGroup(tuple(k.header), tuple(sorted(days)),
                                 tuple((d, tuple(sorted(fs))) for d, fs in sorted(days.items())))
                       for k in kinds for days in [by_header[k.header_id]])
        return FeedScanPlan(self.directory, tuple(kinds[0].header), groups, dict(column_types or {}))
