"""Manifest scan: one row per delivery, parsed in one Spark job for all days.

Schema of :func:`manifests`::

    feedname string, delivery_date date, manifest_name string, manifest_path string,
    version string, n_lookup_files int, n_data_files int, total_records bigint,
    lookup_files array<struct<name string, md5 string, size bigint>>,
    data_files   array<struct<name string, md5 string, size bigint, record_count bigint>>,
    problems array<string>

``problems`` lists what is wrong with the manifest itself (no metadata block,
unreadable numbers, declared and listed file counts differ). It is empty for a
good manifest.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import paths
from ..errors import DeliveryError, ManifestError
from ..functions import manifest as mf
from ..functions.files import input_file_name, input_file_path
from ..options import DateSelection

LOOKUP_ENTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("md5", T.StringType()),
    T.StructField("size", T.LongType()),
])
DATA_ENTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("md5", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("record_count", T.LongType()),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("feedname", T.StringType()),
    T.StructField("delivery_date", T.DateType()),
    T.StructField("manifest_name", T.StringType()),
    T.StructField("manifest_path", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("n_lookup_files", T.IntegerType()),
    T.StructField("n_data_files", T.IntegerType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("lookup_files", T.ArrayType(LOOKUP_ENTRY)),
    T.StructField("data_files", T.ArrayType(DATA_ENTRY)),
    T.StructField("problems", T.ArrayType(T.StringType())),
])


# Up to this many explicit dates, manifests are addressed by exact name (one
# metadata call each); more dates list the folder once and filter by name.
DIRECT_NAME_DATES = 32


def manifest_name(feedname: str, day: date) -> str:
    return f"{feedname}_{day.isoformat()}.txt"


def _manifest_glob(directory: str, feedname: str, sel: DateSelection) -> str:
    """Non-recursive glob for the selected manifests.

    A few explicit dates become exact names (direct lookups, no directory
    listing); many dates, a range or "all" list the directory once with a
    date-shaped wildcard. For dates and ranges, the date filter on the file
    name prunes the scan to the selected manifests (Spark applies ``_metadata``
    filters per file), so only those are read.
    """
    if sel.kind in ("date", "dates") and len(sel.expected_dates()) <= DIRECT_NAME_DATES:
        return paths.any_of(directory, [manifest_name(feedname, d) for d in sel.expected_dates()])
    day = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
    return paths.glob_escape(directory.rstrip("/")) + "/" + paths.glob_escape(feedname) + "_" + day + ".txt"


def manifests(spark: SparkSession, directory: str, feedname: str,
              sel: DateSelection | None = None) -> DataFrame:
    """Parsed manifests of the selected deliveries (lazy; empty if none exist)."""
    sel = sel or DateSelection()
    glob = _manifest_glob(directory, feedname, sel)
    try:
        raw = spark.read.text(glob, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise

    name_re = "^" + paths.java_regex_literal(feedname) + r"_\d{4}-\d{2}-\d{2}\.txt$"
    cols = _parse_columns(spark.sparkContext.applicationId)
    base = raw.select(*cols["base"]).where(F.col("manifest_name").rlike(name_re))
    if sel.kind == "range":
        base = base.where(F.col("delivery_date").between(F.lit(sel.start), F.lit(sel.end)))
    elif sel.kind == "dates" and len(sel.dates) > DIRECT_NAME_DATES:
        base = base.where(F.col("delivery_date").isin(list(sel.dates)))
    return base.select(F.lit(feedname).alias("feedname"), *cols["parsed"]) \
        .select(*cols["final"])


def manifest_files(spark: SparkSession, directory: str, feedname: str, since: str | None = None) -> DataFrame:
    """(manifest_name, delivery_date, modified, length) of the feed's manifests, by the file index alone.

    ``since``: only those modified after this time (UTC, ``yyyy-MM-ddTHH:mm:ss``). No manifest is opened.
    """
    names = paths.glob_escape(feedname) + "_[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9].txt"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", names)
    if since is not None:
        reader = reader.option("modifiedAfter", since).option("timeZone", "UTC")
    try:
        listed = reader.load(paths.glob_escape(directory.rstrip("/")))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], "manifest_name string, delivery_date date, modified timestamp, length long")
        raise
    name = input_file_name()
    return listed.select(name.alias("manifest_name"), mf.manifest_date(name).alias("delivery_date"),
                         F.col("modificationTime").alias("modified"), "length").where("delivery_date IS NOT NULL")


@functools.lru_cache(maxsize=4)
def _parse_columns(_app_id: str) -> dict[str, list]:
    """Parsing expressions, built once per application (they do not depend on the feed)."""
    text = F.col("text")
    meta = mf.metadata(text)
    base = [input_file_name().alias("manifest_name"), input_file_path().alias("manifest_path"),
            mf.manifest_date(input_file_name()).alias("delivery_date"),
            mf.normalized_text(F.col("value")).alias("text")]
    parsed = ["delivery_date", "manifest_name", "manifest_path",
              *[v.alias(k) for k, v in meta.items()],
              mf.lookup_entries(text).alias("lookup_files"), mf.data_entries(text).alias("data_files")]
    n_lk, n_dt = F.size("lookup_files"), F.size("data_files")
    has = F.col("has_metadata")
    checks = [
        F.when(F.col("delivery_date").isNull(), F.lit("file name has no valid date")),
        F.when(~has, F.lit("no metadata block")),
        F.when(has & (F.col("n_lookup_files").isNull() | F.col("n_data_files").isNull()
                      | F.col("total_records").isNull()),
               F.lit("metadata block has an unreadable number")),
        F.when(has & (n_lk != F.col("n_lookup_files")),
               F.format_string("declares %d lookup files but lists %d", F.col("n_lookup_files"), n_lk)),
        F.when(has & (n_dt != F.col("n_data_files")),
               F.format_string("declares %d data files but lists %d", F.col("n_data_files"), n_dt)),
        F.when(F.exists("data_files", lambda e: e["size"].isNull() | e["record_count"].isNull())
               | F.exists("lookup_files", lambda e: e["size"].isNull()),
               F.lit("a file entry has an unreadable size or record count")),
    ]
    problems = F.filter(F.array(*checks), lambda p: p.isNotNull())
    final = [*[c for c in MANIFEST_SCHEMA.fieldNames() if c != "problems"], problems.alias("problems")]
    return {"base": base, "parsed": parsed, "final": final}


@dataclass(frozen=True)
class Delivery:
    """What the driver holds of one delivery: its lookup archives (one, normally) and the names of its data files."""

    feedname: str
    delivery_date: date
    manifest_name: str
    total_records: int
    lookup_names: tuple[str, ...]
    data_names: tuple[str, ...]
    problems: tuple[str, ...]
    lookup_digests: tuple[str, ...] = ()
    lookup_sizes: tuple[int, ...] = ()

    @property
    def archive(self) -> str:
        """The lookup archive's path relative to the directory."""
        return paths.normal(self.lookup_names[0])


def load_deliveries(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
                    data_names: bool = True) -> list[Delivery]:
    """Run the manifest job; one :class:`Delivery` per manifest found, oldest first (no checks).

    Only names come to the driver, which plans scans by them; without ``data_names`` not even those of
    the data files.
    """
    names = F.transform("data_files", lambda e: e["name"]) if data_names else F.array().cast("array<string>")
    rows = manifests(spark, directory, feedname, sel).select(
        "feedname", "delivery_date", "manifest_name", "total_records", "lookup_files", names.alias("data_files"),
        "problems").collect()
    found = [Delivery(r.feedname, r.delivery_date, r.manifest_name, r.total_records,
                      tuple(x.name for x in r.lookup_files), tuple(r.data_files), tuple(r.problems),
                      tuple(x.md5 for x in r.lookup_files), tuple(x.size for x in r.lookup_files)) for r in rows]
    return sorted(found, key=lambda d: (d.delivery_date is not None, d.delivery_date or date.min))


def check_deliveries(found: list[Delivery], directory: str, feedname: str, sel: DateSelection,
                     need_archive: bool = True) -> None:
    """The always-on checks.

    Raises :class:`DeliveryError` when no manifest exists or selected dates
    have none (all missing dates at once), and :class:`ManifestError` when a
    manifest is unreadable, its counts disagree, or it does not list exactly one
    lookup archive (when the archive is needed).
    """
    expected = sel.expected_dates()
    if expected is None:
        if not found:
            raise DeliveryError(f"no manifest of feed {feedname!r} in {directory} "
                                "(directory missing or empty)")
    else:
        have = {d.delivery_date for d in found}
        missing = [d.isoformat() for d in expected if d not in have]
        if missing:
            raise DeliveryError(f"feed {feedname!r} has no delivery for {', '.join(missing)} in {directory}")

    bad = [f"{d.manifest_name}: {'; '.join(d.problems)}" for d in found if d.problems]
    if need_archive:
        bad += [f"{d.manifest_name}: lists {len(d.lookup_names)} lookup archives, expected exactly 1"
                for d in found if not d.problems and len(d.lookup_names) != 1]
    if bad:
        raise ManifestError("bad manifest(s):\n  " + "\n  ".join(sorted(bad)))


def collect_deliveries(spark: SparkSession, directory: str, feedname: str, sel: DateSelection,
                       need_archive: bool = True) -> list[Delivery]:
    """:func:`load_deliveries` followed by :func:`check_deliveries`."""
    found = load_deliveries(spark, directory, feedname, sel)
    check_deliveries(found, directory, feedname, sel, need_archive)
    return found
