"""Scan plan of a feed read: which data files to read with which column order.

Deliveries that share a header are read by one native CSV scan. A delivery whose
columns are the same set in another order gets its own scan with its own
positional schema, and the scans are combined with ``unionByName``; the output
column order is that of the earliest delivery. A different set of columns, or a
duplicate name, is an error.

Only metadata reaches the driver: the distinct headers and the file names that
belong to each one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import paths
from ..errors import DeliveryError, ManifestError, SchemaMismatchError
from ..functions.files import raw_path
from ..functions.types import feed_schema
from .broadcast import bounded_broadcast, row_bytes
from ..sources.files import Files
from ..sources.header import collect_headers
from ..sources.manifest import Delivery

# CSV settings of a data file: tab separated, no header row; everything else is
# Spark's default (PERMISSIVE, '"' quote, '\\' escape, empty field = NULL).
CSV_OPTIONS = {"sep": "\t", "header": "false"}


@dataclass(frozen=True)
class ScanGroup:
    columns: tuple[str, ...]
    dates: tuple[date, ...]
    files_by_date: tuple[tuple[date, tuple[str, ...]], ...] = ()

    @property
    def files(self) -> list[str]:
        return [f for _, fs in self.files_by_date for f in fs]


@dataclass
class FeedScanPlan:
    directory: str
    columns: tuple[str, ...]
    groups: tuple[ScanGroup, ...]
    column_types: dict = field(default_factory=dict)
    _scans: list | None = field(default=None, repr=False, compare=False)

    @property
    def schema(self) -> T.StructType:
        return feed_schema(self.columns, self.column_types)

    def scans(self, spark: SparkSession) -> list[Files]:
        """The files of each column order, listed once per plan (also for the delivery-date column)."""
        if self._scans is None:
            scans, missing = [], []
            for g in self.groups:
                if g.files:
                    reader = spark.read.schema(feed_schema(g.columns, self.column_types)).options(**CSV_OPTIONS)
                    scans.append(Files(spark, self.directory, g.files, reader.csv))
                    missing += scans[-1].missing(g.files)
            if missing:
                more = f" and {len(missing) - 10} more" if len(missing) > 10 else ""
                raise DeliveryError("data files listed in a manifest are missing (validate=True names every bad "
                                    f"file): {', '.join(sorted(missing)[:10])}{more}")
            self._scans = scans
        return self._scans

    def to_dataframe(self, spark: SparkSession, with_delivery_date: bool = False) -> DataFrame:
        """The hit table: one native CSV scan per distinct column order.

        ``with_delivery_date`` appends ``delivery_date`` (the manifest's day) by
        joining each row's input file (its URI in the file index) to
        the plan's file list. That list has one row per data file, whose count
        and bytes are known here, so it is broadcast when small
        (:mod:`~webfeed.plans.broadcast`) and shuffled otherwise.
        """
        if with_delivery_date and any(c.lower() == "delivery_date" for c in self.columns):
            raise SchemaMismatchError("the feed has a column delivery_date of its own")
        columns = [F.col(paths.quoted(c)) for c in self.columns]
        if not any(g.files for g in self.groups):
            empty = spark.createDataFrame([], self.schema)
            return empty.withColumn("delivery_date", F.lit(None).cast("date")) if with_delivery_date else empty
        if not with_delivery_date:
            return reduce(lambda a, b: a.unionByName(b), [s.select(*columns) for s in self.scans(spark)])
        hits = reduce(lambda a, b: a.unionByName(b),
                      [s.select(*columns, raw_path().alias("__wf_file")) for s in self.scans(spark)])
        pairs = [(paths.normal(f), d) for g in self.groups for d, fs in g.files_by_date for f in fs]
        shared = sorted({f for f, n in Counter(f for f, _ in pairs).items() if n > 1})
        if shared:  # the join would multiply their rows, and no single day is right
            raise ManifestError(f"data files listed by more than one delivery have no single delivery date: "
                                f"{', '.join(shared[:10])}{' ...' if len(shared) > 10 else ''}")
        uri = {name: found for s in self.scans(spark) for name, found in s.exist.items()}
        pairs = [(uri[f], d) for f, d in pairs]
        owners = spark.createDataFrame(pairs, "__wf_file string, delivery_date date")
        owners = bounded_broadcast(owners, len(pairs), row_bytes([f for f, _ in pairs]))
        return hits.join(owners, "__wf_file", "left").drop("__wf_file")


def same_names(header: list[str], case_sensitive: bool) -> list[str]:
    """Names that occur more than once (or differ only in case, where Spark does not tell those apart)."""
    count = Counter(c if case_sensitive else c.lower() for c in header)
    return sorted({c for c in header if count[c if case_sensitive else c.lower()] > 1})


def _describe_difference(canonical: list[str], other: list[str], case_sensitive: bool) -> str:
    canon, seen = set(canonical), set(other)
    missing = [c for c in canonical if c not in seen]
    extra = [c for c in other if c not in canon]
    dups = same_names(other, case_sensitive)
    parts = []
    if missing:
        parts.append(f"missing {missing}")
    if extra:
        parts.append(f"extra {extra}")
    if dups:
        parts.append(f"duplicated {dups}")
    if len(other) != len(canonical) and not parts:
        parts.append(f"{len(other)} columns instead of {len(canonical)}")
    return ", ".join(parts)


def check_headers(spark: SparkSession, groups: list[tuple[list[str], list[date]]]) -> None:
    """Refuse headers (with their days, the earliest day's first) that do not share one set of columns."""
    canonical = groups[0][0]
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    problems = []
    for header, dates in groups:
        bad = any(same_names(header, case_sensitive)) or set(header) != set(canonical)
        if bad:
            problems.append(f"{', '.join(d.isoformat() for d in dates)}: "
                            f"{_describe_difference(canonical, header, case_sensitive)}")
    if problems:
        raise SchemaMismatchError("deliveries do not share the columns of "
                                  f"{groups[0][1][0].isoformat()}:\n  " + "\n  ".join(problems))


def plan_scan(spark: SparkSession, directory: str, deliveries: list[Delivery],
              column_types: dict | None = None, same_content: bool = False) -> FeedScanPlan:
    """Read the headers of all deliveries (one parallel job) and group deliveries by header.

    ``same_content``: archives of equal size and digest are known to be equal (they were validated); of each
    such kind one is unpacked.
    """
    stands_for = {d.archive: d.archive for d in deliveries}
    lengths = None
    if same_content:
        first: dict[tuple, str] = {}
        stands_for = {d.archive: first.setdefault((d.lookup_digests[0], d.lookup_sizes[0]), d.archive) for d in deliveries}
        lengths = {a: size for (_, size), a in first.items()}
    headers = collect_headers(spark, directory, sorted(set(stands_for.values())), lengths=lengths)
    dates_of: dict[tuple[str, ...], list] = {}
    for d in deliveries:
        dates_of.setdefault(tuple(headers[stands_for[d.archive]]), []).append(d.delivery_date)
    by_date = {d.delivery_date: d for d in deliveries}
    groups = sorted([(list(h), sorted(ds)) for h, ds in dates_of.items()], key=lambda g: g[1][0])
    check_headers(spark, groups)
    scan_groups = tuple(ScanGroup(tuple(header), tuple(dates), tuple((d, by_date[d].data_names) for d in dates))
                        for header, dates in groups)
    return FeedScanPlan(directory, tuple(groups[0][0]), scan_groups, dict(column_types or {}))
