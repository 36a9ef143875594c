"""Lookup scan: one lookup table from the most recent selected delivery, or its history over deliveries.

Lookup tables change over time (new browsers, new events), so the newest
delivery among the selected ones is used. The member is unpacked in a Python
worker and its lines are parsed by Spark's CSV parser (``from_csv``) with the
data files' settings, giving ``lookup_key string, lookup_value string``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import LOOKUP_SCHEMA
from ..operators.validate import enforce, validation_report
from ..options import check_lookup_name, selection
from ..plans.broadcast import bounded_broadcast, row_bytes
from ..plans.scan import CSV_OPTIONS
from .archive import ABSENT, DAMAGED, EMPTY, MISSING, archive_lines
from .manifest import check_deliveries, load_deliveries

# Spark's CSV reader skips lines that are empty after trimming (chars <= ' ').
_NOT_BLANK = r"[^\x00-\x20]"


def lookup_from_lines(lines: DataFrame, what: str, history: bool = False) -> DataFrame:
    """(key, value) rows from archive member lines; a missing member or a damaged
    archive fails the query. ``history``: with the line's number and what else stands beside it."""
    missing = F.raise_error(F.lit(f"lookup archive has no member {what}"))
    damaged = F.raise_error(F.concat(F.lit(f"lookup archive cannot be unpacked for {what}: "), F.col("line")))
    gone = F.raise_error(F.concat(F.lit("lookup archive missing: "), F.col("archive_name")))
    number = F.col("line_no")
    keep = (F.when(number == ABSENT, missing).when(number == DAMAGED, damaged).when(number == MISSING, gone)
            .when(number == EMPTY, F.lit(False)).otherwise(F.col("line").rlike(_NOT_BLANK)))
    parsed = F.from_csv(F.col("line"), LOOKUP_SCHEMA.simpleString(), {"sep": CSV_OPTIONS["sep"]})
    others = [c for c in lines.columns if c not in ("archive_name", "member", "line")]
    return lines.where(keep).select(parsed.alias("r"), *others).select("r.lookup_key", "r.lookup_value", *others) \
        .drop(*([] if history else ["line_no"]))


def read_lookup(spark: SparkSession, directory: str, feedname: str, name: str, *,
                date: str | Date | None = None,
                dates: str | Iterable[str | Date] | None = None,
                start: str | Date | None = None,
                end: str | Date | None = None,
                validate: bool = False) -> DataFrame:
    """Lookup ``name`` (e.g. ``"event.tsv"``) of the newest selected delivery.

    ``validate=True`` checks size and MD5 of all files of the selected
    deliveries (not record counts) before returning.
    """
    name = check_lookup_name(name)
    sel = selection(date=date, dates=dates, start=start, end=end)
    # every selected manifest is checked, but only the newest delivery's archive matters
    deliveries = load_deliveries(spark, directory, feedname, sel, data_names=False)
    check_deliveries(deliveries, directory, feedname, sel, need_archive=False)
    latest = max(deliveries, key=lambda d: d.delivery_date)
    check_deliveries([latest], directory, feedname, selection())
    if validate:
        enforce(validation_report(spark, directory, feedname, sel, check_records=False), deliveries,
                check_total=False)
    lines = archive_lines(spark, directory, [latest.archive], [name])
    return lookup_from_lines(lines, f"{name} in {latest.archive}")


@dataclass(frozen=True)
class LookupHistory:
    """How a lookup changed over deliveries.

    ``intervals``: ``lookup_key, lookup_value, valid_from, valid_until, first, last``, one row for every run of
    consecutive deliveries in which a key has a value: days from ``valid_from`` to before ``valid_until`` (null: still
    valid), and the numbers of the run's first and last delivery. ``days``: the deliveries, by number.
    """

    intervals: DataFrame
    days: tuple[Date, ...]


def read_lookup_history(spark: SparkSession, directory: str, feedname: str, name: str, *,
                        dates: str | Iterable[str | Date] | None = None,
                        start: str | Date | None = None,
                        end: str | Date | None = None) -> LookupHistory:
    """The history of lookup ``name`` over the selected deliveries (each must hold it).

    A delivery holds from its day to before the day of the next selected one. Of lines that repeat a key in a
    delivery the last counts; a key that a delivery lacks has no value until one lists it again.
    """
    name = check_lookup_name(name)
    sel = selection(dates=dates, start=start, end=end)
    deliveries = load_deliveries(spark, directory, feedname, sel, data_names=False)
    check_deliveries(deliveries, directory, feedname, sel)
    days = tuple(d.delivery_date for d in deliveries)
    rows = [(d.archive, i, day, until) for i, (d, day, until) in enumerate(zip(deliveries, days, (*days[1:], None), strict=True))]
    owners = spark.createDataFrame(rows, "archive_name string, n int, day date, until date")
    owners = bounded_broadcast(owners, len(rows), row_bytes([r[0] for r in rows]))
    lines = archive_lines(spark, directory, [d.archive for d in deliveries], [name]).join(owners, "archive_name")
    found = lookup_from_lines(lines, name, history=True).groupBy("lookup_key", "n", "day", "until") \
        .agg(F.max_by("lookup_value", "line_no").alias("lookup_value"))
    run = Window.partitionBy("lookup_key", "lookup_value").orderBy("n")
    intervals = found.withColumn("run", F.col("n") - F.row_number().over(run)).groupBy("lookup_key", "lookup_value", "run").agg(
        F.min("day").alias("valid_from"), F.max_by("until", "n").alias("valid_until"),
        F.min("n").alias("first"), F.max("n").alias("last")).drop("run")
    return LookupHistory(intervals, days)
