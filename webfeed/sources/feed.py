"""Feed scan: the hit table of the selected deliveries as one typed DataFrame.

``read_feed`` runs two small metadata jobs (manifests; headers) and, with
``validate=True``, one validation job, then returns a *lazy* DataFrame built
from native CSV scans. Whatever query follows keeps Catalyst's column pruning
and filter pushdown on the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.validate import enforce, validation_report
from ..options import DateSelection, selection
from ..plans.scan import FeedScanPlan, plan_scan
from .manifest import collect_deliveries


def feed_plan(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
              column_types: dict[str, T.DataType] | None = None, validate: bool = False,
              ledger: str | None = None) -> FeedScanPlan:
    """Manifests -> checks -> (validation when asked) -> headers -> scan plan.

    Validation needs no header, so it runs first: a damaged archive or data
    file is reported by its size and digest before anything is unpacked.
    """
    sel = sel or DateSelection()
    deliveries = collect_deliveries(spark, directory, feedname, sel)
    if validate:
        enforce(validation_report(spark, directory, feedname, sel, deliveries=deliveries, ledger=ledger), deliveries)
    return plan_scan(spark, directory, deliveries, column_types, same_content=validate)


def read_feed(spark: SparkSession, directory: str, feedname: str, *,
              date: str | Date | None = None,
              dates: str | Iterable[str | Date] | None = None,
              start: str | Date | None = None,
              end: str | Date | None = None,
              validate: bool = False,
              column_types: dict[str, T.DataType] | None = None,
              with_delivery_date: bool = False, ledger: str | None = None) -> DataFrame:
    """Hit rows of the chosen deliveries of ``feedname`` in ``directory``.

    Choose at most one of ``date``, ``dates`` (list or comma separated) or the
    inclusive ``start``/``end`` range; with none, every delivery in the
    directory is read. ``validate=True`` checks every file's size and MD5 and
    every file's and delivery's record count before returning. ``column_types``
    overrides the type of named columns (e.g. ``{"mcvisid": StringType()}`` to
    keep ids that do not fit the default type). ``with_delivery_date=True`` adds
    a ``delivery_date`` column (the day of the delivery each row came from).
    ``ledger`` names a folder where validations keep what they found: files that have
    not changed since are not read again (:mod:`~webfeed.operators.ledger`).
    """
    sel = selection(date=date, dates=dates, start=start, end=end)
    plan = feed_plan(spark, directory, feedname, sel, column_types, validate, ledger)
    return plan.to_dataframe(spark, with_delivery_date)
