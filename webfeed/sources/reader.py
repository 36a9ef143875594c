"""Option-style reader: the same options a data-source user passes.

    FeedReader(spark).option("dir", "file:///feeds/").option("feedname", "suite")
        .option("date", "2024-01-05").load()                 # hit table
    FeedReader(spark).options(dir=..., feedname=...).load("event.tsv")   # lookup

Keys are case-insensitive: ``dir``, ``feedname``, ``date``, ``dates`` (comma
separated), ``from``, ``to``, ``validate`` ("true"/"false"); ``load(name)`` or
option ``path`` names a lookup. Unknown keys are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..options import request_from_options
from .feed import read_feed
from .lookup import read_lookup


class FeedReader:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, object] = {}

    def option(self, key: str, value: object) -> FeedReader:
        self._options[key.lower()] = value
        return self

    def options(self, **options: object) -> FeedReader:
        for k, v in options.items():
            self.option(k, v)
        return self

    def load(self, path: str | None = None) -> DataFrame:
        req = request_from_options(self._options, path)
        sel = req.selection
        dates = ",".join(d.isoformat() for d in sel.dates) if sel.dates else None
        kwargs = dict(date=sel.date, dates=dates, start=sel.start, end=sel.end, validate=req.validate)
        if req.lookup is not None:
            return read_lookup(self._spark, req.dir, req.feedname, req.lookup, **kwargs)
        return read_feed(self._spark, req.dir, req.feedname, **kwargs)
