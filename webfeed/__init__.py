"""Spark-native reader for daily web-analytics data-feed deliveries.

Public API::

    read_feed(spark, dir, feedname, date=|dates=|start=,end=, validate=False) -> DataFrame
    read_lookup(spark, dir, feedname, "event.tsv", ...)                        -> DataFrame
    manifests(spark, dir, feedname, selection)                                 -> DataFrame
    FeedReader(spark).option("dir", ..).option("feedname", ..).load()          -> DataFrame
"""

import sys

from pyspark import cloudpickle

from .errors import (DeliveryError, FeedError, FeedOptionError, ManifestError,
                     SchemaMismatchError, ValidationError)
from .options import KNOWN_LOOKUPS, DateSelection, selection
from .sources.feed import feed_plan, read_feed
from .sources.lookup import read_lookup
from .sources.manifest import manifests
from .sources.reader import FeedReader

# Task functions travel by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "DateSelection", "DeliveryError", "FeedError", "FeedOptionError", "FeedReader", "KNOWN_LOOKUPS",
    "ManifestError", "SchemaMismatchError", "ValidationError", "feed_plan", "manifests",
    "read_feed", "read_lookup", "selection",
]
