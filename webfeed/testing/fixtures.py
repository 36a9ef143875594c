"""The test feeds derived from a test-data folder's ``events`` table.

Delivery folders, each written on first use (once per process and data
folder) under the application's shared scratch folder:

* ``main``    feed ``shop.web``: one data file per day, plus a decoy feed
  ``shopxweb`` in the same folder (its name differs by the regex dot);
* ``multi``   feed ``multi``: three data files per day, CRLF manifests with
  blank-padded numbers;
* ``reorder`` feed ``reorder``: even days list the columns in reverse order;
* ``broken``  feed ``broken``: planted defects, by day of month (below);
* ``gaps``    feed ``gaps``: no delivery on days 10, 20, 30;
* ``subfolders``  feed ``subfolders``: every day in a folder of its own with the same base names; even days
  list the columns in reverse order;
* ``names``   feed ``names``: two more columns, ``page.name`` and ``user`id``;
* ``locale``  feed ``locale``: from day 21 on, ``curr_rate`` has a decimal comma.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from ..session import new_scratch_path
from .feedwriter import DEFAULT_HEADER, Defects, FeedSpec, write_feed

MAIN_FEED = "shop.web"
DECOY_FEED = "shopxweb"
MULTI_FEED = "multi"
REORDER_FEED = "reorder"
BROKEN_FEED = "broken"
LOCALE_FEED = "locale"
GAPS_FEED = "gaps"
SUBFOLDERS_FEED = "subfolders"
NAMES_FEED = "names"
COMMA_DECIMAL_FROM = 21

MULTI_FILES_PER_DAY = 3

# Planted defects of the broken feed (day of month).
BROKEN = Defects(
    bad_md5_data=frozenset({7}),
    bad_size_data=frozenset({8}),
    bad_record_count=frozenset({9}),
    bad_total=frozenset({11}),
    bad_declared_files=frozenset({12}),
    missing_data_file=frozenset({14}),
    two_archives=frozenset({15}),
    no_header_member=frozenset({16}),
    bad_md5_archive=frozenset({18}),
    no_archive=frozenset({19}),
    missing_archive=frozenset({21}),
    empty_header=frozenset({22}),
    damaged_archive=frozenset({23}),
    two_line_header=frozenset({24}),
)
GAPS = Defects(skip_days=frozenset({10, 20, 30}))
EXTRA_COLUMN_DAY = 13       # header has one more column: extra_col
DUPLICATE_COLUMN_DAY = 17   # header lists pagename twice


def _reordered(d):
    return tuple(reversed(DEFAULT_HEADER)) if d.day % 2 == 0 else DEFAULT_HEADER


def _broken_header(d):
    if d.day == EXTRA_COLUMN_DAY:
        return DEFAULT_HEADER + ("extra_col",)
    if d.day == DUPLICATE_COLUMN_DAY:
        return DEFAULT_HEADER + ("pagename",)
    return DEFAULT_HEADER


_FOLDERS = {
    "main": [FeedSpec(MAIN_FEED), FeedSpec(DECOY_FEED, days=lambda d: d.day <= 3)],
    "multi": [FeedSpec(MULTI_FEED, files_per_day=MULTI_FILES_PER_DAY, crlf=True, padded_numbers=True)],
    "reorder": [FeedSpec(REORDER_FEED, header_for_day=_reordered)],
    "broken": [FeedSpec(BROKEN_FEED, header_for_day=_broken_header, defects=BROKEN)],
    "locale": [FeedSpec(LOCALE_FEED, comma_decimal_from=COMMA_DECIMAL_FROM)],
    "gaps": [FeedSpec(GAPS_FEED, defects=GAPS)],
    "subfolders": [FeedSpec(SUBFOLDERS_FEED, header_for_day=_reordered, subfolders=True)],
    "names": [FeedSpec(NAMES_FEED, header_for_day=lambda d: (*DEFAULT_HEADER, "page.name", "user`id"))],
}


class Fixtures:
    """Folder paths by name (``main``, ``multi``, ...); each is written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir.rstrip("/")
        self.root = new_scratch_path(spark, "webfeed-fixtures")
        self._written: set[str] = set()
        self._lock = threading.Lock()

    def _folder(self, name: str) -> str:
        path = f"{self.root}/{name}"
        with self._lock:
            if name not in self._written:
                events = self._spark.read.parquet(f"{self._sf_dir}/events.parquet")
                for spec in _FOLDERS[name]:
                    write_feed(self._spark, events, path, f"{self.root}/_staging", spec)
                self._written.add(name)
        return path

    main = property(lambda self: self._folder("main"))
    multi = property(lambda self: self._folder("multi"))
    reorder = property(lambda self: self._folder("reorder"))
    broken = property(lambda self: self._folder("broken"))
    locale = property(lambda self: self._folder("locale"))
    gaps = property(lambda self: self._folder("gaps"))
    subfolders = property(lambda self: self._folder("subfolders"))
    names = property(lambda self: self._folder("names"))

    def build_all(self) -> Fixtures:
        for name in _FOLDERS:
            self._folder(name)
        return self


_CACHE: dict[tuple[int, str], Fixtures] = {}
_LOCK = threading.Lock()


def build(spark: SparkSession, sf_dir: str) -> Fixtures:
    """The fixture folders of this process, session and data folder (written lazily)."""
    key = (id(spark.sparkContext), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = Fixtures(spark, sf_dir)
        return _CACHE[key]
