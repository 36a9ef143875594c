"""Benchmark: headline feed reads over test deliveries built from ``events``.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Builds the test deliveries first (timed apart, ``fixture_build_sec``), runs
every query once to warm up, then times ``BENCH_REPEATS`` runs (default 3) and
reports the median per query. ``control_sec`` times a fixed plain Spark job
(``spark.range`` aggregation, not part of ``value``) the same way: the host's
speed drifts a lot, and the ratio to this control compares runs made at
different times. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webfeed import read_feed, read_lookup  # noqa: E402
from webfeed.operators import reports  # noqa: E402
from webfeed.operators.decode import decode_as_of  # noqa: E402
from webfeed.session import new_scratch_path  # noqa: E402
from webfeed.sources.catalog import Catalog  # noqa: E402
from webfeed.sources.lookup import read_lookup_history  # noqa: E402
from webfeed.streaming.ingest import ingest_deliveries  # noqa: E402
from webfeed.testing import fixtures as fx  # noqa: E402
from webfeed.testing.feedwriter import DEFAULT_HEADER, WIDE_COLUMNS, FeedSpec, write_feed  # noqa: E402


MANY_FEED = "many"


def _many(spark: SparkSession, sf_dir: str) -> str:
    """A feed of about 1,000 data files (35 each day) and 63 columns."""
    header = (*DEFAULT_HEADER, *WIDE_COLUMNS)
    path = new_scratch_path(spark, "bench-many")
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    write_feed(spark, events, path, path + "-staging",
               FeedSpec(MANY_FEED, files_per_day=35, header_for_day=lambda d: header))
    return path


def _queries(spark: SparkSession, f: fx.Fixtures, many: str):
    catalog = Catalog(spark, new_scratch_path(spark, "bench-catalog"), many, MANY_FEED)
    catalog.refresh()
    ledger = new_scratch_path(spark, "bench-ledger")
    return {
        "read_one_day_pages": lambda s: read_feed(s, f.main, fx.MAIN_FEED, date="2024-01-05")
        .groupBy("pagename").count().collect(),
        "read_30_days_pages": lambda s: read_feed(s, f.main, fx.MAIN_FEED)
        .groupBy("pagename").count().collect(),
        "read_30_days_validate": lambda s: read_feed(s, f.main, fx.MAIN_FEED, validate=True)
        .groupBy("pagename").count().collect(),
        "read_range_visitors": lambda s: read_feed(s, f.main, fx.MAIN_FEED, start="2024-01-08", end="2024-01-21")
        .groupBy(F.to_date("date_time")).agg(F.countDistinct("visid_low")).collect(),
        "read_multi_file_revenue": lambda s: read_feed(s, f.multi, fx.MULTI_FEED)
        .groupBy("pagename").agg(F.sum("curr_rate")).collect(),
        "read_reordered_pages": lambda s: read_feed(s, f.reorder, fx.REORDER_FEED)
        .groupBy("pagename").count().collect(),
        "load_lookup": lambda s: read_lookup(s, f.main, fx.MAIN_FEED, "event.tsv").collect(),
        "manifest_catalog": lambda s: reports.manifest_catalog(s, f.main, fx.MAIN_FEED).collect(),
        "validation_report": lambda s: reports.feed_validation(s, f.broken, fx.BROKEN_FEED).collect(),
        "delivery_gaps": lambda s: reports.delivery_gaps(s, f.broken, fx.BROKEN_FEED).collect(),
        "read_with_delivery_date": lambda s: read_feed(s, f.multi, fx.MULTI_FEED, with_delivery_date=True)
        .groupBy("delivery_date").count().collect(),
        "type_losses": lambda s: reports.type_losses(s, f.locale, fx.LOCALE_FEED).collect(),
        "stream_ingest": lambda s: ingest_deliveries(
            s, f.main, fx.MAIN_FEED, new_scratch_path(s, "bench-hits"),
            checkpoint=new_scratch_path(s, "bench-checkpoint")).awaitTermination(),
        "read_many_files_wide": lambda s: read_feed(s, many, MANY_FEED).select("pagename", "curr_rate")
        .groupBy("pagename").agg(F.sum("curr_rate")).collect(),
        "catalog_many_files_wide": lambda s: catalog.read(direct=0).select("pagename", "curr_rate")
        .groupBy("pagename").agg(F.sum("curr_rate")).collect(),
        "catalog_refresh_nothing_new": lambda s: catalog.refresh(),
        "read_30_days_validate_ledger": lambda s: read_feed(s, f.main, fx.MAIN_FEED, validate=True, ledger=ledger)
        .groupBy("pagename").count().collect(),
        "decode_browsers_as_of": lambda s: decode_as_of(
            read_feed(s, f.main, fx.MAIN_FEED, with_delivery_date=True),
            read_lookup_history(s, f.main, fx.MAIN_FEED, "browser.tsv"), "browser", "name")
        .groupBy("delivery_date").agg(F.count("name")).collect(),
        "schema_drift": lambda s: reports.schema_drift(s, f.broken, fx.BROKEN_FEED).collect(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("webfeed-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    t0 = time.perf_counter()
    fixtures = fx.build(spark, sf_dir).build_all()
    many = _many(spark, sf_dir)
    build_sec = time.perf_counter() - t0

    qs = _queries(spark, fixtures, many)
    for run in qs.values():  # warm-up: JIT, Python workers, file-system caches
        run(spark)
    times: dict[str, float] = {}
    for name, run in qs.items():
        samples = []
        for _ in range(repeats):
            t = time.perf_counter()
            run(spark)
            samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 4)

    def control(s):
        return s.range(0, 20_000_000, numPartitions=cpus).selectExpr("sum(id % 7) AS s", "count(*) AS n").collect()

    control(spark)
    samples = []
    for _ in range(repeats):
        t = time.perf_counter()
        control(spark)
        samples.append(time.perf_counter() - t)
    control_sec = round(statistics.median(samples), 4)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "feed_queries_total_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "fixture_build_sec": round(build_sec, 3),
        "control_sec": control_sec,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
