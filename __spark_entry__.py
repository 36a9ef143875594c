"""

Every query first writes test deliveries derived from ``<sf_dir>/events.parquet``
(once per process and data folder; see ``webfeed.testing.fixtures``), reads them
back with the feed operators, and returns what the matching DuckDB SQL computes
straight from ``events``. Deliveries are days of ``CAST(ts AS DATE)``.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webfeed import FeedReader, read_feed, read_lookup, selection  # noqa: E402
from webfeed.operators import reports  # noqa: E402
from webfeed.operators.decode import decode_as_of  # noqa: E402
from webfeed.operators.validate import validation_report  # noqa: E402
from webfeed.session import HadoopFS, new_scratch_path  # noqa: E402
from webfeed.sources.catalog import Catalog  # noqa: E402
from webfeed.sources.lookup import read_lookup_history  # noqa: E402
from webfeed.paths import quoted  # noqa: E402
from webfeed.streaming.ingest import ingest_deliveries, reingest_deliveries  # noqa: E402
from webfeed.testing import fixtures as fx  # noqa: E402
from webfeed.testing.feedwriter import BROWSER_IDS, ROWS_PER_FILE  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _hits(df: DataFrame) -> DataFrame:
    """Hit rows with ``date_time`` as wall-clock time (independent of the session zone)."""
    return df.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


def _fixtures(spark: SparkSession, sf_dir: str) -> fx.Fixtures:
    return fx.build(spark, sf_dir)


# --- hit-table reads ---------------------------------------------------------

def feed_single_date(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, date="2024-01-05"))


def feed_date_set(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED,
                           dates="2024-01-02,2024-01-09,2024-01-23"))


def feed_date_range(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED,
                           start="2024-01-10", end="2024-01-20"))


def feed_all_available(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED))


def feed_multi_file(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).multi, fx.MULTI_FEED))


def feed_reordered_columns(spark, sf_dir):
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).reorder, fx.REORDER_FEED))


def feed_validated_daily_pages(spark, sf_dir):
    hits = read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, validate=True)
    return (hits.groupBy(F.to_date("date_time").alias("day"), "pagename")
            .agg(F.count(F.lit(1)).alias("hits"), F.round(F.sum("curr_rate"), 2).alias("revenue")))


def feed_option_reader(spark, sf_dir):
    hits = (FeedReader(spark).option("dir", _fixtures(spark, sf_dir).main).option("feedname", fx.MAIN_FEED)
            .option("from", "2024-01-25").option("to", "2024-01-30").load())
    return hits.groupBy(F.to_date("date_time").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct("visid_low").alias("visitors"))


def feed_delivery_date(spark, sf_dir):
    hits = read_feed(spark, _fixtures(spark, sf_dir).multi, fx.MULTI_FEED, with_delivery_date=True)
    return hits.select("hitid_low", "delivery_date")


def feed_id_overrides(spark, sf_dir):
    hits = read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED,
                     column_types={"hitid_low": T.StringType(), "visid_low": T.StringType()})
    return hits.select("hitid_low", "visid_low", "browser")


def stream_ingest(spark, sf_dir):
    """New deliveries -> partitioned Parquet by a file stream over manifests (validated)."""
    target = new_scratch_path(spark, "ingest-hits")
    ingest_deliveries(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, target,
                      checkpoint=new_scratch_path(spark, "ingest-checkpoint"), validate=True).awaitTermination()
    return _hits(spark.read.parquet(target))


def feed_subfolders(spark, sf_dir):
    """Equal base names in a folder per day, with alternating column order."""
    return _hits(read_feed(spark, _fixtures(spark, sf_dir).subfolders, fx.SUBFOLDERS_FEED, validate=True,
                           with_delivery_date=True))


def feed_column_names(spark, sf_dir):
    """Header names with a dot and a backtick."""
    hits = _hits(read_feed(spark, _fixtures(spark, sf_dir).names, fx.NAMES_FEED))
    return hits.withColumnsRenamed({"page.name": "page_name", "user`id": "user_id"})


def reingested_day(spark, sf_dir):
    """Ingested with a wrong first day, which is delivered again and ingested by an explicit call."""
    f = _fixtures(spark, sf_dir)
    target = new_scratch_path(spark, "reingest-hits")
    ingest_deliveries(spark, f.main, fx.MAIN_FEED, target, checkpoint=new_scratch_path(spark, "reingest-checkpoint"),
                      column_types={"visid_low": T.LongType()}).awaitTermination()
    days = spark.read.parquet(target).select(F.min("delivery_date")).first()
    # the day's partition as an earlier, incomplete delivery left it
    part = read_feed(spark, f.main, fx.MAIN_FEED, date=days[0], with_delivery_date=True).where("hitid_low % 2 = 0")
    (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery_date")
     .parquet(target))
    reingest_deliveries(spark, f.main, fx.MAIN_FEED, target, dates=[days[0]], validate=True)
    return _hits(spark.read.parquet(target))


def redelivered_day(spark, sf_dir):
    """A day's partition as an earlier delivery left it; its manifest comes again, and the ingestion, started anew, sees it."""
    f = _fixtures(spark, sf_dir)
    target, checkpoint = new_scratch_path(spark, "redeliver-hits"), new_scratch_path(spark, "redeliver-checkpoint")
    ingest_deliveries(spark, f.names, fx.NAMES_FEED, target, checkpoint=checkpoint).awaitTermination()
    day = spark.read.parquet(target).select(F.max("delivery_date")).first()[0]
    part = read_feed(spark, f.names, fx.NAMES_FEED, date=day, with_delivery_date=True).where("hitid_low % 2 = 0")
    (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery_date")
     .parquet(target))
    manifest = f"{f.names}/{fx.NAMES_FEED}_{day}.txt"
    text = spark.read.text(manifest, wholetext=True).first()[0]
    HadoopFS(spark).write_bytes(manifest, (text + "\n").encode())  # one byte longer, at another time
    ingest_deliveries(spark, f.names, fx.NAMES_FEED, target, checkpoint=checkpoint, validate=True).awaitTermination()
    return _hits(spark.read.parquet(target)).withColumnsRenamed({"page.name": "page_name", "user`id": "user_id"})


def _catalog(spark, sf_dir) -> Catalog:
    """The main feed's catalogue, taken in by several increments."""
    c = Catalog(spark, new_scratch_path(spark, "catalog"), _fixtures(spark, sf_dir).main, fx.MAIN_FEED)
    c.refresh(at_once=12)
    c.refresh()
    return c


def catalog_all_available(spark, sf_dir):
    return _hits(_catalog(spark, sf_dir).read(direct=0, with_delivery_date=True))


def catalog_reordered(spark, sf_dir):
    """Two column orders, by a catalogue whose refresh validates with a ledger."""
    c = Catalog(spark, new_scratch_path(spark, "catalog"), _fixtures(spark, sf_dir).reorder, fx.REORDER_FEED)
    c.refresh(validate=True, ledger=new_scratch_path(spark, "ledger"))
    return _hits(c.read(direct=0))


def catalog_files(spark, sf_dir):
    files = _catalog(spark, sf_dir).files()
    return files.select("delivery_date", F.col("file_key").alias("file_name"), F.col("expected_records").alias("records"),
                        (F.col("length") == F.col("expected_size")).alias("size_ok"), "n_columns")


def validate_ledger(spark, sf_dir):
    """The second of two validations: files that have not changed come from the ledger."""
    f, ledger = _fixtures(spark, sf_dir), new_scratch_path(spark, "ledger")
    validation_report(spark, f.broken, fx.BROKEN_FEED, ledger=ledger)
    r = validation_report(spark, f.broken, fx.BROKEN_FEED, ledger=ledger)
    return r.select("delivery_date", "kind", "file_name", "file_exists", "size_ok", "md5_ok", "records_ok")


def lost_cells(spark, sf_dir):
    """Every cell that its column's type cannot hold: decimal commas from day 21 on."""
    return reports.lost_cells(spark, _fixtures(spark, sf_dir).locale, fx.LOCALE_FEED)


def column_profile(spark, sf_dir):
    return reports.column_profile(spark, _fixtures(spark, sf_dir).locale, fx.LOCALE_FEED)


def type_losses_lossless(spark, sf_dir):
    """Type losses of the feed with a decimal comma, read with the types of its profile: none."""
    f = _fixtures(spark, sf_dir)
    types = reports.lossless_types(reports.column_profile(spark, f.locale, fx.LOCALE_FEED))
    return reports.type_losses(spark, f.locale, fx.LOCALE_FEED, column_types=types)


def lookup_history(spark, sf_dir):
    """Browsers (values change every day) and events (values never change) over all deliveries."""
    f = _fixtures(spark, sf_dir)
    parts = [read_lookup_history(spark, f.main, fx.MAIN_FEED, name).intervals
             .select(F.lit(name).alias("lookup"), "lookup_key", "lookup_value", "valid_from", "valid_until")
             for name in ("browser.tsv", "event.tsv")]
    return parts[0].union(parts[1])


def decode_browsers_as_of(spark, sf_dir):
    """All hits; browsers by the last of three deliveries at the time."""
    f = _fixtures(spark, sf_dir)
    history = read_lookup_history(spark, f.main, fx.MAIN_FEED, "browser.tsv", dates="2024-01-03,2024-01-10,2024-01-20")
    hits = read_feed(spark, f.main, fx.MAIN_FEED, with_delivery_date=True)
    return decode_as_of(hits, history, "browser", "browser_name").select("hitid_low", "delivery_date", "browser_name")


def decode_events_as_of(spark, sf_dir):
    """All hits; events by the delivery of their own day (a few hot keys)."""
    f = _fixtures(spark, sf_dir)
    history = read_lookup_history(spark, f.main, fx.MAIN_FEED, "event.tsv")
    hits = read_feed(spark, f.main, fx.MAIN_FEED, with_delivery_date=True)
    return decode_as_of(hits, history, "event_list", "event_name").groupBy("delivery_date", "event_name") \
        .agg(F.count(F.lit(1)).alias("hits"))


def pages_one_day(spark, sf_dir):
    """Hits per page of every one day."""
    hits = read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, with_delivery_date=True)
    return hits.groupBy("delivery_date", "pagename").agg(F.count(F.lit(1)).alias("hits"))


def header_schema(spark, sf_dir):
    hits = read_feed(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED)
    fields = hits.schema.fields
    counts = hits.agg(*[F.count(F.col(quoted(f.name))).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"n{i}").alias("non_null")) for i, f in enumerate(fields)])
    return counts.select(F.inline(rows))


# --- lookups -----------------------------------------------------------------

def lookup_event(spark, sf_dir):
    return read_lookup(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, "event.tsv")


def lookup_most_recent(spark, sf_dir):
    return read_lookup(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, "browser.tsv",
                       start="2024-01-03", end="2024-01-17")


def lookup_validated(spark, sf_dir):
    return read_lookup(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED, "event.tsv",
                       validate=True)


def lookup_option_reader(spark, sf_dir):
    return (FeedReader(spark).options(dir=_fixtures(spark, sf_dir).main, feedname=fx.MAIN_FEED, date="2024-01-09")
            .load("browser.tsv"))


# --- manifests and checks ----------------------------------------------------

def manifest_catalog(spark, sf_dir):
    m = reports.manifest_catalog(spark, _fixtures(spark, sf_dir).main, fx.MAIN_FEED)
    return m.select("delivery_date", "version", "n_lookup_files", "n_data_files", "total_records",
                    F.size("problems").alias("n_problems"))


def manifest_files(spark, sf_dir):
    m = reports.manifest_catalog(spark, _fixtures(spark, sf_dir).multi, fx.MULTI_FEED)
    return m.select("delivery_date", F.inline("data_files")) \
        .select("delivery_date", F.col("name").alias("file_name"), "record_count")


def validate_md5(spark, sf_dir):
    r = reports.feed_validation(spark, _fixtures(spark, sf_dir).broken, fx.BROKEN_FEED)
    return r.select("delivery_date", "kind", "file_name", "file_exists", "size_ok", "md5_ok")


def validate_row_counts(spark, sf_dir):
    return reports.delivery_records(spark, _fixtures(spark, sf_dir).broken, fx.BROKEN_FEED)


def validate_file_counts(spark, sf_dir):
    m = reports.manifest_catalog(spark, _fixtures(spark, sf_dir).broken, fx.BROKEN_FEED)
    return m.select("delivery_date", "n_lookup_files", F.size("lookup_files").alias("lookup_files_listed"),
                    "n_data_files", F.size("data_files").alias("data_files_listed"),
                    (F.size("problems") == 0).alias("counts_ok"))


def delivery_gaps(spark, sf_dir):
    return reports.delivery_gaps(spark, _fixtures(spark, sf_dir).gaps, fx.GAPS_FEED,
                                 start="2024-01-01", end="2024-01-31")


def _drift(df: DataFrame) -> DataFrame:
    return df.select("delivery_date", "header_found", "n_columns",
                     *[F.concat_ws(",", c).alias(c) for c in
                       ("missing_columns", "extra_columns", "duplicated_columns")], "reordered",
                     F.regexp_replace("problem", ": .*", "").alias("problem"))


def schema_drift(spark, sf_dir):
    return _drift(reports.schema_drift(spark, _fixtures(spark, sf_dir).broken, fx.BROKEN_FEED))


def schema_reordered(spark, sf_dir):
    return _drift(reports.schema_drift(spark, _fixtures(spark, sf_dir).reorder, fx.REORDER_FEED,
                                       selection()))


def type_losses(spark, sf_dir):
    return reports.type_losses(spark, _fixtures(spark, sf_dir).locale, fx.LOCALE_FEED)


def type_losses_names(spark, sf_dir):
    """Typed columns whose names hold a dot and a backtick."""
    return reports.type_losses(spark, _fixtures(spark, sf_dir).names, fx.NAMES_FEED,
                               column_types={"page.name": T.LongType(), "user`id": T.LongType()}) \
        .where(F.col("column_name").isin("page.name", "user`id"))


def lookup_older_two_archives(spark, sf_dir):
    """An older delivery that lists two archives does not matter to a lookup of the newest."""
    return read_lookup(spark, _fixtures(spark, sf_dir).broken, fx.BROKEN_FEED, "browser.tsv",
                       start="2024-01-13", end="2024-01-18")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_single_date": feed_single_date,
    "feed_date_set": feed_date_set,
    "feed_date_range": feed_date_range,
    "feed_all_available": feed_all_available,
    "feed_multi_file": feed_multi_file,
    "feed_reordered_columns": feed_reordered_columns,
    "feed_validated_daily_pages": feed_validated_daily_pages,
    "feed_option_reader": feed_option_reader,
    "feed_delivery_date": feed_delivery_date,
    "feed_id_overrides": feed_id_overrides,
    "stream_ingest": stream_ingest,
    "feed_subfolders": feed_subfolders,
    "feed_column_names": feed_column_names,
    "reingested_day": reingested_day,
    "pages_one_day": pages_one_day,
    "type_losses_names": type_losses_names,
    "lookup_older_two_archives": lookup_older_two_archives,
    "header_schema": header_schema,
    "lookup_event": lookup_event,
    "lookup_most_recent": lookup_most_recent,
    "lookup_validated": lookup_validated,
    "lookup_option_reader": lookup_option_reader,
    "manifest_catalog": manifest_catalog,
    "manifest_files": manifest_files,
    "validate_md5": validate_md5,
    "validate_row_counts": validate_row_counts,
    "validate_file_counts": validate_file_counts,
    "delivery_gaps": delivery_gaps,
    "schema_drift": schema_drift,
    "schema_reordered": schema_reordered,
    "type_losses": type_losses,
    "redelivered_day": redelivered_day,
    "catalog_all_available": catalog_all_available,
    "catalog_reordered": catalog_reordered,
    "catalog_files": catalog_files,
    "validate_ledger": validate_ledger,
    "lost_cells": lost_cells,
    "column_profile": column_profile,
    "type_losses_lossless": type_losses_lossless,
    "lookup_history": lookup_history,
    "decode_browsers_as_of": decode_browsers_as_of,
    "decode_events_as_of": decode_events_as_of,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hits per page of the 2024-01-05 delivery (sf0.001 test feed)."""
    hits = read_feed(spark, _fixtures(spark, SMOKE_DIR).main, fx.MAIN_FEED, date="2024-01-05")
    return hits.groupBy("pagename").agg(F.count(F.lit(1)).alias("hits"))


def _llm() -> tuple[dict, dict]:
    """Queries and oracles of ``webfeed.llm`` and the corpus pipeline; none where those are not installed."""
    try:
        registry = importlib.import_module("webfeed.llm.registry")
    except ModuleNotFoundError as e:
        if e.name not in ("webfeed.llm", "webfeed.llm.registry"):
            raise
        return {}, {}
    found, oracles = dict(registry.QUERIES), dict(registry.ORACLES)
    try:
        pipeline = importlib.import_module("corpus_pipeline")
    except ModuleNotFoundError as e:
        if e.name != "corpus_pipeline":
            raise
    else:
        found["pipeline"] = pipeline.run
        if pipeline.ORACLE_SQL:
            oracles["pipeline"] = pipeline.ORACLE_SQL
    return found, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _llm()[0]


# --- oracles -----------------------------------------------------------------

_D = "CAST(ts AS DATE)"
_HIT_COLUMNS = f"""
    CAST(0 AS BIGINT) AS hitid_high, event_id AS hitid_low, ts AS date_time,
    CAST(floor(epoch(ts)) AS BIGINT) AS hit_time_gmt, user_id AS visid_low, user_id % {BROWSER_IDS} AS browser,
    substr(md5(event_type), 1, 8) AS event_list, event_type AS pagename, props AS post_evar1,
    CAST(event_id % 2 AS INTEGER) AS daily_visitor, 'x' AS custom_unknown, 'y' AS my_col__a_b_,
    value AS curr_rate"""
_DAYS = f"SELECT DISTINCT {_D} AS d FROM events"


def _n_files(rows: str, min_files: int, per_file: int) -> str:
    """Data files of a day with ``rows`` rows (the writer splits big days)."""
    return f"CAST(GREATEST({min_files}, CEIL({rows} / {per_file})) AS INTEGER)"


def _broken_day_files(per_file: int) -> str:
    """Days of the broken feed with a delivery, their rows and data files."""
    return (f"SELECT {_D} AS d, count(*) AS n, {_n_files('count(*)', 1, per_file)} AS n_files "
            f"FROM events GROUP BY 1")


_HEADER = [("hitid_high", "bigint", "count(*)"), ("hitid_low", "bigint", "count(event_id)"),
           ("date_time", "timestamp", "count(ts)"), ("hit_time_gmt", "bigint", "count(ts)"),
           ("visid_low", "bigint", "count(user_id)"), ("browser", "bigint", "count(user_id)"),
           ("event_list", "string", "count(event_type)"), ("pagename", "string", "count(event_type)"),
           ("post_evar1", "string", "count(props)"), ("daily_visitor", "int", "count(event_id)"),
           ("custom_unknown", "string", "count(*)"), ("my_col__a_b_", "string", "count(*)"),
           ("curr_rate", "double", "count(value)")]


def _browser_sql(day: str) -> str:
    """Browser lookup of the delivery of ``day``."""
    return (f"SELECT DISTINCT CAST(user_id % {BROWSER_IDS} AS VARCHAR) AS lookup_key, "
            f"'browser-' || CAST(user_id % {BROWSER_IDS} AS VARCHAR) || ' {day}' AS lookup_value "
            f"FROM events WHERE {_D} = DATE '{day}'")


_EVENT_LOOKUP = ("SELECT DISTINCT substr(md5(event_type), 1, 8) AS lookup_key, event_type AS lookup_value "
                 "FROM events")


def _type_losses_sql() -> str:
    typed = [(n, t, agg) for n, t, agg in _HEADER if t != "string"]
    parts = [f"SELECT '{n}' AS column_name, '{t}' AS data_type, {agg} AS \"values\", "
             + (f"count(*) FILTER (WHERE day({_D}) >= 21)" if n == "curr_rate" else "CAST(0 AS BIGINT)")
             + " AS lost FROM events" for n, t, agg in typed]
    return "\nUNION ALL\n".join(parts)


def _file_sql(feed: str, per_file: int, n: str = "n") -> str:
    """Name of the data file that holds an event of a day with ``n`` events."""
    return (f"printf('%02d-{feed}_%s.tsv.gz', event_id % {_n_files(n, 1, per_file)} + 1, "
            f"strftime({_D}, '%Y-%m-%d'))")


# The narrowest type that holds an integer column.
_INT = ("CASE WHEN min({0}) >= -2147483648 AND max({0}) <= 2147483647 THEN 'int' ELSE 'bigint' END")
_COMMA = f"count(*) FILTER (WHERE value IS NOT NULL AND day({_D}) >= {fx.COMMA_DECIMAL_FROM}) > 0"
_LOSSLESS = {"hitid_high": "'int'", "hitid_low": _INT.format("event_id"), "date_time": "'timestamp'",
             "hit_time_gmt": _INT.format("CAST(floor(epoch(ts)) AS BIGINT)"), "visid_low": _INT.format("user_id"),
             "browser": _INT.format(f"(user_id % {BROWSER_IDS})"), "daily_visitor": "'int'",
             "curr_rate": f"CASE WHEN {_COMMA} THEN 'string' ELSE 'double' END"}


def _profile_sql() -> str:
    parts = [f"SELECT {i + 1} AS position, '{n}' AS column_name, '{t}' AS data_type, {agg} AS \"values\", "
             f"{_LOSSLESS.get(n, chr(39) + 'string' + chr(39))} AS lossless_type FROM events"
             for i, (n, t, agg) in enumerate(_HEADER)]
    return "\nUNION ALL\n".join(parts)


def _header_sql() -> str:
    parts = [f"SELECT {i + 1} AS position, '{n}' AS column_name, '{t}' AS data_type, {agg} AS non_null "
             f"FROM events" for i, (n, t, agg) in enumerate(_HEADER)]
    return "\nUNION ALL\n".join(parts)


def _oracles(per_file: int = ROWS_PER_FILE) -> dict[str, str]:
    """Oracle SQL for test deliveries written with at most ``per_file`` rows per data file."""
    return {
        "feed_single_date": f"SELECT {_HIT_COLUMNS} FROM events WHERE {_D} = DATE '2024-01-05'",
        "feed_date_set": f"SELECT {_HIT_COLUMNS} FROM events "
                         f"WHERE {_D} IN (DATE '2024-01-02', DATE '2024-01-09', DATE '2024-01-23')",
        "feed_date_range": f"SELECT {_HIT_COLUMNS} FROM events "
                           f"WHERE {_D} BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
        "feed_all_available": f"SELECT {_HIT_COLUMNS} FROM events",
        "feed_multi_file": f"SELECT {_HIT_COLUMNS} FROM events",
        "feed_reordered_columns": f"SELECT {_HIT_COLUMNS} FROM events",
        "feed_validated_daily_pages": f"SELECT {_D} AS day, event_type AS pagename, count(*) AS hits, "
                                      f"round(sum(value), 2) AS revenue FROM events GROUP BY 1, 2",
        "feed_option_reader": f"SELECT {_D} AS day, count(*) AS hits, count(DISTINCT user_id) AS visitors "
                              f"FROM events WHERE {_D} BETWEEN DATE '2024-01-25' AND DATE '2024-01-30' GROUP BY 1",
        "feed_delivery_date": f"SELECT event_id AS hitid_low, {_D} AS delivery_date FROM events",
        "feed_id_overrides": f"SELECT CAST(event_id AS VARCHAR) AS hitid_low, CAST(user_id AS VARCHAR) AS visid_low, "
                             f"user_id % {BROWSER_IDS} AS browser FROM events",
        "stream_ingest": f"SELECT {_HIT_COLUMNS}, {_D} AS delivery_date FROM events",
        "pages_one_day": f"SELECT {_D} AS delivery_date, event_type AS pagename, count(*) AS hits FROM events "
                         f"GROUP BY 1, 2",
        "feed_subfolders": f"SELECT {_HIT_COLUMNS}, {_D} AS delivery_date FROM events",
        "feed_column_names": f"SELECT {_HIT_COLUMNS}, event_type AS page_name, CAST(user_id AS VARCHAR) AS user_id "
                             f"FROM events",
        "reingested_day": f"SELECT {_HIT_COLUMNS}, {_D} AS delivery_date FROM events",
        "type_losses_names": """
            SELECT 'page.name' AS column_name, 'bigint' AS data_type, count(event_type) AS "values",
                   count(event_type) FILTER (WHERE TRY_CAST(event_type AS BIGINT) IS NULL) AS lost FROM events
            UNION ALL SELECT 'user`id', 'bigint', count(user_id), 0 FROM events""",
        "lookup_older_two_archives": _browser_sql("2024-01-18"),
        "header_schema": _header_sql(),
        "type_losses": _type_losses_sql(),
        "redelivered_day": f"SELECT {_HIT_COLUMNS}, event_type AS page_name, CAST(user_id AS VARCHAR) AS user_id, "
                           f"{_D} AS delivery_date FROM events",
        "catalog_all_available": f"SELECT {_HIT_COLUMNS}, {_D} AS delivery_date FROM events",
        "catalog_reordered": f"SELECT {_HIT_COLUMNS} FROM events",
        "catalog_files": f"""
            SELECT {_D} AS delivery_date, {_file_sql(fx.MAIN_FEED, per_file)} AS file_name, count(*) AS records,
                   true AS size_ok, 13 AS n_columns
            FROM (SELECT *, count(*) OVER (PARTITION BY {_D}) AS n FROM events) GROUP BY 1, 2""",
        "lost_cells": f"""
            SELECT * EXCLUDE (day) FROM (
                SELECT {_D} AS delivery_date, {_file_sql(fx.LOCALE_FEED, per_file)} AS file_name,
                       row_number() OVER (PARTITION BY {_D}, event_id % {_n_files('n', 1, per_file)} ORDER BY event_id)
                           AS record,
                       'curr_rate' AS column_name, 'double' AS data_type,
                       replace(CAST(value AS VARCHAR), '.', ',') AS value, day({_D}) AS day
                FROM (SELECT *, count(*) OVER (PARTITION BY {_D}) AS n FROM events))
            WHERE day >= {fx.COMMA_DECIMAL_FROM} AND value IS NOT NULL""",
        "column_profile": _profile_sql(),
        "type_losses_lossless": f"""
            SELECT column_name, lossless_type AS data_type, "values", CAST(0 AS BIGINT) AS lost
            FROM ({_profile_sql()}) WHERE lossless_type <> 'string'""",
        "lookup_history": f"""
            WITH d AS ({_DAYS}), n AS (SELECT d, lead(d) OVER (ORDER BY d) AS nxt FROM d),
            l AS (SELECT DISTINCT {_D} AS d, CAST(user_id % {BROWSER_IDS} AS VARCHAR) AS k FROM events)
            SELECT 'browser.tsv' AS lookup, k AS lookup_key, 'browser-' || k || ' ' || strftime(d, '%Y-%m-%d') AS lookup_value,
                   d AS valid_from, nxt AS valid_until FROM l JOIN n USING (d)
            UNION ALL
            SELECT 'event.tsv', lookup_key, lookup_value, (SELECT min(d) FROM d), NULL::DATE FROM ({_EVENT_LOOKUP})""",
        "decode_browsers_as_of": f"""
            WITH a AS (SELECT *, CASE WHEN {_D} >= DATE '2024-01-20' THEN DATE '2024-01-20'
                                      WHEN {_D} >= DATE '2024-01-10' THEN DATE '2024-01-10'
                                      WHEN {_D} >= DATE '2024-01-03' THEN DATE '2024-01-03' END AS of
                       FROM events),
            l AS (SELECT DISTINCT {_D} AS d, user_id % {BROWSER_IDS} AS k FROM events)
            SELECT event_id AS hitid_low, {_D} AS delivery_date,
                   CASE WHEN l.k IS NOT NULL THEN 'browser-' || CAST(l.k AS VARCHAR) || ' ' || strftime(of, '%Y-%m-%d') END
                       AS browser_name
            FROM a LEFT JOIN l ON l.d = a.of AND l.k = a.user_id % {BROWSER_IDS}""",
        "decode_events_as_of": f"SELECT {_D} AS delivery_date, event_type AS event_name, count(*) AS hits FROM events "
                               f"GROUP BY 1, 2",
        "lookup_event": _EVENT_LOOKUP,
        "lookup_most_recent": _browser_sql("2024-01-17"),
        "lookup_validated": _EVENT_LOOKUP,
        "lookup_option_reader": _browser_sql("2024-01-09"),
        "manifest_catalog": f"SELECT {_D} AS delivery_date, '1.0' AS version, 1 AS n_lookup_files, "
                            f"{_n_files('count(*)', 1, per_file)} AS n_data_files, count(*) AS total_records, "
                            f"0 AS n_problems FROM events GROUP BY 1",
        "manifest_files": f"""
            SELECT d AS delivery_date,
                   printf('%02d-multi_%s.tsv.gz', event_id % {_n_files('n', fx.MULTI_FILES_PER_DAY, per_file)} + 1,
                          strftime(d, '%Y-%m-%d')) AS file_name,
                   count(*) AS record_count
            FROM (SELECT {_D} AS d, event_id, count(*) OVER (PARTITION BY {_D}) AS n FROM events)
            GROUP BY 1, 2""",
        "validate_md5": f"""
            SELECT d AS delivery_date, 'data' AS kind,
                   printf('%02d-broken_%s.tsv.gz', f, strftime(d, '%Y-%m-%d')) AS file_name,
                   day(d) <> 14 AS file_exists,
                   day(d) <> 14 AND NOT (day(d) = 8 AND f = 1) AS size_ok,
                   day(d) <> 14 AND NOT (day(d) = 7 AND f = 1) AS md5_ok
            FROM (SELECT d, unnest(range(1, n_files + 1)) AS f FROM ({_broken_day_files(per_file)}))
            UNION ALL
            SELECT d, 'lookup', 'broken_' || strftime(d, '%Y-%m-%d') || '-lookup_data.tar.gz',
                   day(d) <> 21, day(d) <> 21, day(d) NOT IN (18, 21)
            FROM ({_DAYS}) WHERE day(d) <> 19
            UNION ALL
            SELECT d, 'lookup', 'broken_' || strftime(d, '%Y-%m-%d') || '-lookup_data-2.tar.gz', true, true, true
            FROM ({_DAYS}) WHERE day(d) = 15""",
        "validate_ledger": f"""
            SELECT d AS delivery_date, 'data' AS kind,
                   printf('%02d-broken_%s.tsv.gz', f, strftime(d, '%Y-%m-%d')) AS file_name,
                   day(d) <> 14 AS file_exists,
                   day(d) <> 14 AND NOT (day(d) = 8 AND f = 1) AS size_ok,
                   day(d) <> 14 AND NOT (day(d) = 7 AND f = 1) AS md5_ok,
                   day(d) <> 14 AND NOT (day(d) = 9 AND f = 1) AS records_ok
            FROM (SELECT d, unnest(range(1, n_files + 1)) AS f FROM ({_broken_day_files(per_file)}))
            UNION ALL
            SELECT d, 'lookup', 'broken_' || strftime(d, '%Y-%m-%d') || '-lookup_data.tar.gz',
                   day(d) <> 21, day(d) <> 21, day(d) NOT IN (18, 21), NULL::BOOLEAN
            FROM ({_DAYS}) WHERE day(d) <> 19
            UNION ALL
            SELECT d, 'lookup', 'broken_' || strftime(d, '%Y-%m-%d') || '-lookup_data-2.tar.gz', true, true, true, NULL
            FROM ({_DAYS}) WHERE day(d) = 15""",
        "validate_row_counts": f"""
            SELECT d AS delivery_date,
                   n + CASE WHEN day(d) = 11 THEN 1 ELSE 0 END AS total_records,
                   n + CASE WHEN day(d) = 9 THEN 1 ELSE 0 END AS listed_records,
                   CASE WHEN day(d) = 14 THEN 0 ELSE n END AS actual_records,
                   day(d) NOT IN (9, 11, 14) AS ok
            FROM (SELECT {_D} AS d, count(*) AS n FROM events GROUP BY 1)""",
        "validate_file_counts": f"""
            SELECT d AS delivery_date,
                   CASE day(d) WHEN 15 THEN 2 WHEN 19 THEN 0 ELSE 1 END AS n_lookup_files,
                   CASE day(d) WHEN 15 THEN 2 WHEN 19 THEN 0 ELSE 1 END AS lookup_files_listed,
                   n_files + CASE WHEN day(d) = 12 THEN 1 ELSE 0 END AS n_data_files,
                   n_files AS data_files_listed,
                   day(d) <> 12 AS counts_ok
            FROM ({_broken_day_files(per_file)})""",
        "delivery_gaps": f"""
            SELECT CAST(g AS DATE) AS missing_date
            FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) AS t(g)
            WHERE CAST(g AS DATE) NOT IN ({_DAYS} WHERE day({_D}) NOT IN (10, 20, 30))""",
        "schema_drift": f"""
            SELECT d AS delivery_date, day(d) IN (13, 17) AS header_found,
                   CASE WHEN day(d) IN (13, 17) THEN 14 END AS n_columns,
                   '' AS missing_columns,
                   CASE WHEN day(d) = 13 THEN 'extra_col' ELSE '' END AS extra_columns,
                   CASE WHEN day(d) = 17 THEN 'pagename' ELSE '' END AS duplicated_columns,
                   false AS reordered,
                   CASE day(d) WHEN 15 THEN 'manifest lists 2 lookup archives'
                               WHEN 16 THEN 'lookup archive has no column_headers.tsv'
                               WHEN 19 THEN 'manifest lists 0 lookup archives'
                               WHEN 21 THEN 'lookup archive is missing'
                               WHEN 22 THEN 'column_headers.tsv is empty'
                               WHEN 23 THEN 'lookup archive cannot be unpacked'
                               WHEN 24 THEN 'column_headers.tsv has more than one line' END AS problem
            FROM ({_DAYS}) WHERE day(d) IN (13, 15, 16, 17, 19, 21, 22, 23, 24)""",
        "schema_reordered": f"""
            SELECT DISTINCT {_D} AS delivery_date, true AS header_found, 13 AS n_columns,
                   '' AS missing_columns, '' AS extra_columns, '' AS duplicated_columns, true AS reordered,
                   NULL::VARCHAR AS problem
            FROM events WHERE day({_D}) % 2 = 0""",
    }


def oracle_sql() -> dict[str, str]:
    return _oracles() | _llm()[1]
