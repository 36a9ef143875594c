"""Driver contract: every query matches its DuckDB oracle (at sf0.001 here)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracles import rows_of, type_differences


def test_keys_match():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pagename", "hits"] and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, 'events.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, feeds, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E._oracles()[name])
    onames = rel.columns
    assert sorted(df.columns) == sorted(onames)
    assert type_differences(df.schema, onames, rel.types) == {}
    assert rows_of(df.columns, df.collect()) == rows_of(onames, rel.fetchall())


SPLIT_QUERIES = ["feed_all_available", "feed_multi_file", "feed_validated_daily_pages", "manifest_catalog",
                 "manifest_files", "validate_md5", "validate_row_counts", "validate_file_counts", "delivery_gaps"]


def test_days_split_into_bounded_files(spark, duck, monkeypatch):
    """With at most 10 rows per data file every day spans several files, and the
    queries still match oracles written for that file size."""
    from pyspark.sql import functions as F

    from webfeed.operators import reports
    from webfeed.testing import feedwriter
    from webfeed.testing import fixtures as fx

    monkeypatch.setattr(feedwriter, "ROWS_PER_FILE", 10)
    split = fx.Fixtures(spark, SF_SMALL)
    monkeypatch.setattr(E, "_fixtures", lambda _spark, _sf: split)
    files = reports.manifest_catalog(spark, split.main, fx.MAIN_FEED).select(F.inline("data_files"))
    assert files.agg(F.max("record_count")).first()[0] <= 10
    assert files.count() > 30
    oracles = E._oracles(10)
    for name in SPLIT_QUERIES:
        df = E.queries()[name](spark, SF_SMALL)
        res = duck.execute(oracles[name])
        onames = [d[0] for d in res.description]
        assert rows_of(df.columns, df.collect()) == rows_of(onames, res.fetchall()), name


@pytest.mark.parametrize("name", ["feed_single_date", "feed_validated_daily_pages", "feed_delivery_date"])
def test_results_do_not_depend_on_the_session_time_zone(spark, feeds, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        got = rows_of(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(E._oracles()[name])
    assert got == rows_of(rel.columns, rel.fetchall())
