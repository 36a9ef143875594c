"""Lookup history and as-of decoding against plain Python."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import row, write_delivery
from webfeed.errors import FeedOptionError
from webfeed.operators.decode import decode_as_of
from webfeed.sources.lookup import LookupHistory, read_lookup_history

FIRST = date(2024, 1, 1)


def deliver(workdir, tables):
    for offset, table in tables.items():
        text = "".join(f"{k}\t{v}\n" for k, v in table)
        write_delivery(workdir, "f", (FIRST + timedelta(offset)).isoformat(), [row(1)], lookups={"browser.tsv": text})


def test_intervals(spark, workdir):
    deliver(workdir, {0: [("1", "a"), ("2", "x")], 1: [("1", "a"), ("2", "y")], 4: [("1", "a")], 5: [("1", "b"), ("2", "y")],
                      6: [("1", "a"), ("2", "old"), ("2", "y")]})
    h = read_lookup_history(spark, workdir, "f", "browser.tsv")
    got = sorted((r.lookup_key, r.valid_from.day, r.valid_until.day if r.valid_until else None, r.lookup_value, r.first, r.last)
                 for r in h.intervals.collect())
    assert got == [("1", 1, 6, "a", 0, 2), ("1", 6, 7, "b", 3, 3), ("1", 7, None, "a", 4, 4),
                   ("2", 1, 2, "x", 0, 0), ("2", 2, 5, "y", 1, 1), ("2", 6, None, "y", 3, 4)]
    assert [d.day for d in h.days] == [1, 2, 5, 6, 7]


@pytest.mark.parametrize("broadcast", [True, False])
def test_as_of_join(spark, workdir, broadcast):
    rng = random.Random(4)
    offsets = sorted(rng.sample(range(1, 40), 12))
    tables = {o: [(str(k), rng.choice("abc")) for k in range(8) if rng.random() < 0.8] for o in offsets}
    deliver(workdir, tables)
    history = read_lookup_history(spark, workdir, "f", "browser.tsv")
    # one key in a third of the rows, repeated rows, nulls, unknown keys, days before and after the history
    rows = [(i, 3 if i % 3 == 0 else rng.choice([*range(10), None]),
             rng.choice([*(FIRST + timedelta(o) for o in range(45)), None])) for i in range(600)] * 2

    def expected(key, day):
        known = [o for o in offsets if day is not None and FIRST + timedelta(o) <= day]
        return dict(tables[known[-1]]).get(str(key)) if known else None
    hits = spark.createDataFrame(rows, "id long, `a.key` int, delivery_date date")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = decode_as_of(hits, history, "a.key", "name")
        assert got.columns == ["id", "a.key", "delivery_date", "name"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted([(*r, expected(*r[1:])) for r in rows], key=repr)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_values_that_change_with_every_delivery_meet_few_intervals(spark):
    days = tuple(FIRST + timedelta(i) for i in range(200))
    rows = [("k", f"v{i}", d, None, i, i) for i, d in enumerate(days)]
    intervals = spark.createDataFrame(rows, "lookup_key string, lookup_value string, valid_from date, valid_until date, "
                                            "first int, last int")
    hits = spark.range(200).select(F.col("id"), F.lit("k").alias("key"), F.expr(f"date'{FIRST}' + cast(id as int)").alias("delivery_date"))
    got = decode_as_of(hits, LookupHistory(intervals, days), "key", "v")
    assert {r.id: r.v for r in got.collect()} == {i: f"v{i}" for i in range(200)}
    with pytest.raises(FeedOptionError, match="key"):
        decode_as_of(hits, LookupHistory(intervals, days), "key", "key")
