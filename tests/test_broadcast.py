from helpers import row, write_delivery
from webfeed import read_feed
from webfeed.operators import reports
from webfeed.plans import broadcast


def _hinted(df):
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_hint_only_under_both_limits(spark):
    df = spark.range(3)
    assert _hinted(broadcast.bounded_broadcast(df, 3, broadcast.row_bytes(["a"])))
    assert not _hinted(broadcast.bounded_broadcast(df, 3, broadcast.MAX_BROADCAST_BYTES))
    assert not _hinted(broadcast.bounded_broadcast(df, broadcast.MAX_BROADCAST_ROWS + 1, 1))


def test_row_bytes_counts_utf8_of_longest_value():
    assert broadcast.row_bytes(["é"]) - broadcast.row_bytes(["e"]) == 1
    assert broadcast.row_bytes(["a", "abcd"]) == broadcast.row_bytes(["abcd"])


def test_shuffled_joins_give_the_same_results(spark, workdir, monkeypatch):
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(6)], files=3)
    write_delivery(workdir, "f", "2024-01-02", [row(9)])

    def run():
        hits = read_feed(spark, workdir, "f", with_delivery_date=True)
        report = reports.feed_validation(spark, workdir, "f")
        plans = hits._jdf.queryExecution().executedPlan().toString() + \
            report._jdf.queryExecution().executedPlan().toString()
        return (sorted((r.hitid_low, r.delivery_date) for r in hits.collect()),
                sorted(tuple(r) for r in report.collect()), plans)

    hits, report, plans = run()
    assert "BroadcastHashJoin" in plans
    monkeypatch.setattr(broadcast, "MAX_BROADCAST_BYTES", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits2, report2, plans2 = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in plans2
    assert (hits2, report2) == (hits, report)
    assert len(hits) == 7 and all(r[-1] for r in report)
