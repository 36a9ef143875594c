from helpers import row, write_delivery
from webfeed import read_feed
from webfeed.session import new_scratch_path
from webfeed.streaming.ingest import ingest_deliveries


def test_delivery_date_column(spark, workdir):  # E3
    write_delivery(workdir, "f", "2024-01-01", [row(1), row(2)], files=2)
    write_delivery(workdir, "f", "2024-01-02", [row(3)])
    got = sorted((r.hitid_low, r.delivery_date.day) for r in
                 read_feed(spark, workdir, "f", with_delivery_date=True).collect())
    assert got == [(1, 1), (2, 1), (3, 2)]


def test_ingest_new_deliveries(spark, workdir):  # E2
    target = new_scratch_path(spark, "ingest-target")
    chk = new_scratch_path(spark, "ingest-checkpoint")
    write_delivery(workdir, "f", "2024-01-01", [row(1), row(2)])
    write_delivery(workdir, "f", "2024-01-02", [row(3)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, validate=True).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    write_delivery(workdir, "f", "2024-01-03", [row(4), row(5)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk).awaitTermination()
    df = spark.read.parquet(target)
    assert sorted((r.hitid_low, r.delivery_date.day) for r in df.collect()) == \
        [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3)]


def test_ingest_stops_on_a_bad_delivery_and_resumes(spark, workdir):
    import pytest
    from pyspark.errors import StreamingQueryException

    target = new_scratch_path(spark, "ingest-target")
    chk = new_scratch_path(spark, "ingest-checkpoint")

    def wrong_total(m):
        m["total"] += 1
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(2)], manifest_edit=wrong_total)
    with pytest.raises(StreamingQueryException, match="Total-Records"):
        ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, validate=True).awaitTermination()
    write_delivery(workdir, "f", "2024-01-02", [row(2)])   # the vendor re-delivers the day
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, validate=True).awaitTermination()
    assert sorted((r.hitid_low, r.delivery_date.day) for r in spark.read.parquet(target).collect()) == [(1, 1), (2, 2)]


def test_columns_may_not_change_between_batches(spark, workdir):  # K4
    import pytest

    from helpers import HEADER

    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    write_delivery(workdir, "f", "2024-01-03", [row(3) + ["z"]], header=HEADER + ["more"])
    for size in (1, 7):
        target = new_scratch_path(spark, "ingest-target")
        q = ingest_deliveries(spark, workdir, "f", target, checkpoint=new_scratch_path(spark, "ingest-checkpoint"),
                              max_deliveries_per_batch=size)
        with pytest.raises(Exception, match="do not share the columns"):
            q.awaitTermination()


def test_a_day_delivered_again_is_ingested_by_an_explicit_call(spark, workdir):  # W5
    from webfeed.streaming.ingest import reingest_deliveries

    target, chk = new_scratch_path(spark, "ingest-target"), new_scratch_path(spark, "ingest-checkpoint")
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(2)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk).awaitTermination()
    write_delivery(workdir, "f", "2024-01-01", [row(1), row(9)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk).awaitTermination()
    reingest_deliveries(spark, workdir, "f", target, dates=["2024-01-01"], validate=True)
    assert sorted(r.hitid_low for r in spark.read.parquet(target).collect()) == [1, 2, 9]


def test_a_day_delivered_again_is_seen(spark, workdir):  # E2
    import os

    target, chk = new_scratch_path(spark, "ingest-target"), new_scratch_path(spark, "ingest-checkpoint")
    for d in (1, 2, 3):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])

    def ingest(**kw):
        ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, **kw).awaitTermination()
        return sorted(r.hitid_low for r in spark.read.parquet(target).collect())
    assert ingest(max_deliveries_per_batch=2) == [1, 2, 3]
    local = target.removeprefix("file:")
    written = sorted(os.listdir(local))
    assert ingest() == [1, 2, 3] and sorted(os.listdir(local)) == written  # nothing new, nothing done
    write_delivery(workdir, "f", "2024-01-02", [row(20), row(21)])
    assert ingest(validate=True) == [1, 3, 20, 21]
    # again, together with a new day; and a manifest that only changes its time
    write_delivery(workdir, "f", "2024-01-02", [row(22)])
    write_delivery(workdir, "f", "2024-01-04", [row(4)])
    os.utime(f"{workdir}/f_2024-01-01.txt", (10 ** 9, 10 ** 9))
    assert ingest() == [1, 3, 4, 22]
    assert ingest() == [1, 3, 4, 22]


def test_a_bad_delivery_again_stops_before_anything_is_written(spark, workdir):
    import pytest

    from webfeed.errors import ValidationError

    target, chk = new_scratch_path(spark, "ingest-target"), new_scratch_path(spark, "ingest-checkpoint")
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk).awaitTermination()
    write_delivery(workdir, "f", "2024-01-01", [row(2)], manifest_edit=lambda m: m.update(total=9))
    with pytest.raises(ValidationError, match="Total-Records"):
        ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, validate=True)
    assert [r.hitid_low for r in spark.read.parquet(target).collect()] == [1]
    write_delivery(workdir, "f", "2024-01-01", [row(2)])
    ingest_deliveries(spark, workdir, "f", target, checkpoint=chk, validate=True).awaitTermination()
    assert [r.hitid_low for r in spark.read.parquet(target).collect()] == [2]
