"""The delivery catalogue against plain reads."""

import os
import random

import pytest

from helpers import HEADER, row, write_delivery
from webfeed import read_feed
from webfeed.errors import DeliveryError, ManifestError, SchemaMismatchError, ValidationError
from webfeed.session import new_scratch_path
from webfeed.sources.catalog import Catalog


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(spark, catalog, directory, **kw):
    """The rows of a catalogue read by tasks, by the native scan and of a plain read; all equal."""
    plain = read_feed(spark, directory, "f", **kw)
    for direct in (0, 10 ** 6):
        got = catalog.read(direct=direct, **kw)
        assert got.schema == plain.schema and rows_of(got) == rows_of(plain)
    return rows_of(plain)


@pytest.fixture
def catalog(spark, workdir):
    return Catalog(spark, new_scratch_path(spark, "catalog"), workdir, "f")


def test_equal_to_plain_reads(spark, workdir, catalog):
    rng = random.Random(1)
    odd = ['0\t1\t2024-01-05 10:00:00\tp\tv\tnot-a-number', "0\t2", "", " \r", '0\t3\t2024-01-05 10:00:00\t"a\tb"\tv\t1.0\tEXTRA',
           '0\t4\tx\t"open\tv\t1.0', "0\t18446744073709551615\t2024-01-05 10:00:00.5\tp\té中\t1.0", "0\t5\t\t\t\t\r", "\t\t\t\t\t"]
    for d in range(1, 6):
        write_delivery(workdir, "f", f"2024-01-0{d}", [*odd, *[row(rng.randrange(99)) for _ in range(20)]], files=d)
    rev = list(reversed(HEADER))
    write_delivery(workdir, "f", "2024-01-06", [list(reversed(row(6)))], header=rev)
    write_delivery(workdir, "f.x", "2024-01-06", [row(77)])
    assert catalog.refresh() == 6
    assert len(both(spark, catalog, workdir)) == 5 * 26 + 1  # a line of tabs only is blank
    both(spark, catalog, workdir, date="2024-01-03", with_delivery_date=True)
    both(spark, catalog, workdir, dates="2024-01-01,2024-01-06", with_delivery_date=True)
    both(spark, catalog, workdir, start="2024-01-02", end="2024-01-04")


def test_a_refresh_opens_only_what_is_new(spark, workdir, catalog, monkeypatch):
    from webfeed.sources import catalog as module

    opened = []
    load = module.load_deliveries
    monkeypatch.setattr(module, "load_deliveries", lambda s, d, f, sel, **k: opened.append(len(sel.dates)) or load(s, d, f, sel, **k))
    for d in (1, 2, 3):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    assert catalog.refresh(at_once=2) == 3 and catalog.refresh() == 0
    write_delivery(workdir, "f", "2024-01-04", [row(4)])
    assert catalog.refresh() == 1 and opened == [2, 1, 1]
    both(spark, catalog, workdir)


def test_a_day_delivered_again_replaces_its_rows(spark, workdir, catalog):
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d), row(10 + d)], files=2)
    catalog.refresh()
    write_delivery(workdir, "f", "2024-01-01", [row(7), row(8), row(9)])
    assert catalog.refresh(validate=True) == 1
    assert sorted(r[1] for r in both(spark, catalog, workdir)) == [2, 7, 8, 9, 12]
    assert catalog.files().count() == 3 and catalog.deliveries().count() == 2


def test_old_manifests_need_a_full_refresh(spark, workdir, catalog):
    write_delivery(workdir, "f", "2024-01-02", [row(2)])
    catalog.refresh()
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    os.utime(f"{workdir}/f_2024-01-01.txt", (10 ** 9, 10 ** 9))
    assert catalog.refresh() == 0 and catalog.refresh(full=True) == 1
    assert len(both(spark, catalog, workdir)) == 2


def test_a_lost_refresh_leaves_nothing_behind(spark, workdir, catalog, monkeypatch):
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    append = Catalog._append

    def lost(self, name, rows, schema):
        if name == "deliveries":
            raise RuntimeError("driver lost")
        append(self, name, rows, schema)
    monkeypatch.setattr(Catalog, "_append", lost)
    with pytest.raises(RuntimeError):
        catalog.refresh()
    monkeypatch.setattr(Catalog, "_append", append)
    assert catalog.files().count() == 0 and catalog.refresh() == 1
    assert len(both(spark, catalog, workdir)) == 1


def test_problems_are_those_of_a_feed_read(spark, workdir, catalog):
    with pytest.raises(DeliveryError, match="no delivery"):
        catalog.read()
    assert catalog.refresh() == 0
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-03", [row(3)], manifest_edit=lambda m: m.update(n_data=9))
    write_delivery(workdir, "f", "2024-01-04", [row(4)], header=[*HEADER, "more"])
    write_delivery(workdir, "f", "2024-01-05", [row(5)], write_archive=False)
    write_delivery(workdir, "f", "2024-01-06", [row(6), row(7)], files=2, skip_files=(1,))
    assert catalog.refresh() == 5
    assert len(both(spark, catalog, workdir, date="2024-01-01")) == 1
    for kw, error, match in ((dict(start="2024-01-01", end="2024-01-02"), DeliveryError, "2024-01-02"),
                             (dict(date="2024-01-03"), ManifestError, "declares 9 data files"),
                             (dict(dates="2024-01-01,2024-01-04"), SchemaMismatchError, "more"),
                             (dict(date="2024-01-05"), ManifestError, "archive"),
                             (dict(date="2024-01-06"), DeliveryError, "02-f_2024-01-06")):
        with pytest.raises(error, match=match):
            catalog.read(**kw)


def test_validated_refresh_takes_nothing_bad(spark, workdir, catalog):
    write_delivery(workdir, "f", "2024-01-01", [row(1)], manifest_edit=lambda m: m.update(total=5))
    with pytest.raises(ValidationError, match="Total-Records"):
        catalog.refresh(validate=True)
    assert catalog.deliveries().count() == 0
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    assert catalog.refresh(validate=True) == 1


def test_plan_does_not_grow_with_the_folder(spark, workdir, catalog):
    def size():
        return len(catalog.read(direct=0)._jdf.queryExecution().executedPlan().toString())
    for d in range(1, 4):
        write_delivery(workdir, "f", f"2024-01-{d:02d}", [row(d)])
    catalog.refresh()
    few = size()
    for d in range(4, 29):
        write_delivery(workdir, "f", f"2024-01-{d:02d}", [row(d) for _ in range(4)], files=4)
    catalog.refresh()
    assert abs(size() - few) < 400  # numbers of digits, and tasks
    assert len(both(spark, catalog, workdir)) == 103


def test_damaged_and_empty_files(spark, workdir, catalog):
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(50)])
    write_delivery(workdir, "f", "2024-01-02", [row(i) for i in range(50)])
    open(f"{workdir}/01-f_2024-01-02.tsv.gz", "wb").close()
    catalog.refresh()
    assert len(both(spark, catalog, workdir)) == 50
    whole = open(f"{workdir}/01-f_2024-01-01.tsv.gz", "rb").read()
    with open(f"{workdir}/01-f_2024-01-01.tsv.gz", "wb") as f:
        f.write(whole[:-9])
    with pytest.raises(Exception, match="01-f_2024-01-01.tsv.gz is damaged"):
        catalog.read(direct=0).collect()


def test_mounted_folder(spark, workdir):
    """A folder behind a viewfs mount: tasks open the folder it stands for."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.feeds.link./in", f"file://{workdir}")
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    mounted = "viewfs://feeds/in"
    c = Catalog(spark, new_scratch_path(spark, "catalog"), mounted, "f")
    assert c.refresh(validate=True) == 2
    assert rows_of(c.read(direct=0)) == rows_of(read_feed(spark, workdir, "f"))
    from webfeed.operators.validate import validation_report
    assert all(r.ok for r in validation_report(spark, mounted, "f", md5_inline_max_bytes=0).collect())


def test_store_settings():
    from webfeed.session import store_settings

    conf = {"fs.s3a.access.key": "a", "fs.s3a.secret.key": "b", "fs.s3a.endpoint": "http://store:9000"}
    assert dict(store_settings("s3a", conf.get)) == {
        "access_key": "a", "secret_key": "b", "endpoint_override": "store:9000", "scheme": "http"}
    assert store_settings("file", conf.get) == ()


def test_one_big_file_is_read_by_several_tasks(spark, workdir, catalog, monkeypatch):
    import gzip

    from pyspark.sql import functions as F
    from webfeed.session import task_folder
    from webfeed.sources import lines

    rng = random.Random(8)
    text = b"\xef\xbb\xbf" + b"".join(rng.choice([b"%d\tx" % i, b'"q\ty"', b" ", b"", b"z" * rng.randrange(300)])
                                      + rng.choice([b"\n", b"\r\n", b"\r"]) for i in range(5000)) + b"last"
    for data, gzipped in ((text, False), (gzip.compress(text), True), (gzip.compress(text[:9000]) + gzip.compress(text[9000:]), True)):
        for size in (97, 4096, 1 << 20):
            chunks = [data[i:i + size] for i in range(0, len(data), size)]
            whole = [x for _, part in lines.file_lines(chunks, gzipped) for x in part.to_pylist()]
            for parts in (2, 3, 8):
                got = [[(n + i, x) for n, part in lines.file_lines(chunks, gzipped, p, parts, len(chunks))
                        for i, x in enumerate(part.to_pylist())] for p in range(parts)]
                assert [x for part in got for x in part] == list(enumerate(whole))
                assert size > 97 or all(got)

    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i, page=f"p{rng.random()}") for i in range(4000)])
    catalog.refresh()
    plain = rows_of(read_feed(spark, workdir, "f", with_delivery_date=True))
    assert rows_of(catalog.read(direct=0, task_bytes=10_000, with_delivery_date=True)) == plain
    # by value: the task function carries this module's constants
    monkeypatch.setattr(lines, "READ_BYTES", 1000)
    files = lines.spread(catalog.files(), 10_000)
    found = lines.record_lines(files, task_folder(spark, workdir)).withColumn("task", F.spark_partition_id())
    tasks = found.groupBy("file_key").agg(F.countDistinct("task").alias("n"), F.max("record").alias("last"),
                                          F.countDistinct("record").alias("records")).collect()
    assert all(t.n > 1 and t.last == t.records == 4000 for t in tasks) and len(tasks) == 2
    assert rows_of(catalog.read(direct=0, task_bytes=10_000, with_delivery_date=True)) == plain
