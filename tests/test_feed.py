import gzip
from datetime import datetime

import pytest
from pyspark.sql import types as T

from helpers import HEADER, row, write_delivery
from webfeed import read_feed, read_lookup
from webfeed.errors import DeliveryError, SchemaMismatchError, ValidationError


def test_typed_schema_and_sanitised_names(spark, workdir):  # S1, S2, C1-C3, C6
    write_delivery(workdir, "f", "2024-01-05", [row(1, rate="2.25")])
    df = read_feed(spark, workdir, "f", date="2024-01-05")
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        ("hitid_high", T.LongType()), ("hitid_low", T.LongType()), ("date_time", T.TimestampType()),
        ("pagename", T.StringType()), ("my_col__a_b_", T.StringType()), ("curr_rate", T.DoubleType())]
    r = df.collect()[0]
    assert r.curr_rate == 2.25 and r.date_time == datetime(2024, 1, 5, 10, 0)


def test_last_column_keeps_name_and_type(spark, workdir):  # X5
    write_delivery(workdir, "f", "2024-01-05", [row(1)], header_text="\t".join(HEADER) + "\r\n")
    assert read_feed(spark, workdir, "f").schema.fields[-1] == T.StructField("curr_rate", T.DoubleType())


def test_unknown_column_is_string(spark, workdir):  # C3 fallback
    write_delivery(workdir, "f", "2024-01-05", [["7", "x"]], header=["visit_num", "brand_new"])
    df = read_feed(spark, workdir, "f")
    assert df.schema["visit_num"].dataType == T.LongType() and df.schema["brand_new"].dataType == T.StringType()


def test_date_set_reads_only_listed_days(spark, workdir):  # S3, X1
    for d in (1, 2, 3, 4):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    got = sorted(r.hitid_low for r in read_feed(spark, workdir, "f", dates="2024-01-01,2024-01-03").collect())
    assert got == [1, 3]


def test_range_is_inclusive(spark, workdir):  # S4, X2
    for d in (1, 2, 3, 4):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    got = sorted(r.hitid_low for r in read_feed(spark, workdir, "f", start="2024-01-02", end="2024-01-03").collect())
    assert got == [2, 3]
    assert read_feed(spark, workdir, "f", start="2024-01-04", end="2024-01-04").count() == 1


def test_range_gap_is_an_error(spark, workdir):  # V4
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-03", [row(3)])
    with pytest.raises(DeliveryError, match="2024-01-02"):
        read_feed(spark, workdir, "f", start="2024-01-01", end="2024-01-03")


def test_reordered_columns_are_read_by_name(spark, workdir):  # C4, X6
    write_delivery(workdir, "f", "2024-01-01", [row(1, page="a", rate="1.0")])
    rev = list(reversed(HEADER))
    write_delivery(workdir, "f", "2024-01-02", [list(reversed(row(2, page="b", rate="2.0")))], header=rev)
    df = read_feed(spark, workdir, "f")
    assert df.columns[-1] == "curr_rate"
    got = sorted((r.hitid_low, r.pagename, r.curr_rate) for r in df.collect())
    assert got == [(1, "a", 1.0), (2, "b", 2.0)]


@pytest.mark.parametrize("header", [HEADER + ["extra"], HEADER[:-1], HEADER[:-1] + ["pagename"]])
def test_changed_columns_are_an_error(spark, workdir, header):  # C4
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(2)], header=header)
    with pytest.raises(SchemaMismatchError, match="2024-01-02"):
        read_feed(spark, workdir, "f")


def test_duplicate_names_in_first_delivery(spark, workdir):
    write_delivery(workdir, "f", "2024-01-01", [row(1)], header=HEADER[:-1] + ["pagename"])
    with pytest.raises(SchemaMismatchError, match="duplicated"):
        read_feed(spark, workdir, "f")


def test_multiple_data_files(spark, workdir):  # M5
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(10)], files=3)
    assert sorted(r.hitid_low for r in read_feed(spark, workdir, "f").collect()) == list(range(10))


def test_permissive_csv_values(spark, workdir):  # §1.2
    lines = ["0\t1\t2024-01-05 10:00:00\tp\tv\tnot-a-number",  # bad double -> NULL
             "0\t2\t2024-01-05 10:00:00",                       # short row -> NULLs
             "",                                               # blank line skipped
             "0\t3\t2024-01-05 10:00:00\tp\tv\t1.0\tEXTRA",       # extra field dropped
             "0\t18446744073709551615\t2024-01-05 10:00:00.5\tp\tv\t1.0"]  # beyond 2^63 -> NULL (X13)
    write_delivery(workdir, "f", "2024-01-05", lines)
    rows = {r.hitid_high * 0 + (r.hitid_low or -1): r for r in read_feed(spark, workdir, "f").collect()}
    assert len(rows) == 4
    assert rows[1].curr_rate is None and rows[2].pagename is None and rows[3].curr_rate == 1.0
    assert rows[-1].date_time == datetime(2024, 1, 5, 10, 0, 0, 500000)


def test_column_type_override_keeps_big_ids(spark, workdir):  # X13 / E3
    write_delivery(workdir, "f", "2024-01-05", ["0\t18446744073709551615\t2024-01-05 10:00:00\tp\tv\t1.0"])
    df = read_feed(spark, workdir, "f", column_types={"hitid_low": T.DecimalType(20, 0)})
    assert str(df.collect()[0].hitid_low) == "18446744073709551615"


def test_validate_passes_on_good_feed(spark, workdir):  # V2, V3, X10
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i) for i in range(5)], files=2)
    assert read_feed(spark, "file://" + workdir, "f", validate=True).count() == 10


@pytest.mark.parametrize("defect,match", [
    ("md5", "md5"), ("size", "size"), ("records", "records"), ("total", "Total-Records")])
def test_validate_failures(spark, workdir, defect, match):  # V2, V3
    def edit(m):
        if defect == "md5":
            m["data"][0]["md5"] = "0" * 32
        elif defect == "size":
            m["data"][0]["size"] += 1
        elif defect == "records":
            m["data"][0]["records"] += 1
        else:
            m["total"] += 1
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(4)], manifest_edit=edit)
    with pytest.raises(ValidationError, match=match):
        read_feed(spark, workdir, "f", validate=True)
    assert read_feed(spark, workdir, "f").count() == 4  # without validate the read works


def test_missing_data_file(spark, workdir):
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(4)], files=2, skip_files=(1,))
    with pytest.raises(ValidationError, match="file missing"):
        read_feed(spark, workdir, "f", validate=True)
    with pytest.raises(DeliveryError, match="02-f_2024-01-01.tsv.gz"):
        read_feed(spark, workdir, "f").count()


def test_blank_lines_do_not_count(spark, workdir):  # V3 uses the read's CSV settings
    write_delivery(workdir, "f", "2024-01-01", ["\t".join(row(1)), "", "\t".join(row(2))])
    assert read_feed(spark, workdir, "f", validate=True).count() == 2


def test_missing_archive_or_header_member(spark, workdir):  # V6, X8
    write_delivery(workdir, "f", "2024-01-01", [row(1)], write_archive=False)
    with pytest.raises(DeliveryError, match="archive"):
        read_feed(spark, workdir, "f")
    other = workdir + "/b"
    write_delivery(other, "f", "2024-01-01", [row(1)], archive_members={"event.tsv": b"1\tx\n"})
    with pytest.raises(DeliveryError, match="column_headers.tsv"):
        read_feed(spark, other, "f")


def test_read_is_lazy_and_prunes(spark, workdir):  # §4
    write_delivery(workdir, "f", "2024-01-05", [row(i, page="home" if i % 2 else "cart") for i in range(20)])
    q = read_feed(spark, workdir, "f").where("pagename = 'home'").select("hitid_low")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan
    assert "PushedFilters: [IsNotNull(pagename), EqualTo(pagename,home)]" in plan
    assert "ReadSchema: struct<hitid_low:bigint,pagename:string>" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert q.count() == 10


def test_crlf_data_lines(spark, workdir):
    write_delivery(workdir, "f", "2024-01-05", ["\t".join(row(1, rate="2.5")) + "\r", "\t".join(row(2)) + "\r"])
    got = sorted((r.hitid_low, r.curr_rate) for r in read_feed(spark, workdir, "f").collect())
    assert got == [(1, 2.5), (2, 1.5)]


def test_delivery_without_data_files(spark, workdir):
    write_delivery(workdir, "f", "2024-01-05", [], files=1, skip_files=(0,),
                   manifest_edit=lambda m: m.update(data=[], n_data=0, total=0))
    df = read_feed(spark, workdir, "f", validate=True)
    assert df.count() == 0 and df.columns[-1] == "curr_rate"
    write_delivery(workdir, "f", "2024-01-06", [row(1)])
    assert read_feed(spark, workdir, "f", start="2024-01-05", end="2024-01-06").count() == 1


def test_validation_is_eager_and_result_is_a_plain_scan(spark, workdir):  # X11
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(3)])
    df = read_feed(spark, workdir, "f", validate=True)   # validation ran here, once
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "binaryFile" not in plan and "Python" not in plan
    assert df.count() == 3 and df.count() == 3          # later actions do not re-validate


def test_special_characters_in_folder_and_feed_names(spark, workdir):
    """Blank, glob and URI-escape characters survive every read path."""
    from webfeed.operators import reports

    d = workdir + "/my feeds [eu] 100%+{x},y"
    feed = "web shop+1 %20"
    write_delivery(d, feed, "2024-01-01", [row(i) for i in range(4)], files=2, lookups={"event.tsv": "1\tA\n"})
    write_delivery(d, feed, "2024-01-02", [row(9)], lookups={"event.tsv": "1\tB\n"})
    assert read_feed(spark, "file://" + d, feed, validate=True).count() == 5
    assert read_feed(spark, d, feed, date="2024-01-02").count() == 1
    got = sorted((r.hitid_low, r.delivery_date.day) for r in read_feed(spark, d, feed, with_delivery_date=True).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (9, 2)]
    assert [tuple(r) for r in read_lookup(spark, d, feed, "event.tsv").collect()] == [("1", "B")]
    assert all(r.ok for r in reports.feed_validation(spark, d, feed).collect())
    assert all(r.ok for r in reports.delivery_records(spark, d, feed).collect())


def test_file_listed_by_two_deliveries(spark, workdir):
    """Read twice, like any repeated path; but it has no single delivery date."""
    from webfeed.errors import ManifestError

    first = write_delivery(workdir, "f", "2024-01-01", [row(1), row(2)])

    def also_list(m):
        m["data"] = m["data"] + first["data"]
        m["n_data"] = len(m["data"])
        m["total"] += first["total"]
    write_delivery(workdir, "f", "2024-01-02", [row(3)], manifest_edit=also_list)
    assert read_feed(spark, workdir, "f").count() == 5
    assert read_feed(spark, workdir, "f", validate=True).count() == 5  # each listing's count is right
    with pytest.raises(ManifestError, match="01-f_2024-01-01.tsv.gz"):
        read_feed(spark, workdir, "f", with_delivery_date=True)


def test_byte_order_marks(spark, workdir):
    """A UTF-8 byte-order mark does not rename the first column or hide the metadata block."""
    write_delivery(workdir, "f", "2024-01-05", [row(1)], header_text="\ufeff" + "\t".join(HEADER) + "\n")
    manifest = f"{workdir}/f_2024-01-05.txt"
    with open(manifest, encoding="utf-8") as fh:
        text = fh.read()
    with open(manifest, "w", encoding="utf-8") as fh:
        fh.write("\ufeff" + text)
    df = read_feed(spark, workdir, "f", validate=True)
    assert df.columns[0] == "hitid_high" and dict(df.dtypes)["hitid_high"] == "bigint"
    assert df.first().hitid_low == 1


def test_delivery_date_plan_keeps_pushdown_and_broadcasts_the_file_table(spark, workdir):
    write_delivery(workdir, "f", "2024-01-05", [row(i, page="home" if i % 2 else "cart") for i in range(6)], files=2)
    q = (read_feed(spark, workdir, "f", with_delivery_date=True)
         .where("pagename = 'home'").groupBy("delivery_date").count())
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pagename), EqualTo(pagename,home)]" in plan
    assert "ReadSchema: struct<pagename:string>" in plan
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert [(r.delivery_date.day, r["count"]) for r in q.collect()] == [(5, 3)]


def test_trailing_tab_in_header_makes_no_column(spark, workdir):
    write_delivery(workdir, "f", "2024-01-05", [row(1)], header_text="\t".join(HEADER) + "\t\n")
    df = read_feed(spark, workdir, "f")
    assert df.columns[-1] == "curr_rate" and len(df.columns) == len(HEADER)
    assert df.first().curr_rate == 1.5


def _in_folders(workdir, days, swap=True):
    """Deliveries whose files lie in a folder per day, with equal base names; every other header is reversed."""
    import hashlib
    import os

    from helpers import manifest_text, tar_gz
    for n, day in enumerate(days):
        os.makedirs(f"{workdir}/{day}", exist_ok=True)
        header = ["b", "a"] if swap and n % 2 else ["a", "b"]
        body = gzip.compress(("\t".join(f"{c}{n}" for c in header) + "\n").encode())
        archive = tar_gz({"column_headers.tsv": ("\t".join(header) + "\n").encode()})
        for name, data in (("hits.tsv.gz", body), ("lookup.tar.gz", archive)):
            with open(f"{workdir}/{day}/{name}", "wb") as fh:
                fh.write(data)
        m = {"version": "1.0", "n_lookup": 1, "n_data": 1, "total": 1,
             "lookups": [{"name": f"{day}/lookup.tar.gz", "md5": hashlib.md5(archive).hexdigest(), "size": len(archive)}],
             "data": [{"name": f"{day}/hits.tsv.gz", "md5": hashlib.md5(body).hexdigest(), "size": len(body), "records": 1}]}
        with open(f"{workdir}/f_{day}.txt", "w") as fh:
            fh.write(manifest_text(m))


def test_equal_base_names_in_subfolders(spark, workdir):  # W1
    from webfeed.operators import reports

    _in_folders(workdir, ["2024-01-04", "2024-01-05", "2024-01-06"])
    got = read_feed(spark, workdir, "f", validate=True, with_delivery_date=True)
    assert sorted((r.a, r.b, r.delivery_date.day) for r in got.collect()) == \
        [("a0", "b0", 4), ("a1", "b1", 5), ("a2", "b2", 6)]
    rows = reports.feed_validation(spark, workdir, "f").collect()
    assert len(rows) == 6 and all(r.ok for r in rows)


def test_folder_listing_and_exact_names_read_the_same(spark, workdir, monkeypatch):  # P1
    from webfeed.sources import files

    _in_folders(workdir, ["2024-01-04", "2024-01-05", "2024-01-06"])

    def twice(m):
        m["data"] *= 2
        m["n_data"], m["total"] = 2, 2
    write_delivery(workdir, "g", "2024-01-01", [row(1), row(2)], manifest_edit=twice)  # one file listed twice
    write_delivery(workdir, "g", "2024-01-02", [row(3)])
    got = []
    for limit in (32, 0):
        monkeypatch.setattr(files, "DIRECT_FILES", limit)
        got.append([sorted(map(tuple, read_feed(spark, workdir, f).collect())) for f in ("f", "g")])
        import os
        os.rename(f"{workdir}/01-g_2024-01-02.tsv.gz", f"{workdir}/kept")
        with pytest.raises(DeliveryError, match="01-g_2024-01-02.tsv.gz"):
            read_feed(spark, workdir, "g")
        os.rename(f"{workdir}/kept", f"{workdir}/01-g_2024-01-02.tsv.gz")
    assert got[0] == got[1] and len(got[0][1]) == 5


def test_only_selected_files_are_opened(spark, workdir):  # P1
    for d in range(1, 29):
        write_delivery(workdir, "f", f"2024-01-{d:02d}", [row(d)], files=3)
    df = read_feed(spark, workdir, "f", start="2024-01-03", end="2024-01-16")  # 42 files: by folder listing
    assert df.count() == 14
    plan = df.select("pagename").where("pagename = 'home'")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pagename), EqualTo(pagename,home)]" in text
    scan = plan._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 42


def test_column_names_with_dot_and_backtick(spark, workdir):  # W2
    from webfeed.operators import reports

    write_delivery(workdir, "f", "2024-01-01", ["1\tx\t2"], header=["a.b", "c`d", "`"])
    df = read_feed(spark, workdir, "f", column_types={"a.b": T.LongType(), "`": T.LongType()}, with_delivery_date=True)
    assert df.columns == ["a.b", "c`d", "`", "delivery_date"] and tuple(df.first())[:3] == (1, "x", 2)
    losses = reports.type_losses(spark, workdir, "f", column_types={"c`d": T.LongType()}).collect()
    assert [(r.column_name, r["values"], r.lost) for r in losses] == [("c`d", 1, 1)]


def test_names_that_clash(spark, workdir):  # W8
    write_delivery(workdir, "f", "2024-01-01", ["1\t2"], header=["Browser", "browser"])
    with pytest.raises(SchemaMismatchError, match="duplicated"):
        read_feed(spark, workdir, "f")
    write_delivery(workdir, "g", "2024-01-01", ["1\t2"], header=["delivery_date", "x"])
    assert read_feed(spark, workdir, "g").count() == 1
    with pytest.raises(SchemaMismatchError, match="delivery_date"):
        read_feed(spark, workdir, "g", with_delivery_date=True)


def test_reading_sets_no_checkpoint_folder(spark, workdir):  # W9
    before = spark.sparkContext.getCheckpointDir()
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    read_feed(spark, workdir, "f", validate=True).count()
    assert spark.sparkContext.getCheckpointDir() == before
