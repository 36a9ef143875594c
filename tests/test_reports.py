from datetime import date

from helpers import HEADER, row, write_delivery
from webfeed.operators import reports


def test_delivery_gaps(spark, workdir):  # V4 as a report
    for d in (2, 3, 6):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    got = [r.missing_date for r in reports.delivery_gaps(spark, workdir, "f").orderBy("missing_date").collect()]
    assert got == [date(2024, 1, 4), date(2024, 1, 5)]
    got = [r.missing_date.day for r in
           reports.delivery_gaps(spark, workdir, "f", "2024-01-01", "2024-01-07").orderBy("missing_date").collect()]
    assert got == [1, 4, 5, 7]


def test_schema_drift(spark, workdir):  # C4 as a report
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(2)], header=HEADER + ["new_col"])
    write_delivery(workdir, "f", "2024-01-03", [row(3)], header=list(reversed(HEADER)))
    write_delivery(workdir, "f", "2024-01-04", [row(4)], archive_members={"event.tsv": b""})
    rows = {r.delivery_date.day: r for r in reports.schema_drift(spark, workdir, "f").collect()}
    assert set(rows) == {2, 3, 4}
    assert rows[2].extra_columns == ["new_col"] and not rows[2].reordered
    assert rows[3].reordered and rows[3].missing_columns == []
    assert rows[4].header_found is False


def test_validation_report_rows(spark, workdir):  # V2, V3 as a report
    def edit(m):
        m["data"][1]["md5"] = "0" * 32
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(6)], files=2, manifest_edit=edit)
    rows = {r.file_name: r for r in reports.feed_validation(spark, workdir, "f").collect()}
    assert len(rows) == 3
    good, bad = rows["01-f_2024-01-01.tsv.gz"], rows["02-f_2024-01-01.tsv.gz"]
    assert good.ok and good.actual_records == 3 and good.md5_ok
    assert not bad.ok and bad.md5_ok is False and bad.size_ok and bad.records_ok
    assert rows["f_2024-01-01-lookup_data.tar.gz"].ok and rows["f_2024-01-01-lookup_data.tar.gz"].records_ok is None


def test_big_files_are_hashed_by_streaming(spark, workdir):
    from webfeed.operators.validate import validation_report

    m = write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(50)], files=2)
    report = validation_report(spark, workdir, "f", md5_inline_max_bytes=0)
    assert {r.file_name: r.actual_md5 for r in report.collect() if r.kind == "data"} == \
        {d["name"]: d["md5"] for d in m["data"]}


def test_delivery_records(spark, workdir):
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(3)])
    write_delivery(workdir, "f", "2024-01-02", [row(i) for i in range(3)], manifest_edit=lambda m: m.update(total=4))
    rows = {r.delivery_date.day: r for r in reports.delivery_records(spark, workdir, "f").collect()}
    assert rows[1].ok and (rows[2].total_records, rows[2].actual_records, rows[2].ok) == (4, 3, False)


def test_digest_of_a_file_above_the_limit_whatever_size_is_listed(spark, workdir):  # K1
    from webfeed.operators.validate import validation_report

    def small(m):
        m["data"][0]["size"] = 1
    m = write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(50)], manifest_edit=small)
    got = [[(r.file_name, r.actual_size, r.actual_md5, r.md5_ok, r.size_ok) for r in validation_report(
        spark, workdir, "f", md5_inline_max_bytes=limit).orderBy("file_name").collect()] for limit in (1, 1 << 20)]
    assert got[0] == got[1] and got[0][0][2:] == (m["data"][0]["md5"], True, False)


def test_headers_are_collected_once_each(spark, workdir):
    from webfeed.sources.header import collect_headers
    from webfeed.sources.manifest import load_deliveries

    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(2)], header=HEADER + ["x y"])
    write_delivery(workdir, "f", "2024-01-03", [row(3)])
    write_delivery(workdir, "f", "2024-01-04", [row(4)], archive_members={"event.tsv": b""})
    archives = [d.archive for d in load_deliveries(spark, workdir, "f")]
    found = collect_headers(spark, workdir, archives, skip_problems=True)
    assert found["f_2024-01-02-lookup_data.tar.gz"][-1] == "x_y"
    assert found["f_2024-01-01-lookup_data.tar.gz"] == found["f_2024-01-03-lookup_data.tar.gz"]
    assert found["f_2024-01-04-lookup_data.tar.gz"] is None


def test_type_losses(spark, workdir):  # X13 / E3
    lines = ["0\t1\t2024-01-05 10:00:00\tp\tv\t1.5",
             "0\t18446744073709551615\t2024-01-05 10:00:00\tp\tv\t1,5",
             "0\t3\tnot a time\tp\tv\t"]
    write_delivery(workdir, "f", "2024-01-05", lines)
    got = {r.column_name: (r.data_type, r["values"], r.lost) for r in reports.type_losses(spark, workdir, "f").collect()}
    assert got == {"hitid_high": ("bigint", 3, 0), "hitid_low": ("bigint", 3, 1),
                   "date_time": ("timestamp", 3, 1), "curr_rate": ("double", 2, 1)}


def test_truncated_data_file_is_reported_not_a_crash(spark, workdir):
    import pytest

    from webfeed import read_feed
    from webfeed.errors import ValidationError

    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(2000)])
    write_delivery(workdir, "f", "2024-01-02", [row(3)])
    path = f"{workdir}/01-f_2024-01-01.tsv.gz"
    with open(path, "rb") as fh:
        data = fh.read()
    with open(path, "wb") as fh:
        fh.write(data[: len(data) // 2])   # an interrupted transfer
    bad = [r for r in reports.feed_validation(spark, workdir, "f").collect() if not r.ok]
    assert [(r.file_name, r.size_ok, r.md5_ok, r.records_ok) for r in bad] == \
        [("01-f_2024-01-01.tsv.gz", False, False, False)]
    assert bad[0].actual_records < 2000
    with pytest.raises(ValidationError, match="01-f_2024-01-01.tsv.gz: size"):
        read_feed(spark, workdir, "f", validate=True)


def test_damaged_archive(spark, workdir):
    import pytest

    from webfeed import read_feed, read_lookup
    from webfeed.errors import DeliveryError, ValidationError

    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups={"event.tsv": "1\tA\n" * 5000})
    write_delivery(workdir, "f", "2024-01-02", [row(2)], lookups={"event.tsv": "1\tB\n"})
    path = f"{workdir}/f_2024-01-01-lookup_data.tar.gz"
    with open(path, "wb") as fh:
        fh.write(b"not an archive")
    with pytest.raises(ValidationError, match="f_2024-01-01-lookup_data.tar.gz: size"):
        read_feed(spark, workdir, "f", validate=True)   # reported before anything is unpacked
    with pytest.raises(DeliveryError, match="f_2024-01-01-lookup_data.tar.gz .lookup archive cannot be unpacked"):
        read_feed(spark, workdir, "f")
    with pytest.raises(Exception, match="cannot be unpacked"):
        read_lookup(spark, workdir, "f", "event.tsv", date="2024-01-01").collect()
    assert read_lookup(spark, workdir, "f", "event.tsv").collect()[0].lookup_value == "B"
    drift = reports.schema_drift(spark, workdir, "f").collect()
    assert [(r.delivery_date.day, r.header_found) for r in drift] == [(1, False)]


def test_damaged_archive_among_others(spark, workdir):
    import pytest

    from webfeed.errors import DeliveryError
    from webfeed.sources.header import collect_headers

    for d in (1, 2, 3):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)])
    with open(f"{workdir}/f_2024-01-02-lookup_data.tar.gz", "wb") as fh:
        fh.write(b"broken")
    archives = [f"f_2024-01-0{d}-lookup_data.tar.gz" for d in (1, 2, 3)]
    with pytest.raises(DeliveryError, match="f_2024-01-02-lookup_data.tar.gz"):
        collect_headers(spark, workdir, archives)
    got = collect_headers(spark, workdir, archives, skip_problems=True)
    assert got["f_2024-01-02-lookup_data.tar.gz"] is None
    assert got["f_2024-01-01-lookup_data.tar.gz"] == [h.replace(" ", "_").replace("(", "_").replace(")", "_")
                                                      .replace("=", "_") for h in HEADER]


def test_empty_data_file_exists_and_validates(spark, workdir):
    """Scans skip zero-byte files; the file index still knows them."""
    import hashlib

    from webfeed import read_feed

    def empty_second(m):
        m["data"][1].update(md5=hashlib.md5(b"").hexdigest(), size=0, records=0)
        m["total"] = m["data"][0]["records"]
    write_delivery(workdir, "f", "2024-01-01", [row(1), row(2)], files=2, manifest_edit=empty_second)
    open(f"{workdir}/02-f_2024-01-01.tsv.gz", "wb").close()
    assert read_feed(spark, workdir, "f", validate=True).count() == 1
    write_delivery(workdir, "f", "2024-01-02", [row(3), row(4)], files=2)
    import os
    os.remove(f"{workdir}/01-f_2024-01-02.tsv.gz")   # a missing file alongside the empty one
    rows = {r.file_name: r for r in reports.feed_validation(spark, workdir, "f").collect()}
    assert rows["02-f_2024-01-01.tsv.gz"].ok and rows["02-f_2024-01-01.tsv.gz"].actual_size == 0
    assert not rows["01-f_2024-01-02.tsv.gz"].file_exists and rows["02-f_2024-01-02.tsv.gz"].ok


def test_second_header_line_is_refused(spark, workdir):  # K5
    import pytest

    from webfeed import DeliveryError, read_feed

    write_delivery(workdir, "f", "2024-01-01", [row(1)], header_text="\t".join(HEADER) + "\n \n")
    assert read_feed(spark, workdir, "f").count() == 1
    write_delivery(workdir, "f", "2024-01-02", [row(1)], header_text="\t".join(HEADER) + "\nmore\n")
    with pytest.raises(DeliveryError, match="more than one line"):
        read_feed(spark, workdir, "f")


def test_drift_gives_every_delivery_without_a_header_and_why(spark, workdir):  # W3, V6, V7
    def none(m):
        m["lookups"], m["n_lookup"] = [], 0
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-02", [row(1)], header_text="")
    write_delivery(workdir, "f", "2024-01-03", [row(1)], manifest_edit=none)
    write_delivery(workdir, "f", "2024-01-04", [row(1)], write_archive=False)
    got = {r.delivery_date.day: (r.header_found, r.problem) for r in reports.schema_drift(spark, workdir, "f").collect()}
    assert got == {2: (False, "column_headers.tsv is empty"), 3: (False, "manifest lists 0 lookup archives"),
                   4: (False, "lookup archive is missing")}


def test_many_bad_files_are_named_in_part(spark, workdir):
    import pytest

    from webfeed import ValidationError, read_feed

    def wrong(m):
        for d in m["data"]:
            d["md5"] = "0" * 32
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(15)], files=15, manifest_edit=wrong)
    with pytest.raises(ValidationError, match="5 more bad files") as e:
        read_feed(spark, workdir, "f", validate=True)
    assert len(e.value.failures) == 10
    assert sum(not r.ok for r in reports.feed_validation(spark, workdir, "f").collect()) == 15


def test_lost_cells(spark, workdir):  # E3, X13
    from pyspark.sql import types as T

    big = str(2 ** 64)
    write_delivery(workdir, "f", "2024-01-01", [
        row(1, rate="1,5"), "", row(2), ["0", big, "never", "p", "v", "x"], ["0", "3"], ["", "", "", "", "", ""], row(4, rate="2,5")])
    write_delivery(workdir, "f", "2024-01-02", [list(reversed(row(9, rate="é")))], header=list(reversed(HEADER)))
    got = sorted((r.delivery_date.day, r.file_name, r.record, r.column_name, r.data_type, r.value)
                 for r in reports.lost_cells(spark, workdir, "f").collect())
    one, two = "01-f_2024-01-01.tsv.gz", "01-f_2024-01-02.tsv.gz"
    assert got == [(1, one, 1, "curr_rate", "double", "1,5"), (1, one, 3, "curr_rate", "double", "x"),
                   (1, one, 3, "date_time", "timestamp", "never"), (1, one, 3, "hitid_low", "bigint", big),
                   (1, one, 5, "curr_rate", "double", "2,5"), (2, two, 1, "curr_rate", "double", "é")]
    losses = {r.column_name: r.lost for r in reports.type_losses(spark, workdir, "f").collect()}
    assert losses == {"hitid_high": 0, "hitid_low": 1, "date_time": 1, "curr_rate": 4}
    assert reports.lost_cells(spark, workdir, "f", column_types=dict.fromkeys(HEADER, T.StringType())).count() == 0


def test_column_profile_loses_nothing(spark, workdir):  # C3, X13
    columns = {
        "small": ["0", "-5", "2147483647"], "long": ["1", "2147483648", "-9223372036854775808"], "huge": ["18446744073709551615", "7"],
        "over": ["100000000000000000000", "1"], "zeros": ["007", "1"], "plus": ["+1", "2"], "half": ["0.5", "-3", "1e3"],
        "exact": ["0.30000000000000004", "1.0E-5"], "rough": ["0.123456789012345678"], "mixed": ["5", "x"], "blank": ["", ""],
        "time": ["2024-01-05 10:00:00", "2024-02-29 23:59:59.123456"], "feb": ["2024-02-30 10:00:00"], "day": ["2024-01-05"],
        "both": ["5", "2024-01-05 10:00:00"], "spaced": [" 5", "6"], "nan": ["NaN", "1.5"], "hitid_low": ["5", ""], "curr_rate": ["1,5"],
        "mcvisid": ["99999999999", "1"], "inf": ["1e999"]}
    n = max(map(len, columns.values()))
    lines = [[v[i] if i < len(v) else "" for v in columns.values()] for i in range(n)]
    write_delivery(workdir, "f", "2024-01-01", lines, header=list(columns))
    profile = reports.column_profile(spark, workdir, "f")
    rows = {r.column_name: r for r in profile.collect()}
    assert {c: rows[c].lossless_type for c in columns} == {
        "small": "int", "long": "bigint", "huge": "decimal(20,0)", "over": "string", "zeros": "string", "plus": "string",
        "half": "double", "exact": "double", "rough": "string", "mixed": "string", "blank": "string", "time": "timestamp",
        "feb": "string", "day": "string", "both": "string", "spaced": "string", "nan": "string", "hitid_low": "int",
        "curr_rate": "string", "mcvisid": "bigint", "inf": "string"}
    assert rows["blank"]["values"] == 0 and rows["hitid_low"]["values"] == 1 and rows["small"].position == 1
    types = reports.lossless_types(profile)
    losses = reports.type_losses(spark, workdir, "f", column_types=types).collect()
    assert losses and all(r.lost == 0 for r in losses)


def test_equal_archives_are_unpacked_once(spark, workdir, monkeypatch):  # A1, C1
    from webfeed import read_feed
    from webfeed.plans import scan

    asked = []
    collect = scan.collect_headers
    monkeypatch.setattr(scan, "collect_headers", lambda s, d, names, **kw: asked.append(len(names)) or collect(s, d, names, **kw))
    for d in range(1, 7):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(d)], lookups={"event.tsv": f"{d % 2}\tx\n"})
    assert read_feed(spark, workdir, "f", validate=True).count() == 6
    assert read_feed(spark, workdir, "f").count() == 6
    assert asked == [2, 6]


def test_jobs_of_a_validated_read_and_of_the_drift_report(spark, workdir):  # P2, P3
    from webfeed import read_feed

    for d in range(1, 4):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i) for i in range(5)], files=2)

    def jobs(run):
        name = f"jobs-{run.__name__}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    def plain():
        read_feed(spark, workdir, "f")

    def validated():
        read_feed(spark, workdir, "f", validate=True)

    def drift():
        reports.schema_drift(spark, workdir, "f").count()
    counts = jobs(plain), jobs(validated), jobs(drift)
    assert counts[0] <= 5 and counts[1] <= 8 and counts[2] <= 7, counts


def test_nothing_is_decoded_for_the_rows_of_a_feed(spark, workdir):  # P1
    from webfeed import read_feed

    for d in range(1, 15):
        write_delivery(workdir, "f", f"2024-01-{d:02d}", [row(i) for i in range(3)], files=3)
    for kw in (dict(), dict(with_delivery_date=True), dict(start="2024-01-02", end="2024-01-13")):
        df = read_feed(spark, workdir, "f", **kw)
        assert df.count() == (36 if "start" in kw else 42)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp_replace" not in text and "decode" not in text.lower()
