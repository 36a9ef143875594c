from datetime import date

import pytest

from helpers import row, write_delivery
from webfeed import manifests, selection
from webfeed.errors import DeliveryError, ManifestError
from webfeed.sources.manifest import MANIFEST_SCHEMA, collect_deliveries, load_deliveries


def test_schema_and_values(spark, workdir):  # S8, M1-M3, M6
    m = write_delivery(workdir, "f", "2024-01-05", [row(i) for i in range(5)], files=2)
    df = manifests(spark, workdir, "f")
    assert df.schema.simpleString() == MANIFEST_SCHEMA.simpleString()
    r = df.collect()[0]
    assert r.delivery_date == date(2024, 1, 5) and r.version == "1.0"
    assert (r.n_lookup_files, r.n_data_files, r.total_records) == (1, 2, 5)
    assert [e.name for e in r.data_files] == [d["name"] for d in m["data"]]
    assert [e.record_count for e in r.data_files] == [3, 2]
    assert r.lookup_files[0].md5 == m["lookups"][0]["md5"] and r.problems == []


@pytest.mark.parametrize("newline", ["\r\n", "\r"])
def test_line_ends(spark, workdir, newline):  # M4
    write_delivery(workdir, "f", "2024-01-05", [row(1)], newline=newline)
    r = manifests(spark, workdir, "f").collect()[0]
    assert r.problems == [] and r.total_records == 1 and r.data_files[0].record_count == 1


def test_padded_numbers_and_digest_case(spark, workdir):  # M1
    write_delivery(workdir, "f", "2024-01-05", [row(1)], manifest_edit=lambda m: m.update(
        total=f"  {m['total']} ", n_data=f" {m['n_data']}"))
    r = manifests(spark, workdir, "f").collect()[0]
    assert r.problems == [] and r.n_data_files == 1 and r.total_records == 1


def test_missing_metadata_block(spark, workdir):
    write_delivery(workdir, "f", "2024-01-05", [row(1)], manifest_edit=lambda m: m.update(raw="hello\n"))
    r = manifests(spark, workdir, "f").collect()[0]
    assert r.problems == ["no metadata block"]
    with pytest.raises(ManifestError, match="no metadata block"):
        collect_deliveries(spark, workdir, "f", selection())


def test_declared_counts_differ(spark, workdir):  # V1
    write_delivery(workdir, "f", "2024-01-05", [row(1)], manifest_edit=lambda m: m.update(n_data=3))
    with pytest.raises(ManifestError, match="declares 3 data files but lists 1"):
        collect_deliveries(spark, workdir, "f", selection())


def test_file_size_beyond_32_bits(spark, workdir):  # X12
    def edit(m):
        m["data"][0]["size"] = 5_000_000_000
    write_delivery(workdir, "f", "2024-01-05", [row(1)], manifest_edit=edit)
    assert manifests(spark, workdir, "f").collect()[0].data_files[0].size == 5_000_000_000


def test_two_archives_rejected(spark, workdir):  # V7
    def edit(m):
        m["lookups"].append(dict(m["lookups"][0]))
        m["n_lookup"] = 2
    write_delivery(workdir, "f", "2024-01-05", [row(1)], manifest_edit=edit)
    with pytest.raises(ManifestError, match="exactly 1"):
        collect_deliveries(spark, workdir, "f", selection())
    assert len(collect_deliveries(spark, workdir, "f", selection(), need_archive=False)) == 1


def test_feed_name_is_literal(spark, workdir):  # S5, X9
    write_delivery(workdir, "a.b", "2024-01-05", [row(1)])
    write_delivery(workdir, "axb", "2024-01-06", [row(2)])
    write_delivery(workdir, "a.bc", "2024-01-07", [row(3)])
    got = [d.delivery_date.day for d in load_deliveries(spark, workdir, "a.b")]
    assert got == [5]


def test_glob_characters_in_feed_name(spark, workdir):
    write_delivery(workdir, "s[1]{x}", "2024-01-05", [row(1)])
    assert [d.delivery_date.day for d in load_deliveries(spark, workdir, "s[1]{x}")] == [5]
    assert [d.delivery_date.day for d in load_deliveries(spark, workdir, "s[1]{x}",
                                                          selection(date="2024-01-05"))] == [5]


def test_missing_dates_reported_together(spark, workdir):  # V4
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir, "f", "2024-01-03", [row(1)])
    with pytest.raises(DeliveryError, match="2024-01-02, 2024-01-04"):
        collect_deliveries(spark, workdir, "f", selection(start="2024-01-01", end="2024-01-04"))
    with pytest.raises(DeliveryError, match="2024-01-09"):
        collect_deliveries(spark, workdir, "f", selection(dates="2024-01-01,2024-01-09"))


def test_missing_directory_or_no_manifest(spark, workdir):  # V5
    with pytest.raises(DeliveryError):
        collect_deliveries(spark, workdir + "/nope", "f", selection())
    write_delivery(workdir, "g", "2024-01-01", [row(1)])
    with pytest.raises(DeliveryError):
        collect_deliveries(spark, workdir, "f", selection())


def test_not_recursive(spark, workdir):  # S5
    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    write_delivery(workdir + "/old", "f", "2024-01-02", [row(1)])
    assert [d.delivery_date.day for d in load_deliveries(spark, workdir, "f")] == [1]


def _scan_metrics(df):
    """numFiles of the file scans in an executed plan."""
    found = []

    def walk(p):
        ms = p.metrics()
        if ms.contains("numFiles"):
            found.append(ms.apply("numFiles").value())
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_range_reads_only_selected_manifests(spark, workdir):  # partition pruning by file name
    import datetime as dt
    for i in range(60):
        day = dt.date(2023, 1, 1) + dt.timedelta(days=i)
        with open(f"{workdir}/f_{day}.txt", "w") as fh:
            fh.write("x\n")
    df = manifests(spark, workdir, "f", selection(start="2023-02-01", end="2023-02-03")).select("manifest_name")
    assert df.count() == 3
    df.collect()
    assert _scan_metrics(df) == [3]


def test_many_dates_list_once_and_read_only_those(spark, workdir):
    import datetime as dt

    from webfeed.sources.manifest import DIRECT_NAME_DATES
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(DIRECT_NAME_DATES + 20)]
    for day in days:
        with open(f"{workdir}/f_{day}.txt", "w") as fh:
            fh.write("x\n")
    wanted = days[1:DIRECT_NAME_DATES + 10:2] + days[-1:]
    assert len(wanted) > DIRECT_NAME_DATES // 2
    sel = selection(dates=[d.isoformat() for d in days[1:-1] if d in wanted] + [days[-1].isoformat()])
    df = manifests(spark, workdir, "f", sel).select("delivery_date")
    assert sorted(r.delivery_date for r in df.collect()) == sorted(wanted)
    assert _scan_metrics(df) == [len(wanted)]
    many = selection(dates=[d.isoformat() for d in days[:DIRECT_NAME_DATES + 5]])
    got = manifests(spark, workdir, "f", many).select("delivery_date")
    assert sorted(r.delivery_date for r in got.collect()) == days[:DIRECT_NAME_DATES + 5]
    assert _scan_metrics(got) == [DIRECT_NAME_DATES + 5]


def test_manifest_name_without_a_calendar_day(spark, workdir):
    """Month 13 matches the name pattern but is no date: a manifest problem, not a parse crash."""
    from webfeed import read_feed

    write_delivery(workdir, "f", "2024-01-01", [row(1)])
    with open(f"{workdir}/f_2024-13-45.txt", "w") as fh:
        fh.write("junk\n")
    bad = [r for r in manifests(spark, workdir, "f").collect() if r.delivery_date is None]
    assert [(r.manifest_name, "file name has no valid date" in r.problems) for r in bad] == [("f_2024-13-45.txt", True)]
    with pytest.raises(ManifestError, match="f_2024-13-45.txt"):
        read_feed(spark, workdir, "f")
    assert read_feed(spark, workdir, "f", start="2024-01-01", end="2024-01-01").count() == 1
    from webfeed.operators import reports
    assert reports.schema_drift(spark, workdir, "f").count() == 0
    assert [r.missing_date for r in reports.delivery_gaps(spark, workdir, "f").collect()] == []
    assert len(reports.feed_validation(spark, workdir, "f").collect()) == 2
