import pytest

from helpers import row, write_delivery
from webfeed import read_lookup
from webfeed.errors import DeliveryError, FeedOptionError, ManifestError, ValidationError
from webfeed.sources.reader import FeedReader

LOOKUPS = {"browser.tsv": "1\tFirefox\n2\tChrome\n", "event.tsv": "1\tPurchase\n200\tCustom 1\n"}


def test_requested_lookup_is_returned(spark, workdir):  # S7, X3
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS)
    df = read_lookup(spark, workdir, "f", "event.tsv")
    assert df.columns == ["lookup_key", "lookup_value"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "Purchase"), ("200", "Custom 1")]


def test_most_recent_delivery_wins(spark, workdir):  # M7, X4
    for d, name in ((3, "Old"), (9, "Newest"), (5, "Mid")):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(1)], lookups={"browser.tsv": f"1\t{name}\n"})
    assert read_lookup(spark, workdir, "f", "browser.tsv").collect()[0].lookup_value == "Newest"
    got = read_lookup(spark, workdir, "f", "browser.tsv", dates="2024-01-03,2024-01-05").collect()
    assert got[0].lookup_value == "Mid"


def test_csv_semantics_of_lookup_lines(spark, workdir):
    text = "k1\tv1\r\nk2\n\n  \nk3\tv3\textra\nk4\t\"quoted\tvalue\"\n"
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups={"country.tsv": text})
    got = sorted(tuple(r) for r in read_lookup(spark, workdir, "f", "country.tsv").collect())
    assert got == [("k1", "v1"), ("k2", None), ("k3", "v3"), ("k4", "quoted\tvalue")]


def test_lookup_member_with_dot_slash(spark, workdir):
    write_delivery(workdir, "f", "2024-01-01", [row(1)],
                   archive_members={"./column_headers.tsv": b"a\n", "./plugins.tsv": b"1\tFlash\n"})
    assert read_lookup(spark, workdir, "f", "plugins.tsv").collect()[0].lookup_value == "Flash"


def test_missing_member_is_an_error(spark, workdir):  # X8
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS)
    with pytest.raises(Exception, match="no member resolution.tsv"):
        read_lookup(spark, workdir, "f", "resolution.tsv").collect()


def test_unknown_lookup_name(spark, workdir):  # V11, X14
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS)
    with pytest.raises(FeedOptionError, match="did you mean 'event.tsv'"):
        read_lookup(spark, workdir, "f", "events.tsv")


def test_two_archives_rejected(spark, workdir):  # V7
    def edit(m):
        m["lookups"].append(dict(m["lookups"][0]))
        m["n_lookup"] = 2
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS, manifest_edit=edit)
    with pytest.raises(ManifestError):
        read_lookup(spark, workdir, "f", "event.tsv")


def test_validate_checks_digests_not_rows(spark, workdir):
    def edit(m):
        m["total"] += 5  # rows are not checked for lookups
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS, manifest_edit=edit)
    assert read_lookup(spark, workdir, "f", "event.tsv", validate=True).count() == 2

    def bad(m):
        m["lookups"][0]["md5"] = "f" * 32
    write_delivery(workdir, "f", "2024-01-02", [row(1)], lookups=LOOKUPS, manifest_edit=bad)
    with pytest.raises(ValidationError, match="md5"):
        read_lookup(spark, workdir, "f", "event.tsv", validate=True)


def test_option_reader(spark, workdir):  # S1 option surface
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups=LOOKUPS)
    write_delivery(workdir, "f", "2024-01-02", [row(2)], lookups=LOOKUPS)
    r = FeedReader(spark).option("dir", workdir).option("feedName", "f")
    assert r.load("browser.tsv").count() == 2
    assert FeedReader(spark).options(dir=workdir, feedname="f", date="2024-01-02").load().count() == 1
    assert FeedReader(spark).options(dir=workdir, feedname="f", dates="2024-01-01,2024-01-02",
                                     validate=True).load().count() == 2


def test_big_archives_are_streamed(spark, workdir):
    """Archives above the inline size are streamed by the task; same lines as in memory."""
    from webfeed.sources.archive import archive_lines

    lines = "".join(f"{i}\tvalue {i}\r\n" for i in range(20000))
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups={"event.tsv": lines, "browser.tsv": "1\tx\n"})
    write_delivery(workdir, "f", "2024-01-02", [row(2)], lookups={"event.tsv": "9\tz\n"})
    with open(f"{workdir}/f_2024-01-02-lookup_data.tar.gz", "wb") as fh:
        fh.write(b"\x1f\x8b broken")
    archives = ["f_2024-01-01-lookup_data.tar.gz", "f_2024-01-02-lookup_data.tar.gz"]
    wanted = ["event.tsv", "column_headers.tsv", "plugins.tsv"]

    def lines_of(**kw):
        df = archive_lines(spark, workdir, archives, wanted, **kw)
        return sorted((r.archive_name, r.member, r.line_no, r.line if r.line_no >= -1 else "x") for r in df.collect())

    inline, streamed = lines_of(), lines_of(inline_max_bytes=0)
    assert streamed == inline
    assert len([r for r in streamed if r[1] == "event.tsv" and r[0].startswith("f_2024-01-01")]) == 20000
    assert ("f_2024-01-01-lookup_data.tar.gz", "plugins.tsv", -1, None) in streamed
    assert {r[1] for r in streamed if r[2] == -2} == set(wanted)
    assert lines_of(inline_max_bytes=0, max_lines=1) == lines_of(max_lines=1)


def test_compression_is_told_from_content_on_both_sides_of_the_inline_size(spark, workdir):
    """gzip, bzip2, xz and plain tar named .tar.gz, an empty file and a missing one."""
    import bz2
    import gzip
    import lzma

    from helpers import tar_gz
    from webfeed.sources.archive import DAMAGED, EMPTY, MISSING, archive_lines

    packed = tar_gz({"event.tsv": b"1\tA\n2\tB\n", "plugins.tsv": b""})
    plain = gzip.decompress(packed)
    for name, data in (("gz", packed), ("bz2", bz2.compress(plain)), ("xz", lzma.compress(plain)), ("tar", plain),
                       ("zero", b"")):
        with open(f"{workdir}/{name}.tar.gz", "wb") as fh:
            fh.write(data)
    names = [f"{n}.tar.gz" for n in ("gz", "bz2", "xz", "tar", "zero", "gone")]
    got = [sorted((r.archive_name, r.member, r.line_no, r.line) for r in archive_lines(
        spark, workdir, names, ["event.tsv", "plugins.tsv"], inline_max_bytes=m).collect()) for m in (1 << 20, 0)]
    assert got[0] == got[1]
    for n in names[:4]:
        assert [r[1:] for r in got[0] if r[0] == n] == [
            ("event.tsv", 0, "1\tA"), ("event.tsv", 1, "2\tB"), ("plugins.tsv", EMPTY, None)]
    assert {r[2] for r in got[0] if r[0] == names[4]} == {DAMAGED}
    assert {r[2] for r in got[0] if r[0] == names[5]} == {MISSING}


def test_unknown_storage_is_refused_by_name(monkeypatch):
    from webfeed.session import check_streamable, task_file_system

    with pytest.raises(DeliveryError, match="dbfs"):
        check_streamable("dbfs:/feeds/x.tar.gz")
    with pytest.raises(OSError, match="dbfs"):
        task_file_system("dbfs:/feeds/x.tar.gz")
    for known in ("file:/a/b", "/a/b", "s3a://bucket/x", "hdfs://host/x", "hdfs:/x"):
        check_streamable(known)


def test_an_older_delivery_with_two_archives_does_not_matter(spark, workdir):  # W4, V7
    def twice(m):
        m["lookups"] *= 2
        m["n_lookup"] = 2
    write_delivery(workdir, "f", "2024-01-01", [row(1)], lookups={"event.tsv": "1\tA\n"}, manifest_edit=twice)
    write_delivery(workdir, "f", "2024-01-02", [row(2)], lookups={"event.tsv": "1\tB\n"})
    assert [tuple(r) for r in read_lookup(spark, workdir, "f", "event.tsv").collect()] == [("1", "B")]
    with pytest.raises(ManifestError, match="2 lookup archives"):
        read_lookup(spark, workdir, "f", "event.tsv", date="2024-01-01")
