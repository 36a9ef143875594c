"""Validation with a ledger: unchanged files are not read, changed ones are."""

import hashlib
import os

import pytest

from helpers import row, write_delivery
from webfeed import read_feed
from webfeed.errors import ValidationError
from webfeed.operators import reports, validate
from webfeed.operators.validate import validation_report
from webfeed.session import new_scratch_path


def overwritten(path):
    """Other content of the same length and modification time."""
    stat = os.stat(path)
    with open(path, "wb") as f:
        f.write(b"\0" * stat.st_size)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def test_unchanged_files_are_not_read_again(spark, workdir):
    ledger = new_scratch_path(spark, "ledger")
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i) for i in range(5)], files=2)
    assert read_feed(spark, workdir, "f", validate=True, ledger=ledger).count() == 10
    first = validation_report(spark, workdir, "f", ledger=ledger).orderBy("file_name").collect()
    overwritten(f"{workdir}/01-f_2024-01-01.tsv.gz")
    overwritten(f"{workdir}/f_2024-01-02-lookup_data.tar.gz")
    assert validation_report(spark, workdir, "f", ledger=ledger).orderBy("file_name").collect() == first
    assert all(r.ok for r in first) and len(first) == 6
    full = validation_report(spark, workdir, "f", ledger=ledger, full=True).where("NOT ok").collect()
    assert sorted(r.file_name for r in full) == ["01-f_2024-01-01.tsv.gz", "f_2024-01-02-lookup_data.tar.gz"]
    # what a full validation found replaces what the ledger said
    assert validation_report(spark, workdir, "f", ledger=ledger).where("NOT ok").count() == 2


def test_only_changed_files_are_read(spark, workdir, monkeypatch):
    ledger = new_scratch_path(spark, "ledger")
    asked = []
    digests = validate.file_digests
    monkeypatch.setattr(validate, "file_digests", lambda *a: asked.append(sorted(a[-1])) or digests(*a))
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i) for i in range(5)], files=2)
    validation_report(spark, workdir, "f", ledger=ledger)
    write_delivery(workdir, "f", "2024-01-02", [row(i) for i in range(7)], files=2)
    os.utime(f"{workdir}/f_2024-01-02-lookup_data.tar.gz", (10 ** 9, 10 ** 9))
    assert all(r.ok for r in validation_report(spark, workdir, "f", ledger=ledger).collect())
    assert all(r.ok for r in validation_report(spark, workdir, "f", ledger=ledger).collect())
    assert [len(a) for a in asked] == [6, 3] and all("2024-01-02" in n for n in asked[1])


def test_a_corrected_manifest_needs_no_content(spark, workdir):
    ledger = new_scratch_path(spark, "ledger")
    write_delivery(workdir, "f", "2024-01-01", [row(1)], manifest_edit=lambda m: m["data"][0].update(md5="0" * 32))
    with pytest.raises(ValidationError, match="md5"):
        read_feed(spark, workdir, "f", validate=True, ledger=ledger)
    with open(f"{workdir}/01-f_2024-01-01.tsv.gz", "rb") as f:
        right = hashlib.md5(f.read()).hexdigest()
    with open(f"{workdir}/f_2024-01-01.txt") as f:
        text = f.read()
    with open(f"{workdir}/f_2024-01-01.txt", "w") as f:
        f.write(text.replace("0" * 32, right))
    from webfeed.operators.ledger import entries
    before = entries(spark, ledger).count()
    assert read_feed(spark, workdir, "f", validate=True, ledger=ledger).count() == 1
    assert entries(spark, ledger).count() == before == 2


def test_records_are_counted_when_first_asked_for(spark, workdir):
    ledger = new_scratch_path(spark, "ledger")
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(5)])
    digests = reports.delivery_digests(spark, workdir, "f", ledger=ledger).collect()
    assert [(r.n_files, len(r.digest)) for r in digests] == [(2, 32)]
    got = {r.kind: r for r in validation_report(spark, workdir, "f", ledger=ledger).collect()}
    assert got["data"].ok and got["data"].actual_records == 5 and got["lookup"].ok


def test_delivery_digests_tell_changed_deliveries(spark, workdir):
    def digests():
        return {r.delivery_date.day: r.digest for r in reports.delivery_digests(spark, workdir, "f").collect()}
    for d in (1, 2):
        write_delivery(workdir, "f", f"2024-01-0{d}", [row(i) for i in range(5)], files=2)
    before = digests()
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(6)], files=2)
    after = digests()
    assert before[2] == after[2] and before[1] != after[1]


def test_missing_and_empty_files(spark, workdir):
    ledger = new_scratch_path(spark, "ledger")
    write_delivery(workdir, "f", "2024-01-01", [row(i) for i in range(4)], files=2, skip_files=(1,))
    open(f"{workdir}/01-f_2024-01-01.tsv.gz", "wb").close()
    got = [[(r.file_name, r.file_exists, r.actual_size, r.actual_md5, r.actual_records) for r in
            validation_report(spark, workdir, "f", ledger=x).orderBy("file_name").collect()] for x in (None, ledger, ledger)]
    assert got[0] == got[1] == got[2]
    assert got[0][0][1:] == (True, 0, validate.EMPTY_MD5, 0) and got[0][1][1:] == (False, None, None, None)
