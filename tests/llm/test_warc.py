"""The content-addressed archive: results, exact round trips, damage, files."""

import base64
import gzip
import hashlib
import os
from collections import defaultdict

import pytest

from llm_cases import rows_of
from webfeed.llm import warc
from webfeed.session import new_scratch_path

SCHEMA = "page_id long, url string, html string, record long, header string, payload string, address string, n long"
PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/4", ""),
         (5, "u\r\nInjected: 1\t", "y\r\n\r\nWARC/1.0\r\nWARC-Type: revisit\r\n\r\n"), (6, "http://é/6", "é中\x00 z"),
         (2, "http://a/2", "<p>x</p>"), (7, "http://a/7", "long " * 50_000), (8, "http://a/8", "long " * 50_000),
         (None, "http://a/n", "null"), (None, "http://a/n", "null"), (-9, "http://a/9", "WARC-Page-ID: 12\r\n")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", "p", "a", 7) for r in rows], SCHEMA).repartition(3)


def brute(rows, min_bytes=0):
    same = defaultdict(list)
    for page_id, _, html in rows:
        same[html or ""].append(page_id)
    out = []
    for text, ids in same.items():
        raw = text.encode()
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            again = k > 0 and len(raw) >= min_bytes
            out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                        "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 9])
def test_against_brute_force(spark, min_bytes):
    folder = new_scratch_path(spark, "warc-test")
    warc.archive(frame(spark, PAGES), folder, min_bytes=min_bytes)
    assert rows_of(warc.read_back(warc.records(spark, folder))) == brute(PAGES, min_bytes)


def test_records_are_exact_and_payloads_stored_once(spark):
    folder = new_scratch_path(spark, "warc-test")
    warc.archive(frame(spark, PAGES), folder)
    stored = [r["payload"] for r in spark.read.parquet(folder + "/payloads").collect()]
    assert sorted(stored) == sorted({h or "" for _, _, h in PAGES})
    rows = warc.records(spark, folder).collect()
    assert sorted((r["page_id"] or 0, r["payload"]) for r in rows) == sorted((i or 0, h or "") for i, _, h in PAGES)
    ids = set()
    for r in rows:
        head, _, block = r["content"].encode().partition(b"\r\n\r\n")
        fields = [f.split(b": ", 1) for f in head.split(b"\r\n")[1:]]
        known = dict(fields)
        assert head.startswith(b"WARC/1.0\r\n") and len(fields) == len(known)
        assert int(known[b"Content-Length"]) == len(block)
        http, _, payload = block.partition(b"\r\n\r\n")
        assert payload == (b"" if known[b"WARC-Type"] == b"revisit" else r["payload"].encode())
        assert (b"WARC-Refers-To" in known) == (known[b"WARC-Type"] == b"revisit")
        ids.add(known[b"WARC-Record-ID"])
    assert len(ids) == len(PAGES)


def test_damaged_payloads_are_errors(spark):
    folder = new_scratch_path(spark, "warc-test")
    warc.archive(frame(spark, PAGES), folder)
    good = spark.read.parquet(folder + "/payloads").collect()
    for change in ("swap", "drop"):
        bad = new_scratch_path(spark, "warc-bad")
        spark.read.parquet(folder + "/headers").write.parquet(bad + "/headers")
        rows = [(r["address"], "changed" if change == "swap" and i == 2 else r["payload"]) for i, r in enumerate(good)]
        spark.createDataFrame(rows[1:] if change == "drop" else rows, "address string, payload string") \
            .write.parquet(bad + "/payloads")
        with pytest.raises(Exception, match="does not fit its address|no payload has the address"):
            warc.read_back(warc.records(spark, bad)).collect()
    rows = warc.records(spark, folder)
    with pytest.raises(Exception, match="a payload differs from its record"):
        warc.read_back(rows.selectExpr("header", "payload || '!' AS payload")).collect()


def test_warc_files(spark):
    folder, files = new_scratch_path(spark, "warc-test"), new_scratch_path(spark, "warc-files")
    warc.archive(frame(spark, PAGES), folder)
    rows = warc.records(spark, folder)
    warc.write_files(rows, files, file_bytes=100_000)
    got = warc.read_files(spark, files)
    assert rows_of(got) == rows_of(rows.select("header", "payload"))
    assert rows_of(warc.read_back(got)) == brute(PAGES)
    local = files.removeprefix("file:")
    whole = b"".join(gzip.open(os.path.join(local, f)).read() for f in sorted(os.listdir(local)) if f.endswith(".gz"))
    assert whole.count(b"WARC/1.0\r\nWARC-Type: ") == len(PAGES) + 1  # one stands in a payload
    assert len([f for f in os.listdir(local) if f.endswith(".gz")]) > 1


def test_empty_table(spark):
    folder = new_scratch_path(spark, "warc-test")
    warc.archive(frame(spark, PAGES).limit(0), folder)
    assert warc.read_back(warc.records(spark, folder)).count() == 0
