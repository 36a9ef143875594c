"""Content-addressed WARC archive.

Pages are archived as WARC/1.0 records in two tables of a folder: ``payloads`` holds the bytes of every distinct
payload once, under its SHA-256; ``headers`` holds the exact header of each record with that address. A join
of the two gives the original records back, byte for byte; every payload that is read is hashed again, and a
payload that does not fit its address, or whose SHA-1 is not the one its record's header names, is an error.

Of records with equal payloads (of at least ``min_bytes``) the one with the largest page_id is a ``response``
with the payload in its block; the others are ``revisit`` records that refer to it. Smaller payloads are
responses all. ``write_files`` writes records as gzipped WARC files, ``read_files`` reads such files.

A payload that very many pages share is one row of ``payloads``: it is reduced in the tasks that read the
pages before anything is shuffled, and joined to plain tables whose hot keys Spark can split.

Edge cases: null html is an empty payload; null page_id is smaller than any other, and a revisit of such a
response refers to null; of rows that repeat page_id and payload one is the response, the others revisit it; null
urls have no target field, control characters in urls are percent-encoded in the header; other columns are ignored;
an empty table gives an empty archive.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webfeed.llm.tables import table, written
from webfeed.session import new_scratch_path

MIN_BYTES = 0
#: WARC-Date of the records: the pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
#: Bytes of records that a WARC file holds, about.
FILE_BYTES = 256 << 20

# Fixed values of the format.
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(sha1_hex: Column) -> Column:
    """The 160 bits of a hexadecimal SHA-1 in upper-case base32: 20 bits, 4 digits, at a time."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _payloads(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload")).withColumn("address", F.sha2("payload", 256))


def _http(n: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n.cast("string"),
                    F.lit(_END))


def _record_id(page_id: Column, record: Column, address: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), record.cast("string"), address))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _headers(facts: DataFrame, best: DataFrame, min_bytes: int, date: str) -> DataFrame:
    """(record, page_id, address, header): the header of every record, with the HTTP header that begins its block."""
    rows = facts.join(best, "address", "left")
    revisit = (F.col("n") >= min_bytes) & (F.col("record") != F.col("top.record"))
    url = F.col("url")
    for code in [*range(32), 127]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    field = lambda name, value: F.concat(F.lit(name + ": "), value)
    http = _http(F.col("n"))
    digest = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    lines = [
        F.lit("WARC/1.0"), field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("record"), F.col("address"))),
        field("WARC-Date", F.lit(date)), field("WARC-Target-URI", url),
        field("WARC-Page-ID", F.col("page_id").cast("string")),
        field("WARC-Payload-Digest", digest), field("WARC-Payload-Length", F.col("n").cast("string")),
        F.when(revisit, field("WARC-Profile", F.lit(_PROFILE))),
        F.when(revisit, field("WARC-Refers-To", _record_id(F.col("top.page_id"), F.col("top.record"), F.col("address")))),
        F.when(revisit, field("WARC-Refers-To-Page-ID", F.col("top.page_id").cast("string"))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))).cast("string")),
    ]
    return rows.select("record", "page_id", "address", F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), http).alias("header"))


def archive(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as the tables ``headers`` and ``payloads`` of ``folder``."""
    spark = pages.sparkSession
    rows = _payloads(pages)
    # Numbers of rows are written before they are used twice.
    facts = written(spark, rows.select(
        F.monotonically_increasing_id().alias("record"), "page_id", "url", "address", F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("n")), "facts")
    last = F.struct("page_id", "record")
    best = facts.groupBy("address").agg(
        F.max(last).alias("top"), F.min("sha1").alias("sha1"), F.max("sha1").alias("other"),
        F.min("n").alias("n"), F.max("n").alias("most"))
    same = F.when((F.col("sha1") == F.col("other")) & (F.col("n") == F.col("most")), F.col("top")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads share the address "), F.col("address"))))
    best = written(spark, best.select("address", same.alias("top")), "best")
    _headers(facts, best, min_bytes, date).write.parquet(folder + "/headers")
    rows.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(folder + "/payloads")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(record, page_id, header, payload, content): the original records of an archive.

    ``content`` is the record as a WARC file has it (without the two line ends that follow a record), ``payload`` the
    page's whole payload, also of revisits.
    """
    headers, payloads = (spark.read.parquet(f"{folder}/{t}") for t in ("headers", "payloads"))
    checked = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("the payload does not fit its address "), F.col("address"))))
    rows = headers.join(payloads.select("address", checked.alias("payload")), "address", "left")
    found = F.coalesce("payload", F.raise_error(F.concat(F.lit("no payload has the address "), F.col("address"))).cast("string"))
    rows = rows.select("record", "page_id", "header", found.alias("payload"))
    whole = F.when(_field("header", "WARC-Type") == "revisit", F.col("header")).otherwise(F.concat("header", "payload"))
    return rows.withColumn("content", whole)


def _field(header: str, name: str) -> Column:
    """The value of a field of a WARC header, or null."""
    value = F.regexp_extract(header, rf"(?m)\AWARC/1\.0\r\n(?:[^\r\n]+\r\n)*?{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_back(rows: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from records (header, payload).

    The digest is that of the payload read; a header that names another one is an error.
    """
    digest = base32(F.sha1("payload"))
    fits = (_field("header", "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) \
        & (_field("header", "WARC-Payload-Length") == F.octet_length("payload").cast("string"))
    kind = F.when(fits, _field("header", "WARC-Type")).otherwise(F.raise_error(F.concat(
        F.lit("a payload differs from its record "), _field("header", "WARC-Record-ID"))))
    return rows.select(
        _field("header", "WARC-Page-ID").cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"), kind.alias("record_type"),
        _field("header", "WARC-Refers-To-Page-ID").cast("long").alias("refers_to"))


def write_files(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Records (``content``) as gzipped WARC files of about ``file_bytes`` bytes of records, by Spark's text writer.

    A record is a line whose end is the two line ends of the format.
    """
    size = rows.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    rows.repartition(max(1, -(-size // file_bytes))).select("content") \
        .write.option("lineSep", _END).option("compression", "gzip").text(folder)


def _parsed(batches):
    """Task: files -> their records, by the lengths that the headers give."""
    import gzip
    import io
    import re

    for b in batches:
        for blob in b.column("content"):
            data = io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(blob.as_buffer())))
            while True:
                head = b""
                while not head.endswith(b"\r\n\r\n"):
                    line = data.readline()
                    if not line:
                        break
                    head += line
                if not head:
                    break
                length = re.search(rb"(?i)\r\nContent-Length: *(\d+)", head)
                if not head.startswith(b"WARC/1.0\r\n") or not length:
                    raise ValueError(f"no WARC record begins with {head[:40]!r}")
                block = data.read(int(length[1]))
                http, _, payload = block.partition(b"\r\n\r\n")
                if len(block) != int(length[1]) or data.read(4) != b"\r\n\r\n":
                    raise ValueError("a WARC record ends too early")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([head + http + b"\r\n\r\n"], pa.binary()), pa.array([payload], pa.binary())],
                    names=["header", "block_payload"])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(header, payload): the records of the WARC files that :func:`write_files` wrote; a task reads a file.

    The payload of a revisit is that of the response it refers to.
    """
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content") \
        .mapInArrow(_parsed, "header binary, block_payload binary") \
        .select(F.col("header").cast("string").alias("header"), F.col("block_payload").cast("string").alias("own"))
    rows = rows.select("*", _field("header", "WARC-Record-ID").alias("id"), _field("header", "WARC-Refers-To").alias("to"))
    rows = written(rows.sparkSession, rows, "warc-records")
    kept = rows.where(F.col("to").isNull()).select(F.col("id").alias("to"), F.col("own").alias("payload"))
    return rows.where(F.col("to").isNull()).select("header", F.col("own").alias("payload")) \
        .union(rows.where(F.col("to").isNotNull()).drop("own").join(kept, "to", "left").select("header", "payload"))


def op13_warc(spark, sf_dir):
    """Every page of ``pages`` archived, and read back from the archive."""
    folder = new_scratch_path(spark, "warc")
    archive(table(spark, sf_dir, "pages"), folder)
    return read_back(records(spark, folder))


def _oracle() -> str:
    bits = " || ".join(
        f"substr('{_BASE32}', 1 + CAST((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER), 1)"
        for i in range(8) for s in (15, 10, 5, 0))
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    s AS (SELECT *, sha1(payload) AS h, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS k,
                 max(page_id) OVER (PARTITION BY payload) AS top FROM p)
    SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {bits} AS payload_digest,
           CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN k > 1 THEN top END AS refers_to
    FROM s"""


ORACLE_SQL = _oracle()
