"""One pass over a data file: digest and record count against the digest and Spark's own CSV counts."""

import gzip
import hashlib
import os
import random
import zlib

import pytest

from webfeed.functions import records
from webfeed.plans.scan import CSV_OPTIONS


def content(rng):
    pieces = [b"a\tb", b"\n", b"\r\n", b"\r", b'"x\ny"', b"   ", b"\t", b'"', b"\\", b"\x00", b"\x1f", b"\x7f", b"\xc3\xa9",
              b"\xff", b"\xef\xbb\xbf", b"\n\n", b"#c", b",", b"long " * 50]
    return b"".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60)))


def counted(data, gzipped, size):
    return records.checked([data[i:i + size] for i in range(0, len(data), size)], gzipped)


def spark_counts(spark, folder, tolerant="false"):
    files = spark.read.schema("_c0 string").options(**CSV_OPTIONS).option("ignoreCorruptFiles", tolerant).csv(folder)
    return {r.n: r["count"] for r in files.select("_metadata.file_name").withColumnRenamed("file_name", "n")
            .groupBy("n").count().collect()}


def write(folder, bodies, suffix):
    os.makedirs(folder)
    for i, body in enumerate(bodies):
        with open(f"{folder}/{i}{suffix}", "wb") as f:
            f.write(body)


@pytest.mark.parametrize("gzipped", [True, False])
def test_counts_equal_sparks(spark, workdir, gzipped):
    rng = random.Random(7)
    bodies = [content(rng) for _ in range(150)] + [b"\xef\xbb\xbf", b"\xef\xbb", b"\xef\xbb\xbf\n", b"a", b"\n", b" \r \n\r", b"a\r"]
    bodies = [b for b in bodies if b]
    packed = [gzip.compress(b) if gzipped else b for b in bodies]
    # several members, an empty one among them, and optional header fields
    if gzipped:
        packed += [gzip.compress(b"a\nb") + gzip.compress(b"") + gzip.compress(b"c\n\nd\n")]
        head = b"\x1f\x8b\x08\x1e" + b"\0" * 6 + b"\x03\0abc" + b"name\0" + b"note\0"
        head += (zlib.crc32(head) & 0xFFFF).to_bytes(2, "little")
        raw = zlib.compressobj(9, zlib.DEFLATED, -15)
        text = b"x\ny\n"
        body = raw.compress(text) + raw.flush()
        packed += [head + body + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")]
    suffix = ".tsv.gz" if gzipped else ".tsv"
    write(f"{workdir}/f", packed, suffix)
    expected = spark_counts(spark, f"{workdir}/f")
    for i, b in enumerate(packed):
        for size in (1, 7, 1 << 20):
            md5, length, n = counted(b, gzipped, size)
            assert (md5, length) == (hashlib.md5(b).hexdigest(), len(b))
            assert n == expected.get(f"{i}{suffix}", 0), (i, size)


def test_truncated_files_have_the_records_before_the_damage(spark, workdir):
    rng = random.Random(3)
    lines = [("%d\t%s" % (i, "x" * rng.randrange(60))).encode() for i in range(4000)]
    whole = gzip.compress(b"\n".join(lines) + b"\n")
    cut = [whole[:n] for n in (len(whole) - 1, len(whole) - 9, len(whole) // 2, len(whole) // 3, 400, 12, 5)]
    write(f"{workdir}/f", cut, ".tsv.gz")
    expected = spark_counts(spark, f"{workdir}/f", "true")
    for i, b in enumerate(cut):
        got = [counted(b, True, size)[2] for size in (1, 4096, 1 << 20)]
        assert len(set(got)) == 1
        assert abs(got[0] - expected.get(f"{i}.tsv.gz", 0)) <= 1, (i, got)


def test_damage_in_the_middle(spark):
    text = b"".join(b"%d line\n" % (i * 7919 % 100_003) for i in range(20_000))
    whole = bytearray(gzip.compress(text))
    for change in (b"\x00\x00\xff\xff\x13\x37" * 4, b""):
        bad = bytes(whole[:len(whole) // 2]) + change + bytes(whole[len(whole) // 2 + (0 if change else 5):])
        md5, length, n = counted(bad, True, 1 << 16)
        assert md5 == hashlib.md5(bad).hexdigest() and length == len(bad) and n <= 20_001
        assert n == counted(bad, True, 1000)[2]
    wrong_sum = bytes(whole[:-8]) + b"\0" * 8
    assert counted(wrong_sum, True, 999)[2] == 20_000
    assert counted(bytes(whole) + b"rubbish", True, 999)[2] == 20_000
    assert counted(b"no gzip at all\n", True, 3)[2] == 0
