"""Byte-level BPE encoding and decoding over globally distinct words.

Documents are cut into pre-tokens (matches of the pattern) with their positions, in bundles of
documents of bounded text. A bundle's distinct pre-tokens are shuffled by word, so that each distinct
word of the whole corpus meets in one task and is encoded once; the ids are joined back to the bundles
that hold the word, and every document is reassembled by position. Decoding joins ids to the
token-byte table, whose size is that of the vocabulary: the table is sent to every task and joined there by
place, since a shuffle would move a row for every token of the corpus.

Between the steps a bundle is a few packed rows: its positions as numbers of its own distinct words,
and those words by word bucket. The bundles are written to the checkpoint folder once, so a lost
executor never deals documents to other bundles. Buckets follow ``spark.sql.shuffle.partitions``.

Edge cases: null and empty texts have no ids; every input row gives one output row, also rows that
repeat a doc_id or a whole row; doc_id may be null; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfeed.llm.tables import table, written

#: Text of a bundle (at least one document), and of the batches that leave a task.
BUNDLE_BYTES, OUT_BYTES = 16 << 20, 4 << 20
#: Numbers packed at a time.
AT_ONCE = 1 << 18
#: Compression of packed rows.
LEVEL = 9


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in 7-bit groups (small numbers take one byte), compressed."""
    import zstandard

    out = []
    for lo in range(0, len(values), AT_ONCE):
        v = values[lo:lo + AT_ONCE].astype(np.uint64)
        n = np.ones(len(v), np.int32)
        for bits in (7, 14, 21, 28):
            n += v >= np.uint64(1 << bits)
        at = np.cumsum(n) - n
        raw = np.zeros(int(n.sum()), np.uint8)
        for j in range(int(n.max())):
            has = np.flatnonzero(n > j)
            more = (n[has] > j + 1).astype(np.uint8) << 7
            raw[at[has] + j] = (v[has] >> np.uint64(7 * j)).astype(np.uint8) & 0x7F | more
        out.append(raw.tobytes())
    return zstandard.compress(b"".join(out), LEVEL)


def _unpack(blob: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    out, done = np.zeros(int((raw < 0x80).sum()), np.uint32), 0
    lo = 0
    while lo < len(raw):
        last = np.flatnonzero(raw[lo:lo + AT_ONCE] < 0x80)
        part = raw[lo:lo + int(last[-1]) + 1]  # whole numbers only; one has five bytes at most
        first = np.concatenate([[0], last[:-1] + 1])
        n = last - first + 1
        for j in range(int(n.max())):
            has = np.flatnonzero(n > j)
            out[done + has] |= (part[first[has] + j].astype(np.uint32) & np.uint32(0x7F)) << np.uint32(7 * j)
        lo, done = lo + len(part), done + len(last)
    return out


_PARTS = ["bundle", "bucket", "counts", "values", "extra"]
_PARTS_SQL = "bundle long, bucket int, counts binary, values binary, extra binary"


def _part(bundle: int, bucket: int, counts: bytes, values: bytes, extra: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bundle], pa.int64()), pa.array([bucket], pa.int32()), pa.array([counts], pa.binary()),
         pa.array([values], pa.binary()), pa.array([extra], pa.binary())], names=_PARTS)


class _Numbers(dict):
    """Numbers its keys in the order they are first seen."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _bundles(pattern: str, buckets: int, bundle_bytes: int):
    """Task: texts -> per bundle one row of positions and one row of words for each word bucket."""
    def task(batches: Iterator[pa.RecordBatch]):
        import zlib

        import regex
        import zstandard
        from pyspark import TaskContext

        find = regex.compile(pattern).findall
        base, serial = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        numbers: list[np.ndarray] = []
        local, size = _Numbers(), 0

        def flush():
            nonlocal serial, size, local
            counts = np.fromiter(map(len, numbers), np.int64, len(numbers))
            every = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
            numbers.clear()
            # Frequent words get small numbers, which pack best.
            order = np.argsort(-np.bincount(every, minlength=len(local)), kind="stable")
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            every = number[every]
            words = list(local)
            local = _Numbers()
            found = [words[i].encode("utf-8") for i in order]
            bucket = np.fromiter((zlib.crc32(w) for w in found), np.int64, len(found)) % buckets
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as w:
                w.write_batch(pa.record_batch([pa.array(ids, pa.int64())], names=["doc_id"]))
            name = base + serial
            yield _part(name, -1, _pack(counts), _pack(every), sink.getvalue().to_pybytes())
            yield _part(name, -2, b"", _pack(bucket), None)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                mine = [found[i] for i in order[cut[b]:cut[b + 1]]]
                if mine:
                    lens = np.fromiter(map(len, mine), np.int64, len(mine))
                    yield _part(name, b, _pack(lens), zstandard.compress(b"".join(mine), LEVEL), None)
            serial += 1
            ids.clear()
            size = 0

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                if ids and size + len(text) > bundle_bytes:
                    yield from flush()
                found = find(text)
                ids.append(doc_id)
                numbers.append(np.fromiter(map(local.__getitem__, found), np.int32, len(found)))
                size += len(text)
        if ids:
            yield from flush()
    return task


def _encode_words(ranks, pattern: str):
    """Task: words of a bucket (rows come sorted by bucket) -> their ids; each distinct word is encoded once."""
    def task(batches):
        import tiktoken
        import zstandard

        piece = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={}) \
            ._core_bpe.encode_single_piece
        now, known = None, {}
        for batch in batches:
            for row in range(len(batch)):
                bucket = batch.column("bucket")[row].as_py()
                if bucket != now:
                    now, known = bucket, {}
                raw = zstandard.decompress(batch.column("values")[row].as_py())
                counts, values, at = [], [], 0
                for n in _unpack(batch.column("counts")[row].as_py()).tolist():
                    word = raw[at:at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        known[word] = got = piece(word)
                    counts.append(len(got))
                    values += got
                yield _part(batch.column("bundle")[row].as_py(), bucket, _pack(np.array(counts)),
                            _pack(np.array(values)), None)
    return task


def _reassemble(batches):
    """Task: rows of whole bundles, sorted by bundle and bucket -> ids of every document, in order of position."""
    now, parts = None, {}

    def bundle():
        counts, every, extra = parts[-1]
        docs = pa.ipc.open_stream(extra).read_all().column("doc_id")
        bucket = _unpack(parts[-2][1])
        length, values = np.zeros(len(bucket), np.int64), []
        order = np.argsort(bucket, kind="stable")
        found = sorted(b for b in parts if b >= 0)
        if len(order):
            length[order] = np.concatenate([_unpack(parts[b][0]) for b in found])
            values = np.concatenate([_unpack(parts[b][1]) for b in found])
        start = np.zeros(len(bucket), np.int64)
        start[order] = np.cumsum(length[order]) - length[order]
        per_doc = np.concatenate([[0], np.cumsum(_unpack(counts), dtype=np.int64)])
        every = _unpack(every)
        lo = 0
        while lo < len(docs):
            hi = max(lo + 1, int(np.searchsorted(per_doc, per_doc[lo] + OUT_BYTES // 16, side="right")) - 1)
            mine = every[per_doc[lo]:per_doc[hi]]
            n = length[mine]
            end = np.cumsum(n)
            total = int(end[-1]) if len(end) else 0
            flat = values[np.arange(total) + np.repeat(start[mine] - (end - n), n)] if total else \
                np.zeros(0, np.uint32)
            cut = np.concatenate([[0], end])[per_doc[lo:hi + 1] - per_doc[lo]]
            yield pa.RecordBatch.from_arrays(
                [docs.slice(lo, hi - lo).combine_chunks(), pa.array(np.diff(cut)),
                 pa.array([flat[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)],
                          pa.binary())], names=["doc_id", "n_tokens", "ids"])
            lo = hi

    for batch in batches:
        for row in range(len(batch)):
            name, bucket, counts, values, extra = (batch.column(c)[row].as_py() for c in _PARTS)
            if name != now:
                if parts:
                    yield from bundle()
                now, parts = name, {}
            parts[bucket] = counts, values, extra
    if parts:
        yield from bundle()


def _decoder(tokens):
    """Task: rows with ``ids`` -> the same with their bytes, some OUT_BYTES at a time."""
    def task(batches):
        flat, length = tokens.value
        start = np.cumsum(length) - length
        for batch in batches:
            out, n, lo = [], 0, 0
            for row, blob in enumerate(batch.column("ids")):
                ids = np.frombuffer(blob.as_buffer(), "<u4") if blob.is_valid else np.zeros(0, "<u4")
                k = length[ids]
                end = np.cumsum(k)
                total = int(end[-1]) if len(end) else 0
                out.append(flat[np.arange(total) + np.repeat(start[ids] - (end - k), k)].tobytes())
                n += total + len(ids) * 4
                if n > OUT_BYTES:
                    yield _with(batch.slice(lo, row + 1 - lo), out)
                    lo, out, n = row + 1, [], 0
            if out:
                yield _with(batch.slice(lo), out)
    return task


def _with(batch: pa.RecordBatch, decoded: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                      names=[*batch.schema.names, "decoded"])


def _digests(batches):
    """Rows with ids and decoded bytes -> their SHA-256 digests."""
    import hashlib

    for b in batches:
        sha = [pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in b.column(c)], pa.string())
               for c in ("ids", "decoded")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_tokens"), *sha],
                                         names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _token_bytes(spark: SparkSession, ranks: dict[bytes, int]):
    """The token-byte table, as broad as the vocabulary: all bytes, and the length of each token."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return spark.sparkContext.broadcast(
        (np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)))


def _bundled(docs: DataFrame, ranks: dict[bytes, int], pattern: str, bundle_bytes: int) -> DataFrame:
    """Positions and word ids of whole bundles, sorted by bundle and bucket within partitions."""
    spark = docs.sparkSession
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = spark.sparkContext.broadcast(ranks)  # the vocabulary: a fixed size
    parts = written(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .mapInArrow(_bundles(pattern, buckets, bundle_bytes), _PARTS_SQL), "bundles")
    words = parts.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(_encode_words(sent, pattern), _PARTS_SQL)
    return parts.where("bucket < 0").union(ids).repartition("bundle").sortWithinPartitions("bundle", "bucket")


def encode(docs: DataFrame, ranks_path: str, pattern: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of every text as little-endian unsigned 32-bit integers."""
    return _bundled(docs, read_ranks(ranks_path), pattern, bundle_bytes) \
        .mapInArrow(_reassemble, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of its ``ids``, from the token-byte table."""
    tokens = _token_bytes(encoded.sparkSession, read_ranks(ranks_path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(_decoder(tokens), schema)


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, from its ids and their decoded bytes.

    The steps of :func:`encode` and :func:`decode`; the ids are decoded in the task that reassembled them, so
    neither ids nor bytes leave it.
    """
    ranks = read_ranks(ranks_path)
    decoder = _decoder(_token_bytes(docs.sparkSession, ranks))
    return _bundled(docs, ranks, pattern, bundle_bytes).mapInArrow(
        lambda batches: _digests(decoder(_reassemble(batches))),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark, sf_dir):
    """Every whole text of ``documents`` by the multilingual byte-level ranks."""
    import public_tokenizers as tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          tokenizers.PATTERN)
