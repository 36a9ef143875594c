"""Archive member extraction: lines of named members of lookup archives.

Archives are read with Spark's ``binaryFile`` source and unpacked in Python
workers (``mapInArrow``), one archive at a time, in parallel across archives.
Archives of up to ``INLINE_MAX_BYTES`` (their real length) come as ``binaryFile``
content, many per task; bigger ones are never loaded whole: the task streams
them from storage, with the cluster's settings of that store. In a store that
tasks do not know, archives of all sizes come as content. Both are opened by the same code, which tells the compression
(gzip, bzip2, xz or none) from the first bytes. Decompression stops as soon as
every wanted member has been read (or ``max_lines`` of it). Output rows are
single lines, emitted in bounded Arrow batches, so a large member never becomes
one giant cell.

Schema: ``archive_name string, member string, line_no int, line string``; the
name is the archive's path relative to the delivery folder. Rows without a line:
``line_no = -1`` for a wanted member that the archive lacks, ``-2`` with the error
text for each wanted member not read to its end because the archive cannot be
unpacked, ``-3`` for an empty member, ``-4`` for an archive that does not exist.
Callers report these.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import TaskFolder, task_folder
from .files import Files

LINES_SCHEMA = "archive_name string, member string, line_no int, line string"
_ARROW_SCHEMA = pa.schema([("archive_name", pa.string()), ("member", pa.string()),
                           ("line_no", pa.int32()), ("line", pa.string())])
_BATCH_LINES = 8192
ABSENT, DAMAGED, EMPTY, MISSING = -1, -2, -3, -4
INLINE_MAX_BYTES = 64 * 1024 * 1024
#: What Spark can give as content of a file.
MAX_CONTENT = (1 << 31) - 1
_READ_BUFFER = 8 * 1024 * 1024


def _decompressed(raw):
    """The tar stream of an archive, by its first bytes."""
    import bz2
    import gzip
    import lzma

    start = raw.read(6)
    raw.seek(0)
    if start[:2] == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=raw)
    if start[:3] == b"BZh":
        return bz2.BZ2File(raw)
    return lzma.LZMAFile(raw) if start == b"\xfd7zXZ\x00" else raw


def _member_lines(data: bytes | None, wanted: frozenset[str], max_lines: int | None = None,
                  opened=None) -> Iterator[tuple[str, int, str | None]]:
    """(member, line_no, line) for wanted members of one archive (at most ``max_lines``
    lines each); ``ABSENT`` rows for missing members, ``DAMAGED`` rows when unpacking fails.

    The archive is ``data`` (its bytes) or, when that is None, the file that ``opened`` opens.
    """
    import contextlib
    import io
    import itertools
    import lzma
    import tarfile
    import zlib

    seen: set[str] = set()
    done: set[str] = set()
    try:
        with contextlib.ExitStack() as stack:
            if data is not None:
                raw = io.BytesIO(data)
            else:
                raw = io.BufferedReader(stack.enter_context(opened()), _READ_BUFFER)
            # a decompressed stream still seeks forward, which is all reading members in order needs
            tar = stack.enter_context(tarfile.open(fileobj=_decompressed(raw), mode="r:"))
            for info in tar:
                name = info.name[2:] if info.name.startswith("./") else info.name
                if name not in wanted or name in seen or not info.isfile():
                    continue
                seen.add(name)
                # streamed line by line; LF, CR LF and a lone CR all end a line
                member = io.TextIOWrapper(tar.extractfile(info), encoding="utf-8", errors="replace", newline=None)
                i = -1
                for i, line in enumerate(itertools.islice(member, max_lines)):
                    yield name, i, line[:-1] if line.endswith("\n") else line
                if i < 0:
                    yield name, EMPTY, None
                done.add(name)
                if seen == wanted:
                    break
    except (tarfile.TarError, EOFError, OSError, ValueError, lzma.LZMAError, zlib.error) as e:
        for name in sorted(wanted - done):
            yield name, DAMAGED, f"{type(e).__name__}: {e}"
        return
    for name in sorted(wanted - seen):
        yield name, ABSENT, None


def _extractor(wanted: frozenset[str], max_lines: int | None, folder: TaskFolder | None):
    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buf: dict[str, list] = {"archive_name": [], "member": [], "line_no": [], "line": []}

        def flush():
            out = pa.RecordBatch.from_pydict(buf, schema=_ARROW_SCHEMA)
            for v in buf.values():
                v.clear()
            return out

        for batch in batches:
            contents = batch.column("content") if "content" in batch.schema.names else None
            for i, name in enumerate(batch.column("archive_name").to_pylist()):
                data = contents[i].as_py() if contents is not None else None
                opened = functools.partial(folder.open, name, seekable=True) if contents is None else None
                for member, line_no, line in _member_lines(data, wanted, max_lines, opened):
                    buf["archive_name"].append(name)
                    buf["member"].append(member)
                    buf["line_no"].append(line_no)
                    buf["line"].append(line)
                    if len(buf["line"]) >= _BATCH_LINES:
                        yield flush()
        if buf["line"]:
            yield flush()

    return extract


def archive_lines(spark: SparkSession, directory: str, archive_names: list[str],
                  members: Iterable[str], max_lines: int | None = None,
                  inline_max_bytes: int = INLINE_MAX_BYTES, lengths: dict[str, int] | None = None) -> DataFrame:
    """Lines of ``members`` in each named archive of ``directory`` (lazy); with
    ``max_lines``, unpacking stops after that many lines of each member. ``lengths``: those of
    archives that a validation has just found to be as listed (saves the job that asks for them).
    """
    wanted = frozenset(members)
    files = Files(spark, directory, sorted(set(archive_names)), spark.read.format("binaryFile").load)
    folder = task_folder(spark, directory)
    limit = MAX_CONTENT if folder is None else inline_max_bytes
    extract = _extractor(wanted, max_lines, folder)
    name, length = files.name().alias("archive_name"), F.col("length")
    sizes = files.select(name, "length") if lengths is None else None  # one row per archive, no content read
    real = {r.archive_name: r.length for r in sizes.collect()} if sizes is not None else dict(lengths or {})
    rows = [(n, m, MISSING, None) for n in files.missing(archive_names) for m in sorted(wanted)]
    rows += [(n, m, DAMAGED, "empty file") for n in sorted(set(files.exist) - set(real)) for m in sorted(wanted)]
    parts = [spark.createDataFrame(rows, LINES_SCHEMA)] if rows or not real else []
    if any(n <= limit for n in real.values()):
        small = files.select(name, "content", where=length <= limit)
        parts.append(small.mapInArrow(extract, LINES_SCHEMA))
    if any(n > limit for n in real.values()):
        # only the names: the scan reads no content; a big file gets a task of its own
        parts.append(files.select(name, where=length > limit).mapInArrow(extract, LINES_SCHEMA))
    return reduce(lambda a, b: a.unionByName(b), parts)
