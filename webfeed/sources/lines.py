"""Hit records as lines, read by tasks: files come as rows of a table, not as paths on the driver.

A task opens its files one after another, decodes them in bounded pieces and returns the records of
Spark's line-based CSV reader (:mod:`webfeed.functions.records`), numbered within their file. The lines are
parsed in the JVM by ``from_csv`` with the settings of a read, so both ways of reading give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import records
from ..session import TaskFolder

#: Bytes read from storage at a time, and tasks that read one file.
READ_BYTES, MOST_PARTS = 1 << 20, 8


def lines_of(data: bytes) -> pa.StringArray:
    """Non-blank lines of bytes that end with a line end."""
    raw = np.frombuffer(data, np.uint8)
    is_end = (raw == 0x0A) | (raw == 0x0D)
    ends = np.flatnonzero(is_end)
    sizes = np.diff(ends, prepend=-1) - 1
    ink = np.cumsum(raw > 0x20, dtype=np.int64)[ends]
    kept = np.diff(ink, prepend=0) > 0
    mask = ~is_end
    if (sizes[~kept] > 0).any():
        mask &= np.repeat(kept, sizes + 1)
    offsets = np.zeros(int(kept.sum()) + 1, np.int32)
    np.cumsum(sizes[kept], out=offsets[1:])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(raw[mask]))


def file_lines(chunks: Iterable[bytes], gzipped: bool, part: int = 0, parts: int = 1,
               n_chunks: int = 1) -> Iterator[tuple[int, pa.StringArray]]:
    """(records before, records) of one file, some MB at a time; damage is an error.

    With ``parts``, those records only that end in the ``part``-th share of the ``n_chunks`` stored chunks. What comes
    before must still be decoded (a gzip stream has one beginning), but is not made into lines, and nothing after
    it is read.
    """
    seen = -1

    def counted():
        nonlocal seen
        for chunk in chunks:
            seen += 1
            yield chunk

    held, start, done = b"", True, 0
    stream = counted()
    for data in records.gunzipped(stream) if gzipped else stream:
        now = min(parts - 1, seen * parts // n_chunks)
        if now > part:
            return
        held += data
        at = max(held.rfind(b"\n"), held.rfind(b"\r")) + 1
        if not at:
            continue
        piece, held = held[:at], held[at:]
        if start:
            piece, start = piece.removeprefix(records.BOM), False
        if now == part:
            lines = lines_of(piece)
            yield done, lines
            done += len(lines)
        else:
            done += count_lines(piece)
    if part == parts - 1:
        yield done, lines_of((held.removeprefix(records.BOM) if start else held) + b"\n")


def count_lines(data: bytes) -> int:
    """Number of the lines of :func:`lines_of`."""
    raw = np.frombuffer(data, np.uint8)
    ink = np.cumsum(raw > 0x20, dtype=np.int64)[np.flatnonzero((raw == 0x0A) | (raw == 0x0D))]
    return int((np.diff(ink, prepend=0) > 0).sum())


def record_lines(files: DataFrame, folder: TaskFolder) -> DataFrame:
    """(file_key, delivery_date, record, line) of every record in ``files`` (file_key, delivery_date).

    ``file_key`` is a path relative to the folder, ``record`` counts from 1 within a file. Files that :func:`spread`
    has dealt in parts are read by as many tasks.
    """
    def task(batches):
        for b in batches:
            for key, day, part, parts, length in zip(
                    b.column("file_key").to_pylist(), b.column("delivery_date"),
                    *(b.column(c).to_pylist() for c in ("part", "parts", "length")), strict=True):
                with folder.open(key) as f:
                    done = 0
                    try:
                        for done, lines in file_lines(iter(lambda f=f: f.read(READ_BYTES), b""), key.endswith(".gz"),
                                                      part, parts, max(1, -(-length // READ_BYTES))):
                            if len(lines):
                                yield pa.RecordBatch.from_arrays(
                                    [pa.repeat(pa.scalar(key), len(lines)), pa.repeat(day, len(lines)),
                                     pa.array(np.arange(done + 1, done + 1 + len(lines))), lines],
                                    names=["file_key", "delivery_date", "record", "line"])
                    except records.DamagedFile as e:
                        raise OSError(f"{key} is damaged after record {done}: {e}") from e

    cut = {c: F.lit(v).cast("long") for c, v in (("part", 0), ("parts", 1), ("length", 0)) if c not in files.columns}
    return files.withColumns(cut).select("file_key", "delivery_date", "part", "parts", "length").mapInArrow(
        task, "file_key string, delivery_date date, record long, line string")


def parsed(line: Column, schema: T.StructType, options: dict[str, str]) -> Column:
    """A line as a struct of positional fields ``c0, c1, ...`` with the types of ``schema``."""
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    return F.from_csv(line, fields, {k: v for k, v in options.items() if k != "header"})


def columns_of(parsed_line: Column, schema: T.StructType) -> list[Column]:
    """The fields of a parsed line under the names of ``schema``."""
    return [parsed_line[f"c{i}"].alias(f.name) for i, f in enumerate(schema.fields)]


def spread(files: DataFrame, task_bytes: int, most_parts: int = MOST_PARTS) -> DataFrame:
    """``files`` (with ``length``) dealt over tasks of about ``task_bytes`` stored bytes.

    A bigger file is dealt to several tasks, ``most_parts`` at most: each decodes what comes before its part, so that
    decoding (a small share of the work) is repeated, and parsing is not.
    """
    parts = F.least(F.lit(most_parts), F.greatest(F.lit(1), F.ceil(F.col("length") / F.lit(task_bytes)))).cast("long")
    dealt = files.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    total = dealt.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("length") / F.col("parts")), F.lit(0.0)).alias("b")).first()
    return dealt.repartition(max(1, min(total.n, math.ceil(total.b / task_bytes))))
