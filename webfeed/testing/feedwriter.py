"""Writes test deliveries (manifest, gz data files, lookup archive) from ``events``.

Test tooling, not part of the read path. Hit rows are written by Spark's CSV
writer (gzip, tab separated, one task per data file, in the order of event_id); sizes, digests and record
counts come back from Spark jobs; only per-file metadata and the small lookup
archives are built and written by one task per delivery.

A day is split into ``max(files_per_day, ceil(rows / ROWS_PER_FILE))`` data
files (row ``event_id % n + 1``), so no task writes more than about
``ROWS_PER_FILE`` rows however many rows one day holds.

Hit columns (header name -> source):

    hitid_high 0 | hitid_low event_id | date_time ts | hit_time_gmt epoch seconds
    visid_low user_id | browser user_id % BROWSER_IDS | event_list event code
    pagename event_type | post_evar1 props | daily_visitor event_id % 2
    custom_unknown 'x' | "my col (a=b)" 'y' | curr_rate value

The event code of a type is the first 8 hex digits of ``md5(event_type)``.
Lookup members: ``event.tsv`` (code -> type, all events), ``browser.tsv``
(browser ids seen in that delivery -> ``browser-<id> <yyyy-MM-dd>``, at most
``BROWSER_IDS`` lines), the other known lookups empty, and
``column_headers.tsv``.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import HEADER_MEMBER, KNOWN_LOOKUPS
from ..plans.broadcast import bounded_broadcast, row_bytes
from ..session import HadoopFS, task_file_system

# Rows per data file at most: a bigger day is split into more files.
ROWS_PER_FILE = 1_000_000
# Browser ids are user_id % BROWSER_IDS, so a browser lookup has at most this many lines.
BROWSER_IDS = 1_000_000

DEFAULT_HEADER = ("hitid_high", "hitid_low", "date_time", "hit_time_gmt", "visid_low", "browser",
                  "event_list", "pagename", "post_evar1", "daily_visitor", "custom_unknown",
                  "my col (a=b)", "curr_rate")


# Optional further columns, for wide feeds.
WIDE_COLUMNS = tuple(f"wide_{i:02d}" for i in range(50))


def hit_frame(events: DataFrame) -> tuple[DataFrame, list[str]]:
    """Every possible hit column (as ``h<i>``) plus ``day`` and ``event_id``; and the header names."""
    ts = F.col("ts")
    epoch = F.expr("unix_date(to_date(ts)) * 86400L + hour(ts) * 3600L + minute(ts) * 60L + second(ts)")
    cols = {
        "hitid_high": F.lit(0).cast("bigint"),
        "hitid_low": F.col("event_id"),
        "date_time": F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "hit_time_gmt": epoch,
        "visid_low": F.col("user_id"),
        "browser": F.col("user_id") % BROWSER_IDS,
        "event_list": F.substring(F.md5(F.col("event_type")), 1, 8),
        "pagename": F.col("event_type"),
        "post_evar1": F.col("props"),
        "daily_visitor": (F.col("event_id") % 2).cast("int"),
        "custom_unknown": F.lit("x"),
        "my col (a=b)": F.lit("y"),
        "curr_rate": F.col("value"),
        "extra_col": F.lit("z"),
        "page.name": F.col("event_type"),
        "user`id": F.col("user_id"),
        **{name: F.col("user_id") + i for i, name in enumerate(WIDE_COLUMNS)},
    }
    return events.select(F.to_date(ts).alias("day"), "event_id",
                         *[c.alias(f"h{i}") for i, c in enumerate(cols.values())]), list(cols)


@dataclass
class Defects:
    """Planted problems, by day of month."""

    skip_days: frozenset[int] = frozenset()         # no delivery at all
    bad_md5_data: frozenset[int] = frozenset()      # data file digest altered
    bad_size_data: frozenset[int] = frozenset()     # data file size + 1
    bad_record_count: frozenset[int] = frozenset()  # Record-Count + 1
    bad_total: frozenset[int] = frozenset()         # Total-Records + 1
    bad_declared_files: frozenset[int] = frozenset()  # Data-Files declared + 1
    missing_data_file: frozenset[int] = frozenset()   # listed but not delivered
    two_archives: frozenset[int] = frozenset()      # two Lookup-File entries
    no_header_member: frozenset[int] = frozenset()  # archive lacks column_headers.tsv
    bad_md5_archive: frozenset[int] = frozenset()   # archive digest altered
    no_archive: frozenset[int] = frozenset()        # no Lookup-File entry
    missing_archive: frozenset[int] = frozenset()   # listed but not delivered
    empty_header: frozenset[int] = frozenset()      # column_headers.tsv has no bytes
    damaged_archive: frozenset[int] = frozenset()   # archive cut off (size and digest listed as it is)
    two_line_header: frozenset[int] = frozenset()   # column_headers.tsv has a second line


@dataclass
class FeedSpec:
    feedname: str
    files_per_day: int = 1
    header_for_day: Callable[[date], tuple[str, ...]] = field(default=lambda d: DEFAULT_HEADER)
    days: Callable[[date], bool] = field(default=lambda d: True)
    crlf: bool = False
    padded_numbers: bool = False
    defects: Defects = field(default_factory=Defects)
    # From this day of month on, curr_rate is written with a decimal comma.
    comma_decimal_from: int | None = None
    # Each day's files in a folder of its own, with the same base names every day.
    subfolders: bool = False

    def archive_name(self, day: str) -> str:
        return f"{day}/lookup_data.tar.gz" if self.subfolders else f"{self.feedname}_{day}-lookup_data.tar.gz"

    def data_name(self, day: str, number: int) -> str:
        return f"{day}/hits-{number:02d}.tsv.gz" if self.subfolders else f"{number:02d}-{self.feedname}_{day}.tsv.gz"


def _tar_gz(members: dict[str, bytes]) -> bytes:
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            info.mtime = 0
            tar.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def _manifest(meta: dict, lookups: list[dict], data: list[dict], crlf: bool, padded: bool) -> bytes:
    def num(v):
        return f" {v}  " if padded else str(v)

    lines = ["Datafeed-Manifest-Version: 1.0", f"Lookup-Files: {num(meta['n_lookup'])}",
             f"Data-Files: {num(meta['n_data'])}", f"Total-Records: {num(meta['total'])}", ""]
    for f in lookups:
        lines += [f"Lookup-File: {f['name']}", f"MD5-Digest: {f['md5']}", f"File-Size: {num(f['size'])}", ""]
    for f in data:
        lines += [f"Data-File: {f['name']}", f"MD5-Digest: {f['md5']}", f"File-Size: {num(f['size'])}",
                  f"Record-Count: {num(f['records'])}", ""]
    sep = "\r\n" if crlf else "\n"
    return sep.join(lines).encode("utf-8")


def _copy_name(name: str) -> str:
    return name.replace("-lookup_data.tar.gz", "-lookup_data-2.tar.gz")


def files_for_day(rows: int, files_per_day: int) -> int:
    """Data files of a day with ``rows`` rows."""
    return max(files_per_day, -(-rows // ROWS_PER_FILE))


def _archive_writer(out_dir: str, names: dict, headers: dict, event_tsv: bytes, copies: set, absent: set, cut: set):
    """applyInPandas function: one delivery's browser ids (at most ``BROWSER_IDS``) -> its
    archive, written by the task."""

    def write(pdf):
        import hashlib

        import pandas as pd

        day = pdf["day"].iloc[0]
        ids = sorted(int(x) for x in pdf["browser_id"])
        members = {} if headers[day] is None else {HEADER_MEMBER: headers[day]}
        for lk in KNOWN_LOOKUPS:
            if lk == "event.tsv":
                members[lk] = event_tsv
            elif lk == "browser.tsv":
                members[lk] = "".join(f"{b}\tbrowser-{b} {day}\n" for b in ids).encode()
            else:
                members[lk] = b""
        archive = _tar_gz(members)
        archive = archive[:20] if day in cut else archive
        name = names[day]
        targets = [] if day in absent else [name, _copy_name(name)] if day in copies else [name]
        for t in targets:  # a retried task rewrites the same bytes
            filesystem, path = task_file_system(f"{out_dir}/{t}")
            filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(path, compression=None) as out:
                out.write(archive)
        return pd.DataFrame({"day": [day], "name": [name], "md5": [hashlib.md5(archive).hexdigest()],
                             "size": [len(archive)]})

    return write


def _move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Rename written files (one row per file) in Python tasks; a retried task skips
    the files it already moved."""
    if not moves:
        return

    def move(batches):
        import pandas as pd
        from pyarrow import fs as pafs

        for pdf in batches:
            for src, dst in zip(pdf["src"], pdf["dst"]):
                filesystem, s = task_file_system(src)
                _, d = task_file_system(dst)
                if filesystem.get_file_info(s).type == pafs.FileType.NotFound \
                        and filesystem.get_file_info(d).type == pafs.FileType.File:
                    continue
                filesystem.create_dir(d.rsplit("/", 1)[0], recursive=True)
                filesystem.move(s, d)
            yield pd.DataFrame({"moved": [len(pdf)]})

    pairs = spark.createDataFrame(moves, "src string, dst string")
    pairs = pairs.repartition(max(1, min(len(moves), spark.sparkContext.defaultParallelism)))
    moved = pairs.mapInPandas(move, "moved bigint").agg(F.sum("moved")).first()[0]
    if moved != len(moves):
        raise OSError(f"moved {moved} of {len(moves)} files")


def _flip(digest: str) -> str:
    return ("0" if digest[0] != "0" else "1") + digest[1:]


def write_feed(spark: SparkSession, events: DataFrame, out_dir: str, staging: str, spec: FeedSpec) -> list[date]:
    """Write the deliveries of ``spec`` into ``out_dir``; returns the delivered days."""
    fs = HadoopFS(spark)
    hits, names = hit_frame(events)
    alias = {n: f"h{i}" for i, n in enumerate(names)}
    rows_of = {r.day: r.n for r in hits.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}  # per day
    days = [d for d in sorted(rows_of) if spec.days(d) and d.day not in spec.defects.skip_days]

    # 1. data files: one CSV write per distinct header, one task per (day, file)
    day_files = spark.createDataFrame([(d, files_for_day(rows_of[d], spec.files_per_day)) for d in days],
                                      "day date, n_files int")  # one row per day
    hits = hits.join(bounded_broadcast(day_files, len(days), row_bytes()), "day")
    file_no = (F.col("event_id") % F.col("n_files") + 1).cast("int")

    def comma(d: date) -> bool:
        return spec.comma_decimal_from is not None and d.day >= spec.comma_decimal_from

    by_header: dict[tuple, list[date]] = {}
    for d in days:
        by_header.setdefault((tuple(spec.header_for_day(d)), comma(d)), []).append(d)
    stage = f"{staging.rstrip('/')}/{spec.feedname}"
    for i, ((header, commas), hdays) in enumerate(sorted(by_header.items(), key=lambda kv: kv[1][0])):
        cols = [(F.regexp_replace(F.col(alias[n]).cast("string"), r"\.", ",") if commas and n == "curr_rate"
                 else F.col(alias[n])).alias(f"c{j}") for j, n in enumerate(header)]
        (hits.where(F.col("day").isin(hdays))
         .select("day", file_no.alias("file_no"), "event_id", *cols)
         .repartition("day", "file_no").sortWithinPartitions("day", "file_no", "event_id").drop("event_id")
         .write.partitionBy("day", "file_no").option("sep", "\t").option("compression", "gzip")
         .mode("overwrite").csv(f"{stage}/v{i}"))

    # 2. size + digest of every written file (one Spark job), record counts per file
    written = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz")
               .load(f"{stage}/*/day=*/file_no=*")
               .select("path", "length", F.md5("content").alias("md5"),
                       F.regexp_extract("path", r"day=([0-9-]+)", 1).alias("day"),
                       F.regexp_extract("path", r"file_no=([0-9]+)", 1).cast("int").alias("file_no"))
               .collect())
    counts = {(r.day, r.file_no): r.n for r in
              hits.where(F.col("day").isin(days))
              .groupBy(F.col("day").cast("string").alias("day"), file_no.alias("file_no"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}

    # 3. lookup archives: one task per delivery builds and writes its archive
    event_rows = sorted((r.code, r.event_type) for r in
                        events.select(F.substring(F.md5("event_type"), 1, 8).alias("code"), "event_type")
                        .distinct().collect())  # one row per event type
    event_tsv = "".join(f"{c}\t{t}\n" for c, t in event_rows).encode()
    df = spec.defects

    def header_text(d: date) -> bytes | None:
        if d.day in df.no_header_member:
            return None
        second = "more\n" if d.day in df.two_line_header else ""
        return b"" if d.day in df.empty_header else ("\t".join(spec.header_for_day(d)) + "\n" + second).encode()

    def on(chosen: frozenset[int]) -> set[str]:
        return {d.isoformat() for d in days if d.day in chosen}

    headers = {d.isoformat(): header_text(d) for d in days}
    names = {d.isoformat(): spec.archive_name(d.isoformat()) for d in days}
    copies = on(df.two_archives)
    archives = {r.day: r for r in
                events.select(F.to_date("ts").cast("string").alias("day"),
                              (F.col("user_id") % BROWSER_IDS).alias("browser_id"))
                .where(F.col("day").isin(list(headers))).distinct()
                .groupBy("day")
                .applyInPandas(_archive_writer(out_dir, names, headers, event_tsv, copies,
                                               on(df.missing_archive), on(df.damaged_archive)),
                               "day string, name string, md5 string, size bigint")
                .collect()}

    files_by_day: dict[str, list] = {}
    for r in written:
        files_by_day.setdefault(r.day, []).append(r)
    moves, manifests = [], []
    for d in days:
        iso = d.isoformat()
        data = []
        for r in sorted(files_by_day.get(iso, []), key=lambda r: r.file_no):
            name = spec.data_name(iso, r.file_no)
            if d.day not in df.missing_data_file:
                moves.append((r.path, f"{out_dir}/{name}"))
            data.append({"name": name, "md5": r.md5, "size": r.length, "records": counts[(iso, r.file_no)]})
        a = archives[iso]
        lookups = [{"name": a.name, "md5": a.md5, "size": a.size}]
        if iso in copies:
            lookups.append({**lookups[0], "name": _copy_name(a.name)})
        if d.day in df.no_archive:
            lookups = []
        if d.day in df.bad_md5_archive:
            lookups[0]["md5"] = _flip(lookups[0]["md5"])
        if d.day in df.bad_md5_data:
            data[0]["md5"] = _flip(data[0]["md5"])
        if d.day in df.bad_size_data:
            data[0]["size"] += 1
        total = sum(f["records"] for f in data)
        if d.day in df.bad_record_count:
            data[0]["records"] += 1
        if d.day in df.bad_total:
            total += 1
        meta = {"n_lookup": len(lookups), "n_data": len(data) + (1 if d.day in df.bad_declared_files else 0),
                "total": total}
        manifests.append((f"{out_dir}/{spec.feedname}_{iso}.txt",
                          _manifest(meta, lookups, data, spec.crlf, spec.padded_numbers)))
    # 4. data files to their delivery names (spread over tasks), then the manifests: last, as a vendor does
    _move_files(spark, moves)
    for path, text in manifests:
        fs.write_bytes(path, text)
    return days
