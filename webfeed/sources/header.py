"""Hit-table headers: ``column_headers.tsv`` of each delivery's lookup archive.

The header member of every selected archive is unpacked in one parallel Spark
job. Names are sanitised (blank, ``, ; { } ( ) = \\t \\n`` become ``_``) after
the line end is stripped.

* :func:`archive_headers`  ``archive_name, header, problem`` per archive: the header
  or what is wrong (archive missing or damaged, no header member, an empty one, or
  one with more than one line that is not blank);
* :func:`collect_headers`  distinct header -> its archives on the driver, which
  never holds more than one copy of each distinct header.

Archives are named by their path relative to the delivery folder.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DeliveryError
from ..functions.types import sanitized_header
from ..options import HEADER_MEMBER
from .archive import ABSENT, DAMAGED, EMPTY, MISSING, archive_lines

#: Archives named in one error message.
EXAMPLES = 10


@functools.lru_cache(maxsize=4)
def _header_columns(_app_id: str) -> list:
    """Aggregates over an archive's first two header lines."""
    line, number = F.col("line"), F.col("line_no")
    first = F.max(F.when(number == 0, line))
    problem = F.max(
        F.when(number == MISSING, F.lit("lookup archive is missing"))
        .when(number == DAMAGED, F.concat(F.lit("lookup archive cannot be unpacked: "), line))
        .when(number == ABSENT, F.lit(f"lookup archive has no {HEADER_MEMBER}"))
        .when(number == EMPTY, F.lit(f"{HEADER_MEMBER} is empty"))
        .when((number == 1) & line.rlike(r"[^\x00-\x20]"), F.lit(f"{HEADER_MEMBER} has more than one line")))
    return [sanitized_header(first).alias("header"), problem.alias("problem")]


def archive_headers(spark: SparkSession, directory: str, archives: list[str],
                    lengths: dict[str, int] | None = None) -> DataFrame:
    """Sanitised header or problem of each archive (lazy); ``lengths``: see :func:`archive_lines`."""
    lines = archive_lines(spark, directory, sorted(set(archives)), [HEADER_MEMBER], max_lines=2, lengths=lengths)
    header, problem = _header_columns(spark.sparkContext.applicationId)
    found = lines.groupBy("archive_name").agg(header, problem)
    return found.select("archive_name", F.when(F.col("problem").isNull(), F.col("header")).alias("header"), "problem")


def distinct_headers(spark: SparkSession, directory: str, archives: list[str], lengths: dict[str, int] | None = None
                     ) -> list[tuple[list[str] | None, str | None, list[str]]]:
    """(header, problem, archives) of every distinct header and problem: one job, each header once on the driver."""
    rows = archive_headers(spark, directory, archives, lengths).groupBy("header", "problem") \
        .agg(F.collect_list("archive_name").alias("archives")).collect()
    return [(None if r.header is None else list(r.header), r.problem, list(r.archives)) for r in rows]


def collect_headers(spark: SparkSession, directory: str, archives: list[str],
                    skip_problems: bool = False, lengths: dict[str, int] | None = None) -> dict[str, list[str] | None]:
    """Archive name -> header (one list object per distinct header).

    An archive without a usable header raises :class:`DeliveryError`, or maps to
    ``None`` with ``skip_problems``.
    """
    rows = distinct_headers(spark, directory, archives, lengths)
    bad = sorted(f"{a} ({problem})" for _, problem, found in rows if problem is not None for a in found)
    if bad and not skip_problems:
        raise DeliveryError("no hit-table header: " + "; ".join(bad[:EXAMPLES])
                            + (f"; and {len(bad) - EXAMPLES} more" if len(bad) > EXAMPLES else ""))
    return {a: None if problem is not None else header for header, problem, found in rows for a in found}
