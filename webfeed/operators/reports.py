"""Delivery reports that describe problems instead of raising on them.

* :func:`delivery_gaps`      dates without a delivery (V4), as a DataFrame;
* :func:`schema_drift`       deliveries whose columns differ from the earliest one (C4);
* :func:`feed_validation`    per-file validation of every delivery found (V2, V3);
* :func:`delivery_records`   per delivery: declared totals against rows read (V3);
* :func:`manifest_catalog`   the parsed manifests with their problems (S8, M1-M6, V1);
* :func:`type_losses`        per typed column: values present vs. values the type turns into NULL;
* :func:`lost_cells`         each of these cells: file, record, column, text;
* :func:`column_profile`     per column: the narrowest type that loses nothing;
* :func:`delivery_digests`   per delivery: one digest over the digests of its files.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from datetime import date as Date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import feed_schema
from ..options import DateSelection, selection
from ..paths import normal, quoted
from ..plans.scan import CSV_OPTIONS
from ..session import check_streamable, task_folder
from ..sources.feed import feed_plan
from ..sources.header import distinct_headers
from ..sources.lines import parsed, record_lines
from ..sources.manifest import load_deliveries, manifests
from .validate import validation_report


def manifest_catalog(spark: SparkSession, directory: str, feedname: str,
                     sel: DateSelection | None = None) -> DataFrame:
    """One row per manifest, including its ``problems`` (lazy, one scan)."""
    return manifests(spark, directory, feedname, sel)


def delivery_gaps(spark: SparkSession, directory: str, feedname: str,
                  start: str | Date | None = None, end: str | Date | None = None) -> DataFrame:
    """``missing_date``: days in ``[start, end]`` (or between the first and last
    delivery found) that have no manifest. Lazy; one manifest scan with bounds, two without."""
    sel = selection(start=start, end=end)
    found = manifests(spark, directory, feedname, sel).select("delivery_date")
    if sel.kind == "range":
        bounds = spark.range(1).select(F.lit(sel.start).alias("lo"), F.lit(sel.end).alias("hi"))
    else:
        bounds = found.agg(F.min("delivery_date").alias("lo"), F.max("delivery_date").alias("hi"))
    expected = bounds.where(F.col("lo").isNotNull()) \
        .select(F.explode(F.sequence("lo", "hi")).alias("delivery_date"))
    return (expected.join(found, "delivery_date", "left_anti")
            .select(F.col("delivery_date").alias("missing_date")))


def schema_drift(spark: SparkSession, directory: str, feedname: str,
                 sel: DateSelection | None = None) -> DataFrame:
    """Deliveries without a usable header, or whose header differs from the earliest usable one.

    Columns: ``delivery_date, header_found, n_columns, missing_columns,
    extra_columns, duplicated_columns (array<string>), reordered boolean,
    problem string`` (why there is no header: no archive or several listed, the
    archive missing or damaged, the header member absent, empty or of several
    lines). One header job; the driver compares each distinct header once and holds
    a row per delivery.
    """
    deliveries = [d for d in load_deliveries(spark, directory, feedname, sel, data_names=False)
                  if d.delivery_date is not None]
    single = [d for d in deliveries if len(d.lookup_names) == 1]
    kinds = distinct_headers(spark, directory, [d.archive for d in single]) if single else []
    kind_of = {a: i for i, (_, _, archives) in enumerate(kinds) for a in archives}
    first = next((kind_of[d.archive] for d in single if kinds[kind_of[d.archive]][1] is None), None)
    canonical = kinds[first][0] if first is not None else []
    drift = [_header_drift(header, problem, canonical) for header, problem, _ in kinds]
    rows = []
    for d in deliveries:
        if len(d.lookup_names) != 1:
            rows.append((d.delivery_date, False, None, None, None, None, False,
                         f"manifest lists {len(d.lookup_names)} lookup archives"))
        elif drift[kind_of[d.archive]] is not None:
            rows.append((d.delivery_date, *drift[kind_of[d.archive]]))
    return spark.createDataFrame(rows, _DRIFT)


_DRIFT = ("delivery_date date, header_found boolean, n_columns int, missing_columns array<string>, "
          "extra_columns array<string>, duplicated_columns array<string>, reordered boolean, problem string")


def _header_drift(header: list[str] | None, problem: str | None, canonical: list[str]) -> tuple | None:
    """What tells a header from the canonical one; None where nothing does."""
    if header is None or problem is not None:
        return False, None, None, None, None, False, problem
    missing = [c for c in dict.fromkeys(canonical) if c not in set(header)]
    extra = [c for c in dict.fromkeys(header) if c not in set(canonical)]
    repeated = sorted(c for c, n in Counter(header).items() if n > 1)
    same = not (missing or extra or repeated)
    if same and header == canonical:
        return None
    return True, len(header), missing, extra, repeated, same, None


def feed_validation(spark: SparkSession, directory: str, feedname: str,
                    sel: DateSelection | None = None, **kwargs) -> DataFrame:
    """Per-file validation report of every delivery found, whatever its problems."""
    return validation_report(spark, directory, feedname, sel, **kwargs)


def delivery_records(spark: SparkSession, directory: str, feedname: str,
                     sel: DateSelection | None = None) -> DataFrame:
    """Per delivery: ``total_records`` (declared), ``listed_records`` (sum of the
    files' Record-Count), ``actual_records`` (rows read) and ``ok``."""
    report = validation_report(spark, directory, feedname, sel, check_md5=False, kinds=("data",))
    declared = manifests(spark, directory, feedname, sel).select("delivery_date", "total_records")
    per_day = report.groupBy("delivery_date").agg(
        F.sum("expected_records").alias("listed_records"),
        F.sum("actual_records").alias("actual_records"))
    return (declared.join(per_day, "delivery_date", "left")
            .select("delivery_date", "total_records",
                    F.coalesce("listed_records", F.lit(0)).cast("bigint").alias("listed_records"),
                    F.coalesce("actual_records", F.lit(0)).cast("bigint").alias("actual_records"))
            .withColumn("ok", (F.col("total_records") == F.col("actual_records"))
                        & (F.col("listed_records") == F.col("actual_records"))))


def type_losses(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
                column_types: dict | None = None) -> DataFrame:
    """Per typed column: ``column_name, data_type, values, lost``.

    ``values`` counts the non-empty cells in the files, ``lost`` the ones the
    typed read turns into NULL (out-of-range ids, a decimal comma, a bad
    timestamp). The feed is counted by two native scans, one with every column
    as STRING and one typed: a cell that parses is not NULL in either.
    """
    plan = feed_plan(spark, directory, feedname, sel, column_types)
    typed = [(c, f.dataType) for c, f in zip(plan.columns, plan.schema.fields)
             if not isinstance(f.dataType, T.StringType)]
    if not typed:
        return spark.createDataFrame([], "column_name string, data_type string, values bigint, lost bigint")
    raw = dataclasses.replace(plan, _scans=None, column_types={**plan.column_types,
                                                               **{c: T.StringType() for c, _ in typed}})

    def present(hits: DataFrame, count: str) -> DataFrame:
        """Cells that are not NULL, by position of the column."""
        counts = hits.agg(*[F.count(F.col(quoted(c))).alias(f"n{i}") for i, (c, _) in enumerate(typed)])
        return counts.select(F.posexplode(F.array(*[f"n{i}" for i in range(len(typed))])).alias("i", count))

    names = spark.createDataFrame([(i, c, t.simpleString()) for i, (c, t) in enumerate(typed)],
                                  "i int, column_name string, data_type string")
    return names.join(present(raw.to_dataframe(spark), "values"), "i").join(
        present(plan.to_dataframe(spark), "kept"), "i").select(
        "column_name", "data_type", "values", (F.col("values") - F.col("kept")).alias("lost"))


def lost_cells(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
               column_types: dict | None = None) -> DataFrame:
    """Every cell that the typed read turns into NULL: ``delivery_date, file_name, record, column_name, data_type, value``.

    ``record`` counts from 1 in the file (blank lines are no records). Tasks open the files and number their
    records; each record is parsed twice in the JVM, as text and typed, and the two are compared side by side.
    """
    plan = feed_plan(spark, directory, feedname, sel, column_types)
    schema = "delivery_date date, file_name string, record long, column_name string, data_type string, value string"
    plan.scans(spark)  # names missing files
    parts = []
    for g in plan.groups:
        types = feed_schema(g.columns, plan.column_types)
        typed = [(i, f) for i, f in enumerate(types.fields) if not isinstance(f.dataType, T.StringType)]
        if not (g.files and typed):
            continue
        folder = task_folder(spark, directory)
        if folder is None:
            check_streamable(directory)
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in types.fields])
        files = spark.createDataFrame([(normal(f), d) for d, fs in g.files_by_date for f in fs],
                                      "file_key string, delivery_date date")
        files = files.repartition(min(len(g.files), 4 * spark.sparkContext.defaultParallelism))
        rows = record_lines(files, folder).select(
            "delivery_date", "file_key", "record", parsed(F.col("line"), text, CSV_OPTIONS).alias("raw"),
            parsed(F.col("line"), types, CSV_OPTIONS).alias("typed"))
        cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                   F.col(f"raw.c{i}").alias("value"), F.col(f"typed.c{i}").isNull().alias("null"))
                          for i, f in typed])
        lost = F.filter(cells, lambda c: c["value"].isNotNull() & c["null"])
        parts.append(rows.select("delivery_date", F.col("file_key").alias("file_name"), "record", F.inline(lost)).drop("null"))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], schema)


# Types that a column can have, from the narrowest; the bit of each in a cell's mask of types that lose nothing.
_LATTICE = [(T.IntegerType(), 1), (T.LongType(), 2), (T.DecimalType(20, 0), 4), (T.DoubleType(), 8),
            (T.TimestampType(), 16)]
# Text forms that Spark's CSV parser takes for these types.
_INTEGER, _NUMBER = r"^(0|-?[1-9][0-9]{0,19})$", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def _fitting(v: Column) -> Column:
    """Bits of the types that a text can be read as and written back from without a change of its value."""
    whole = v.rlike(_INTEGER)
    number = v.try_cast("double")
    digits = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[eE].*$", ""), r"[-.]", ""), "^0+", "")
    exact = number.isNotNull() & (F.abs(number) < float("inf")) & (
        (F.length(digits) <= 15) | (number.cast("string") == v))
    time = v.try_cast("timestamp")
    same_time = time.isNotNull() & (F.date_format(time, "yyyy-MM-dd HH:mm:ss") == F.substring(v, 1, 19))
    bits = [(whole & v.try_cast("int").isNotNull(), 1), (whole & v.try_cast("bigint").isNotNull(), 2), (whole, 4),
            (v.rlike(_NUMBER) & exact, 8), (v.rlike(_TIME) & same_time, 16)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(fits, F.lit(bit)).otherwise(F.lit(0)) for fits, bit in bits])


def column_profile(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None) -> DataFrame:
    """Per column: ``position, column_name, data_type, values, lossless_type``.

    ``lossless_type`` is the narrowest of int, bigint, decimal(20,0), double, timestamp and string that holds every
    value of the column: integers in their usual form, doubles of up to 15 digits or equal to their own text, times of
    a calendar. A column without values keeps its type. One scan with all columns as text; a column's
    types are the intersection of its cells' (``bit_and``), which partial aggregates merge.
    """
    plan = feed_plan(spark, directory, feedname, sel)
    raw = dataclasses.replace(plan, _scans=None, column_types={c: T.StringType() for c in plan.columns})
    cells = raw.to_dataframe(spark)
    n = len(plan.columns)
    counts = cells.agg(*[x for i, c in enumerate(plan.columns) for x in (
        F.count(F.col(quoted(c))).alias(f"n{i}"), F.bit_and(F.when(F.col(quoted(c)).isNotNull(), _fitting(F.col(quoted(c)))))
        .alias(f"m{i}"))])
    rows = counts.select(F.inline(F.array(*[F.struct(
        F.lit(i + 1).alias("position"), F.lit(plan.columns[i]).alias("column_name"),
        F.lit(plan.schema.fields[i].dataType.simpleString()).alias("data_type"), F.col(f"n{i}").alias("values"),
        F.col(f"m{i}").alias("mask")) for i in range(n)])))
    best = F.lit("string")
    for kind, bit in reversed(_LATTICE):
        best = F.when(F.col("mask").bitwiseAND(F.lit(bit)) > 0, F.lit(kind.simpleString())).otherwise(best)
    return rows.withColumn("lossless_type", F.when(F.col("values") == 0, F.col("data_type")).otherwise(best)).drop("mask")


def lossless_types(profile: DataFrame) -> dict[str, T.DataType]:
    """The types of a :func:`column_profile` as ``column_types`` of a read (one row per column)."""
    known = {kind.simpleString(): kind for kind, _ in _LATTICE}
    return {r.column_name: known.get(r.lossless_type, T.StringType()) for r in profile.collect()}


def delivery_digests(spark: SparkSession, directory: str, feedname: str, sel: DateSelection | None = None,
                     ledger: str | None = None) -> DataFrame:
    """Per delivery: ``delivery_date, n_files, n_bytes, digest`` over the files that exist.

    ``digest`` is the MD5 of the sorted lines ``<MD5 of the file>  <name>``: equal where a delivery's files are. A list holds
    one delivery's files, never more than its manifest lists. With a ``ledger`` unchanged files are not read.
    """
    report = validation_report(spark, directory, feedname, sel, check_records=False, ledger=ledger).where("file_exists")
    line = F.concat("actual_md5", F.lit("  "), "file_name")
    return report.groupBy("delivery_date").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("actual_size").alias("n_bytes"),
        F.md5(F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("digest"))
