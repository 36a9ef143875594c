"""Column expressions that parse manifest text.

A manifest is ``Key: value`` lines in blocks. The metadata block comes first;
then one block per lookup archive and one per data file. Parsing is plain Spark
regex work, so any number of manifests is parsed in one job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Manifest blocks: keys and their order within a block.
METADATA_BLOCK = (r"(?m)^Datafeed-Manifest-Version: (.*)\nLookup-Files: (.*)\n"
                  r"Data-Files: (.*)\nTotal-Records: (.*)\n")
LOOKUP_BLOCK = r"(?m)^Lookup-File: (.*)\nMD5-Digest: (.*)\nFile-Size: (.*)\n"
DATA_BLOCK = r"(?m)^Data-File: (.*)\nMD5-Digest: (.*)\nFile-Size: (.*)\nRecord-Count: (.*)\n"
# Manifest file name: <feed>_<yyyy-MM-dd>.txt
MANIFEST_DATE = r"(\d{4}-\d{2}-\d{2})\.txt$"
# ---------------------------------------------------------------------------

# Characters removed around numbers: everything up to and including space.
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def normalized_text(value: Column) -> Column:
    """Line ends as ``\\n`` (CR LF and lone CR too), with a final ``\\n``; a leading
    byte-order mark removed."""
    lf = F.regexp_replace(F.regexp_replace(value, "^\ufeff", ""), r"\r\n|\r", "\n")
    return F.when((lf == "") | lf.endswith("\n"), lf).otherwise(F.concat(lf, F.lit("\n")))


def strip_blanks(value: Column) -> Column:
    return F.regexp_replace(value, _EDGE_BLANKS, "")


def parse_long(value: Column) -> Column:
    """Trimmed decimal integer, NULL when it is not one (or does not fit 64 bits)."""
    v = strip_blanks(value)
    return F.when(v.rlike(r"^[+-]?[0-9]{1,19}$"), v.try_cast("bigint"))


def parse_int(value: Column) -> Column:
    v = strip_blanks(value)
    return F.when(v.rlike(r"^[+-]?[0-9]{1,10}$"), v.try_cast("int"))


def _group(text: Column, pattern: str, idx: int) -> Column:
    return F.regexp_extract(text, pattern, idx)


def _all(text: Column, pattern: str, idx: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(idx))


def metadata(text: Column) -> dict[str, Column]:
    """Columns of the metadata block (first match in the text)."""
    return {
        "has_metadata": text.rlike(METADATA_BLOCK),
        "version": _group(text, METADATA_BLOCK, 1),
        "n_lookup_files": parse_int(_group(text, METADATA_BLOCK, 2)),
        "n_data_files": parse_int(_group(text, METADATA_BLOCK, 3)),
        "total_records": parse_long(_group(text, METADATA_BLOCK, 4)),
    }


def _digest(value: Column) -> Column:
    return F.lower(strip_blanks(value))


def lookup_entries(text: Column) -> Column:
    """``array<struct<name, md5, size>>`` of all lookup-archive blocks, in order."""
    zipped = F.arrays_zip(_all(text, LOOKUP_BLOCK, 1).alias("n"),
                          _all(text, LOOKUP_BLOCK, 2).alias("m"),
                          _all(text, LOOKUP_BLOCK, 3).alias("s"))
    return F.transform(zipped, lambda e: F.struct(
        e["n"].alias("name"), _digest(e["m"]).alias("md5"), parse_long(e["s"]).alias("size")))


def data_entries(text: Column) -> Column:
    """``array<struct<name, md5, size, record_count>>`` of all data-file blocks."""
    zipped = F.arrays_zip(_all(text, DATA_BLOCK, 1).alias("n"),
                          _all(text, DATA_BLOCK, 2).alias("m"),
                          _all(text, DATA_BLOCK, 3).alias("s"),
                          _all(text, DATA_BLOCK, 4).alias("r"))
    return F.transform(zipped, lambda e: F.struct(
        e["n"].alias("name"), _digest(e["m"]).alias("md5"), parse_long(e["s"]).alias("size"),
        parse_long(e["r"]).alias("record_count")))


def manifest_date(file_name: Column) -> Column:
    """Delivery day from a manifest file name; NULL when it is no calendar day (e.g. month 13)."""
    return F.try_to_date(F.regexp_extract(file_name, MANIFEST_DATE, 1), "yyyy-MM-dd")
