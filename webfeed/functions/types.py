"""Column typing for hit tables (names from the header, types from a fixed map).

Every column is nullable. A name that is not in the map is read as STRING, so a
new or unknown column never loses data. Matching is exact and case-sensitive.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Published data-feed column types that are not STRING. Everything else in the
# vendor's column reference is STRING, which is also our fallback, so only these
# exceptions are listed (alphabetical within each type).
LONG_COLUMNS = (
    "browser", "browser_height", "browser_width", "click_sourceid", "color",
    "country", "cust_hit_time_gmt", "first_hit_time_gmt", "geo_dma",
    "hit_time_gmt", "hitid_high", "hitid_low", "language", "last_hit_time_gmt",
    "last_purchase_num", "last_purchase_time_gmt", "mobile_id", "os",
    "post_browser_height", "post_browser_width", "post_cust_hit_time_gmt",
    "post_search_engine", "post_visid_high", "post_visid_low", "post_visid_type",
    "prev_page", "resolution", "search_engine", "search_page_num", "sourceid",
    "user_hash", "userid", "visid_high", "visid_low", "visid_timestamp",
    "visit_num", "visit_page_num", "visit_search_engine", "visit_start_time_gmt",
)
INTEGER_COLUMNS = (
    "c_color", "click_action_type", "click_context_type", "connection_type",
    "curr_factor", "daily_visitor", "duplicate_purchase", "hit_source", "mcvisid",
    "monthly_visitor", "new_visit", "post_page_event", "quarterly_visitor",
    "ref_type", "va_new_engagement", "weekly_visitor",
)
DOUBLE_COLUMNS = ("curr_rate",)
TIMESTAMP_COLUMNS = ("date_time",)

# Characters of a header name that are replaced by "_" (space , ; { } ( ) LF TAB =).
HEADER_SANITIZE_PATTERN = r"[ ,;{}()\n\t=]"
# ---------------------------------------------------------------------------

COLUMN_TYPES: dict[str, T.DataType] = {
    **{name: T.LongType() for name in LONG_COLUMNS},
    **{name: T.IntegerType() for name in INTEGER_COLUMNS},
    **{name: T.DoubleType() for name in DOUBLE_COLUMNS},
    **{name: T.TimestampType() for name in TIMESTAMP_COLUMNS},
}

LOOKUP_SCHEMA = T.StructType([
    T.StructField("lookup_key", T.StringType(), True),
    T.StructField("lookup_value", T.StringType(), True),
])


def column_type(name: str, overrides: dict[str, T.DataType] | None = None) -> T.DataType:
    """Type of one hit column: override, then the fixed map, then STRING."""
    if overrides and name in overrides:
        return overrides[name]
    return COLUMN_TYPES.get(name, T.StringType())


def feed_schema(names: Sequence[str],
                overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    """Positional schema for a headerless data file with these column names."""
    duplicates = sorted(n for n, k in Counter(names).items() if k > 1)
    if duplicates:
        raise ValueError(f"header has duplicate column names: {duplicates}")
    return T.StructType([T.StructField(n, column_type(n, overrides), True) for n in names])


def sanitized_header(text: Column) -> Column:
    """``column_headers.tsv`` text -> array of clean column names.

    Line ends and trailing tabs are stripped before splitting, so the last name
    does not pick up a trailing underscore from the final newline and no empty
    name is made from a final tab.
    """
    first_line = F.regexp_extract(text, "^\ufeff?([^\r\n]*)", 1)  # without a byte-order mark
    # trailing tabs name no column (an empty last name would become a column called "")
    names = F.split(F.regexp_replace(first_line, "\t+$", ""), "\t")
    return F.transform(names, lambda n: F.regexp_replace(n, HEADER_SANITIZE_PATTERN, "_"))

