"""Broadcast hints for metadata tables whose size is known on the driver.

Per-file and per-delivery tables are built from names the driver already holds
(manifest entries), so both their row count and an upper bound of their bytes
are known before the join is planned. A side is broadcast only when both are
under the limits; otherwise the join shuffles (and AQE may still pick a
broadcast from runtime sizes). Nothing whose size grows with the hit rows is
ever hinted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Fixed part of one row in Spark's row format (null bits, slots, a date, a long, a digest).
_ROW_OVERHEAD = 96
# Per string column: room for what qualifying a path adds (scheme, authority) and word padding.
_STRING_SLACK = 128


def row_bytes(*columns: Iterable[str]) -> int:
    """Upper bound of one row's bytes: fixed overhead plus, per string column, its
    longest value in UTF-8 and a fixed slack."""
    return _ROW_OVERHEAD + sum(max((len(v.encode("utf-8")) for v in col), default=0) + _STRING_SLACK
                               for col in columns)


def bounded_broadcast(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """``broadcast(df)`` when ``rows`` rows of at most ``bytes_per_row`` bytes fit the limits."""
    if rows <= MAX_BROADCAST_ROWS and rows * bytes_per_row <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    return df
