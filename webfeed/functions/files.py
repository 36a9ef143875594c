"""Input-file columns.

``_metadata.file_name`` / ``file_path`` are URI-encoded (a space is ``%20``,
``[`` is ``%5B``), while manifests name files verbatim; these helpers decode
them. ``+`` is kept literal (URI paths do not encode a space as ``+``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decode(c: Column) -> Column:
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


def input_file_name() -> Column:
    """Verbatim name (last path segment) of the file a row was read from."""
    return _decode(F.col("_metadata.file_name"))


def input_file_path() -> Column:
    """Verbatim path of the file a row was read from."""
    return _decode(F.col("_metadata.file_path"))


def normal_name(name: Column) -> Column:
    """``paths.normal`` as an expression."""
    return F.regexp_replace(F.regexp_replace(name, "/+", "/"), "^/", "")


def raw_path() -> Column:
    """URI of the file a row was read from, as the file index has it: nothing is computed per row."""
    return F.col("_metadata.file_path")


def relative_name(root: str, uri: Column | None = None) -> Column:
    """Verbatim path of a file (by default the one a row was read from), relative to the folder ``root``.

    ``root`` is a path without scheme and authority (:func:`webfeed.sources.files.root_path`). For tables of
    one row per file: rows of hits are told apart by :func:`raw_path`.
    """
    path = _decode(F.regexp_replace(raw_path() if uri is None else uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""))
    return F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)
