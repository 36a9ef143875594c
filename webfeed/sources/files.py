"""Relations over the files that manifests name, keyed by path relative to the delivery folder.

A few files are given to Spark by name. More are read by listing the folders that
hold them once and keeping the named files by a filter on ``_metadata.file_path``,
which Spark applies to the file index when it plans the scan, so the others are not
opened. The filter compares the URIs as the index has them, so that for the rows of
a file nothing is decoded. Both forms return the same rows; a name listed several
times is read as often.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from .. import paths
from ..functions.files import raw_path, relative_name

# Up to this many files are addressed by exact name (a few metadata calls each).
DIRECT_FILES = 32
_NO_AUTHORITY = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*:)///")
_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")


def not_found(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def root_path(spark: SparkSession, directory: str) -> str:
    """The path part (no scheme, no authority) of a folder, as its file system qualifies it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().getPath()


def _listed(files: DataFrame, root: str, wanted: Counter) -> dict[str, str]:
    """Relative name -> URI of the wanted files in a relation's index (empty files included; no job).

    The URI is as ``_metadata.file_path`` has it, which writes no empty authority.
    """
    start = len(root.rstrip("/")) + 1
    return {name: _NO_AUTHORITY.sub(r"\1/", p) for p in files.inputFiles()
            if (name := _SCHEME.sub("", unquote(p))[start:]) in wanted}


class Files:
    """A relation over named files: the names that ``exist`` with their URIs, and their rows (``select``)."""

    def __init__(self, spark: SparkSession, directory: str, names: list[str],
                 load: Callable[[list[str]], DataFrame], direct: int | None = None):
        self.root = root_path(spark, directory)
        self.exist: dict[str, str] = {}
        self._parts: list[DataFrame] = []
        wanted = Counter(paths.normal(n) for n in names)
        if wanted and len(wanted) <= (DIRECT_FILES if direct is None else direct):
            try:
                self._parts = [load(paths.literal_paths(directory, sorted(wanted.elements())))]
                self.exist = _listed(self._parts[0], self.root, wanted)
                return
            except AnalysisException as e:
                if not not_found(e):
                    raise
        folders = _existing(spark, directory, sorted({n.rpartition("/")[0] for n in wanted}))
        if folders:
            every = load(folders)
            self.exist = _listed(every, self.root, wanted)
            # as often as listed: one part for the names listed once or more, one for twice or more, ...
            self._parts = [every.where(raw_path().isin([uri for n, uri in self.exist.items() if wanted[n] >= k]))
                           for k in range(1, max((wanted[n] for n in self.exist), default=0) + 1)]

    def missing(self, names: list[str]) -> list[str]:
        return sorted({n for n in names if paths.normal(n) not in self.exist})

    def name(self) -> Column:
        """Relative name of the file each row was read from (for relations of one row per file)."""
        return relative_name(self.root)

    def select(self, *columns, where: Column | None = None) -> DataFrame | None:
        """Columns of the files' rows (``_metadata`` can be used), or None when no file exists."""
        parts = [p if where is None else p.where(where) for p in self._parts]
        return reduce(lambda a, b: a.unionAll(b), [p.select(*columns) for p in parts]) if parts else None


def _existing(spark: SparkSession, directory: str, relative: list[str]) -> list[str]:
    """Reader-safe paths of those folders that exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for r in relative:
        p = jvm.org.apache.hadoop.fs.Path(directory.rstrip("/") + ("/" + r if r else ""))
        if p.getFileSystem(conf).exists(p):
            found.append(paths.glob_escape(directory.rstrip("/")) + ("/" + paths.glob_escape(r) if r else ""))
    return found
