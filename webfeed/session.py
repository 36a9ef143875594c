"""Session helpers: the shared scratch folder and Hadoop file-system access.

Scratch data (test deliveries, lineage cuts) goes under the folder the cluster
names in ``spark.checkpoint.dir``. Only when that is unset (local tests) a fresh
folder is created and registered as the checkpoint directory.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .errors import DeliveryError


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this application.

    In local mode a fresh folder is made when none is configured; on a cluster
    a machine-local folder would not be seen by the executors, so
    ``spark.checkpoint.dir`` must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and every "
                               "executor can reach (HDFS, object store)")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def new_scratch_path(spark: SparkSession, prefix: str) -> str:
    """A new, unused folder name under the scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex[:12]}"


class HadoopFS:
    """Driver-side writes of small files through Hadoop FileSystem (any scheme the cluster supports)."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _resolve(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def write_bytes(self, path: str, data: bytes) -> None:
        fs, p = self._resolve(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()


# Schemes of file systems that a Python task can stream from (pyarrow); the rest is read by Spark only.
_TASK_SCHEMES = {"s3": "s3", "s3a": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}
# Hadoop settings that name what the task's client must know of an S3 store.
_S3_SETTINGS = {"access_key": "fs.s3a.access.key", "secret_key": "fs.s3a.secret.key",
                "session_token": "fs.s3a.session.token", "region": "fs.s3a.endpoint.region"}


@dataclass(frozen=True)
class TaskFolder:
    """A folder as Python tasks open it: mounts resolved, with the cluster's settings of its store."""

    base: str
    settings: tuple[tuple[str, str], ...] = ()

    def open(self, name: str, *, seekable: bool = False):
        """A file by its path relative to the folder, as stored (not decompressed)."""
        filesystem, path = task_file_system(f"{self.base.rstrip('/')}/{name}", self.settings)
        return filesystem.open_input_file(path) if seekable else filesystem.open_input_stream(path, compression=None)


def task_folder(spark: SparkSession, directory: str) -> TaskFolder | None:
    """``directory`` for Python tasks; None when its store is known to Spark's Hadoop client only.

    A mount of ``viewfs`` is resolved to the folder it stands for. Of S3 stores the keys, the endpoint and the
    region set for Hadoop are handed on.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(conf)
    # A folder that does not exist yet has no mount to resolve; it keeps its scheme.
    uri = (fs.resolvePath(p) if fs.exists(p) else fs.makeQualified(p)).toUri()
    scheme = (uri.getScheme() or "file").lower()
    if scheme not in ("file", *_TASK_SCHEMES):
        return None
    base = scheme + "://" + (uri.getAuthority() or "") + uri.getPath()
    return TaskFolder(base, store_settings(scheme, conf.get))


def check_streamable(path: str) -> None:
    """Refuse, before any job, a folder whose files tasks would have to open in an unknown file system."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme and scheme[1].lower() not in ("file", *_TASK_SCHEMES):
        raise DeliveryError(f"{path}: tasks cannot open files in {scheme[1]!r} storage")


def store_settings(scheme: str, get) -> tuple[tuple[str, str], ...]:
    """What the Hadoop settings (``get``) say about a store, in the words of the task's client."""
    if _TASK_SCHEMES.get(scheme) != "s3":
        return ()
    found = {name: get(key) for name, key in _S3_SETTINGS.items()}
    endpoint = get("fs.s3a.endpoint")
    if endpoint:
        plain, _, host = endpoint.rpartition("://")
        found["endpoint_override"] = host
        found["scheme"] = plain or ("http" if get("fs.s3a.connection.ssl.enabled") == "false" else "https")
    return tuple((k, v) for k, v in found.items() if v)


def task_file_system(path: str, settings: tuple[tuple[str, str], ...] = ()):
    """(pyarrow FileSystem, path) for reading or writing a file inside a Python task.

    ``path`` is a plain path or a URI with a verbatim (not percent-encoded) path.
    """
    from pyarrow import fs as pafs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    kind = _TASK_SCHEMES.get(scheme.lower())
    if kind is None:
        raise OSError(f"no task file system for {path}")
    if kind == "s3":
        return pafs.S3FileSystem(**dict(settings)), rest.lstrip("/")
    root, _, inner = rest.lstrip("/").partition("/")
    filesystem, base = pafs.FileSystem.from_uri(f"{kind}://{root}/")
    return filesystem, f"{base.rstrip('/')}/{inner}"
