"""Session helpers: a local session for tests and benches, and the shared scratch folder.

On a cluster the caller owns the session; the library only reads from it. Results do
not depend on session settings except the time zone of ``timestamp`` columns, which
must be UTC (``ensure_conf``).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Checked on the caller's session, set by ``local_session``.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "txsentry") -> SparkSession:
    """A local session for tests and benches (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**REQUIRED_CONF, **TUNING_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Set the required settings where the caller has set nothing; raise where the
    caller's value conflicts."""
    for k, v in REQUIRED_CONF.items():
        now = spark.conf.get(k, None)
        explicit = spark.sparkContext.getConf().contains(k) or now not in (None, _java_default(spark, k))
        if now == v:
            continue
        if explicit:
            raise ValueError(f"{k} is {now}; this package needs {v}")
        spark.conf.set(k, v)


def _java_default(spark: SparkSession, key: str) -> str | None:
    """The value a session takes when nobody sets the time zone: the JVM's own."""
    if key != "spark.sql.session.timeZone":
        return None
    return spark.sparkContext._jvm.java.util.TimeZone.getDefault().getID()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a fresh local folder is made for a local
    master only (tests, the driver's checks); on a cluster executors would each write
    to their own disk, so that raises.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = _LOCAL_SCRATCH.get(sc.applicationId)
    if not d:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="txsentry-ckpt-")
        _LOCAL_SCRATCH[sc.applicationId] = d
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_LOCAL_SCRATCH: dict[str, str] = {}
_MADE: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared scratch folder. It is removed when the
    ``scratch_scope`` around the call ends, at the latest when Python exits."""
    base = scratch_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append((spark, path))
    return path


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def mark_path(spark: SparkSession, path: str) -> None:
    """Create an empty file (a mark); an existing one stays."""
    fs, p = _file_system(spark, path)
    fs.create(p, True).close()


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this package wrote through the Hadoop file system of its URI, so
    it works the same on HDFS, object stores and local disk."""
    fs, p = _file_system(spark, path)
    return bool(fs.delete(p, True))


def _remove_from(mark: int) -> None:
    while len(_MADE) > mark:
        spark, path = _MADE.pop()
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001  a stopped session; the folder is scratch
            pass


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Remove every scratch path made inside when the block ends, also after an error."""
    mark = len(_MADE)
    try:
        yield
    finally:
        _remove_from(mark)


atexit.register(_remove_from, 0)
