"""Session helpers: sane defaults for the pipeline and a shared work folder.

On a cluster the session is built by the platform; ``get_session`` only fills
settings that are unset. Intermediate tables go to the folder named by
``spark.checkpoint.dir`` (a shared file system on a cluster), never to a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the pipeline relies on; applied only when the session lacks them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM does not compile methods above 8,000 bytes: a generated stage with one runs
    # interpreted, slower than the same operators without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app_name: str = "occurlens",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               # checkpoint files of DataFrames that are gone are removed
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Apply DEFAULT_CONF to runtime settings that are still unset."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    work_root(spark)


def compiled_stages(spark: SparkSession) -> None:
    """The limit on generated methods alone, where unset: for tables whose stages have many expressions."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, DEFAULT_CONF[key])


_HELD: dict[tuple[str, str], int] = {}  # (session, setting): blocks of ``held_settings`` that hold it
_HELD_LOCK = threading.Lock()


@contextmanager
def held_settings(spark: SparkSession, conf: dict[str, str]):
    """Runtime settings for the time of a block, where the session has none of its own. Blocks of
    several threads may overlap: the last one to end takes a setting back."""
    session, mine = spark._jsparkSession.sessionUUID(), []
    try:
        for key, value in conf.items():
            with _HELD_LOCK:
                if (session, key) not in _HELD:
                    if spark.conf.get(key, None) is not None:
                        continue
                    spark.conf.set(key, value)
                _HELD[session, key] = _HELD.get((session, key), 0) + 1
                mine.append(key)
        yield
    finally:
        for key in mine:
            with _HELD_LOCK:
                _HELD[session, key] -= 1
                if not _HELD[session, key]:
                    del _HELD[session, key]
                    spark.conf.unset(key)


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session of the same application and settings in which column names differ by case."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    Taken from the session's checkpoint folder (``spark.checkpoint.dir``). A fresh
    machine-local one is made only in local mode (tests, benches); on a cluster,
    where executors could not see it, an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="occurlens-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
