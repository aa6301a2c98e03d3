"""Session helpers: a tuned local session for tests/bench, and the shared folder.

On a cluster the session is built by ``spark-submit``; only ``shared_dir`` is used
there. It reads ``spark.checkpoint.dir`` from the running session; a folder of our own
is used only in local mode (tests), elsewhere a missing setting is an error.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

_FALLBACK_DIR = "/tmp/pulsegrid-shared"


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pulsegrid") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # keyed streaming state off-heap and incremental checkpoints (one buffer per series)
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set our own only in local mode when none is configured."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    target = conf or _FALLBACK_DIR
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir() or target


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path inside the shared checkpoint folder (visible to every executor)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    path = "/".join([base, "pulsegrid", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (only used by tests that inspect files)."""
    return path[5:] if path.startswith("file:") else os.fspath(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pulsegrid`` importable in Python workers (pandas functions pickle
    references to its modules). Zips the package once per process and adds it
    with ``addPyFile``, the same mechanism as ``spark-submit --py-files``; Spark
    copies it to every executor. Idempotent per SparkContext."""
    import hashlib
    import tempfile
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    digest = hashlib.sha1()
    files = []
    for dirpath, _, names in os.walk(pkg):
        for nm in sorted(names):
            if nm.endswith(".py"):
                full = os.path.join(dirpath, nm)
                files.append(full)
                with open(full, "rb") as fh:
                    digest.update(fh.read())
    out_dir = os.path.join(tempfile.gettempdir(), "pulsegrid-pyfiles")
    os.makedirs(out_dir, exist_ok=True)
    target = os.path.join(out_dir, f"pulsegrid-{digest.hexdigest()[:12]}.zip")
    if not os.path.exists(target):
        tmp = f"{target}.{uuid.uuid4().hex}"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
            for full in files:
                zf.write(full, os.path.relpath(full, root))
        os.replace(tmp, target)
    sc.addPyFile(target)
    _shipped.add(key)
