"""Session construction and shared-folder helpers.

Intermediate data that must survive executor loss (checkpoints, versioned
tables, streaming checkpoints, sinks written by a job and read back) lives
under the shared folder named by ``spark.checkpoint.dir``.  The setting is
read from the session; a local fallback is only created when it is unset
(tests on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "chunkwise", **extra: str) -> SparkSession:
    """Session with AQE on, UTC, Arrow, no UI.  For tests and the bench."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # positional checkpoints are full (projected) copies: drop them once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in extra.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else "remote"
        if master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all "
                             f"executors share (master {master})")
        configured = tempfile.mkdtemp(prefix="chunkwise-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """Folder for job-written tables: a ``chunkwise`` sibling of the checkpoints."""
    ckpt = ensure_checkpoint_dir(spark)
    base = ckpt.rstrip("/")
    return base + "/chunkwise-data"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared folder (never reused between runs)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few local-only helpers (tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors (once an application), for the operators whose task
    functions import it there; ``--py-files`` does the same from outside.  The archive is
    read by the driver alone; Spark passes it on."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
