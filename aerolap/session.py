"""Spark session defaults and the shared scratch folder.

Every job here is a plain DataFrame plan, so the only session settings that
matter are the ones that steer Catalyst and AQE: adaptive execution (runtime
coalescing, skew-join splitting, broadcast conversion from real sizes), a
broadcast threshold that is an explicit size check, UTC session time, and the
UI off.

Scratch data (ingest outputs, stream inputs, checkpoints, upsert tables) goes
under ``spark.checkpoint.dir``. On a cluster that setting names a shared
folder and is read from the session; only a local session without it gets a
fresh folder of its own, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Largest side Spark may broadcast in a join, checked against plan statistics
# (file sizes before the shuffle, real sizes after it under AQE). Anything
# bigger falls back to a shuffled sort-merge join.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Sizing for a cluster run over ``input_bytes`` of flight data.

    The initial shuffle width is input / 256 MB (at least 200), so every
    shuffle partition of the first, largest exchange fits an executor task
    comfortably; AQE then coalesces small partitions (the rankings shrink
    to a few thousand rows after the partial aggregate) and splits skewed
    sort-merge join partitions. Scans split files at the same size.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    size = f"{target_partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * (target_partition_bytes >> 20)}m",
    }


def build_session(master: str | None = None, app: str = "aerolap",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``input_bytes`` (cluster runs) sizes shuffles and scan splits with
    ``cluster_conf``; tests and the bench pass ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if input_bytes is not None:
        conf.update(cluster_conf(input_bytes))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only for local runs.

    The cluster names it in ``spark.checkpoint.dir``; a local session without
    it (tests, the bench) gets a fresh folder under the system temp dir.
    """
    global _LOCAL_DIR
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared "
                "folder for checkpoints and scratch tables")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="aerolap-ckpt-")
        path = _LOCAL_DIR
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/aerolap/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` or bare paths, ``None`` for other URIs
    (with one slash or two)."""
    if path.startswith("file:"):
        p = path[5:]
        while p.startswith("//"):
            p = p[1:]
        return p
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:/", path):
        return None
    return os.path.abspath(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    Functions run by Arrow and pandas maps are sent by name, so every worker
    needs the package. An installed package (``pip install .``) is found
    anyway; this sends a copy with the application, once per context.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="aerolap-pkg-"), "aerolap-src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
