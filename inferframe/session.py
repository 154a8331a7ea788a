"""Session helpers: a tuned local session for tests/bench and the shared folder for lineage cuts.

On a cluster the session comes from the caller; nothing here overrides settings that are
already present. ``shared_dir`` reads ``spark.checkpoint.dir`` from the session and only
falls back to a fresh local folder when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "inferframe") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC, Arrow on."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("INFERFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``inferframe`` importable in the Python workers of this session's executors
    (the runtime form of ``--py-files``): the package is zipped once on the driver and
    added with ``SparkContext.addPyFile``; Spark distributes it to every executor."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="inferframe-pyfiles-"), "inferframe.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local-mode session without
    the setting (tests, single-machine runs) gets a fresh local folder; on a cluster the
    setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        # a machine-local folder is not shared by executors and is lost with them
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster "
                           "file system) before running jobs that store answers or streams")
    local = tempfile.mkdtemp(prefix="inferframe-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (for written tables, stream
    sinks and stream checkpoints)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
