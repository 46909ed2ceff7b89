"""Session defaults shared by jobs, tests and the bench.

Jobs never assume a local folder: the lineage-cutting directory comes from the
cluster's ``spark.checkpoint.dir``. Where that is unset, a ``local[...]`` master (tests, laptops)
gets a fresh scratch folder, and any other master an error.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on (time semantics, adaptive execution, state store).
# Shuffle partition counts are left to the cluster: set spark.sql.shuffle.partitions to
# roughly (largest shuffle bytes / 200 MB) and let AQE coalesce small stages.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    # keyed streaming state (route state, freshness aggregation) lives in RocksDB, not the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "milesbase", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Python workers and the state server of transformWithState talk over files, not over TCP ports
    conf["spark.python.unix.domain.socket.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime-settable part of SESSION_CONF (safe on a session someone else built)."""
    for k, v in SESSION_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # static or locked conf: leave the cluster's value
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; a session on a local master that names none gets a scratch
    folder, a cluster session without one is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext  # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="milesbase-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


_SHIPPED: list = []  # the contexts themselves: an id could be used again by a later one


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (mapInPandas, applyInPandasWithState)
    by zipping it and distributing it with ``addPyFile``, once per SparkContext."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: artifacts are managed by the client
        return
    if any(x is sc for x in _SHIPPED):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="milesbase-pkg-"), "milesbase.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.append(sc)
