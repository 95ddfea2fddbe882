"""Spark session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Merge session windows before the shuffle, so a busy key sends sessions instead of events.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state on disk with timers and several variables a key; state as large as memory is no limit there.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Those that results or a busy key's shuffle depend on, set on sessions made elsewhere too.
RUNTIME_CONF = (
    "spark.sql.session.timeZone",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition",
    "spark.sql.streaming.stateStore.providerClass",
)


def get_session(app_name: str = "tidegauge", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or return) a session with the settings every operator here relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder used for reliable checkpoints.

    ``spark.checkpoint.dir`` names the folder shared by all executors. Only a local master may fall back
    to a folder of its own, because there every executor lives on this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidegauge-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidegauge-"), "tidegauge.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tidegauge", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
