"""Session settings and the shared scratch folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. All are runtime SQL settings, so they can be
# applied to a session somebody else built. Shuffle width is left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's checkpoint folder.

    Only where the session names none and its master is local (tests on one
    machine) is a temporary folder made, and then named in the session for later calls.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    base = spark.conf.get("spark.telemark.scratch", None)
    if not base and not spark.conf.get("spark.master", "local").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.telemark.scratch", base)
    return base


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or cleared."""
    return os.path.join(shared_folder(spark), "telemark", f"{label}-{uuid.uuid4().hex}")
