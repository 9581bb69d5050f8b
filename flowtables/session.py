"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for. They are all ordinary Spark options;
# a cluster that already sets them keeps its own values.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # secrets of the field-crypto plan are literals in the query plan
    "spark.sql.redaction.string.regex": r"[xX]'[0-9A-Fa-f]{32,}'|(?<![0-9a-zA-Z])[0-9a-f]{64}(?![0-9a-zA-Z])",
}


def build_session(app_name: str = "flowtables", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, state tables and intermediate tables.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A
    machine-local folder is used only in local mode, where every task runs on
    the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir() + "/flowtables-scratch"
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
