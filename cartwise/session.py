"""Session settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Everything here is a stock Spark setting; cluster sizing (executors, memory,
# shuffle partitions) stays with the submitter.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "cartwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine, since there every task runs here.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    # Not local-cluster, whose executors are other processes with folders of their own.
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="cartwise-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder
