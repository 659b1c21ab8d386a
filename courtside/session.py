"""Session helpers: the SQL settings the operators rely on and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings. Skewed join partitions are split even when the split costs a shuffle; batches
#: for Python are small, as a row may hold a long text.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return with_package(spark)


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did, as a session started from
    another folder would not find it. On a cluster the package is installed or sent with the job.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir`` where that is set.

    A machine-local folder is only ever chosen for a local master; on a cluster an unset
    folder is an error, since other executors could not read a local one.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="courtside-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def store(df: DataFrame) -> DataFrame:
    """Write the table under the checkpoint folder and go on from the written copy.

    That cuts the lineage, keeps column pruning, and tells the planner the real size. The copies
    stay until the folder is cleaned, like checkpoints do.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
