"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs are written for. Partition counts stay with the
# deployment: AQE coalesces from `spark.sql.shuffle.partitions`, so size that
# to total shuffle bytes / ~200 MB.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when a later aggregate must then re-shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "rowwarden", master: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="rowwarden-ckpt-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and read on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
