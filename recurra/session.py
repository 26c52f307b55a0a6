"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# AQE coalesces small shuffle partitions and splits skewed ones at run time; both are
# relied on by the row-level joins, so they are named here and not left to defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints go with the last reference to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "recurra", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; a cluster without it is
    refused, because a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    session = spark.sparkContext.applicationId
    if session not in _local_folders:
        _local_folders[session] = tempfile.mkdtemp(prefix="recurra-checkpoint-")
    return _local_folders[session]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor and is computed once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
