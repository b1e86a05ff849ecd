"""Where jobs may put intermediate tables, checkpoints and merge results."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local-mode session without the setting gets a temporary folder of its
    own; on a cluster a missing setting is an error, because a machine-local path
    would vanish with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="panelwright-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/panelwright/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage at a table that survives its executors; for results that
    several later steps read.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
