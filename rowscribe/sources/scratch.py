"""Where intermediate tables go: the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session, whose
    executors share the driver's disk, may do without it."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="rowscribe-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
