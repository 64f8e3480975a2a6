"""Folders for data a job keeps between its steps."""

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the one the session names in ``spark.checkpoint.dir``.

    Where that is unset, it lies below the warehouse folder, which all executors share too.
    """
    root = spark.conf.get(_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_between_steps"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable where the session did not set it up."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
