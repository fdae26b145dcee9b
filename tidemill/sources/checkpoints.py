"""Folders that the driver and all executors share, and frames whose lineage ends there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: With this setting the files of a plan's shuffles go when its action ends, and not when the driver happens to collect its garbage.
_ENDS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only on a local master, as in tests, is a temporary folder made where none is
    set: executors elsewhere could not read it, so there it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured or tempfile.mkdtemp(prefix="checkpoint-")


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder there."""
    return f"{shared_root(spark)}/tidemill-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there. Spark removes the files of a checkpoint that nothing refers to
    any more where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, and the shuffles that made ``df`` leave the disk at once."""
    conf = df.sparkSession.conf
    before = conf.get(_ENDS_SHUFFLES, None)
    conf.set(_ENDS_SHUFFLES, "true")
    try:
        return checkpointed(df.select("*"))  # planned anew, with the setting
    finally:
        conf.unset(_ENDS_SHUFFLES) if before is None else conf.set(_ENDS_SHUFFLES, before)
