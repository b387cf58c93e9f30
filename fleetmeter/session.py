"""Where jobs may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetmeter.sources.tables import remove_folder

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Without the setting, the checkpoint folder given to the context is taken. A local
    session without either gets a temporary folder; on a cluster one of them is required,
    because a folder of one machine would not be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fleetmeter-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder, never used before."""
    folder = f"{shared_folder(spark)}/fleetmeter/{purpose}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def remove_work_folders(spark: SparkSession) -> None:
    """Remove all work folders that this process has named so far.

    Results that read from them must have been written or shown before. Checkpoints are removed
    by Spark itself if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    while _made:
        remove_folder(spark, _made.pop())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
