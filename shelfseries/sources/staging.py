"""Holding an intermediate result so that several passes do not recompute it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(df: DataFrame) -> str | None:
    """The shared folder the cluster names, or None when it names none."""
    return df.sparkSession.conf.get(CHECKPOINT_DIR, None) or None


def hold(df: DataFrame, name: str) -> DataFrame:
    """``df`` evaluated once for the passes that follow.

    With a shared folder the rows become a Parquet table in it: later passes
    read only the columns they need, and the loss of an executor costs nothing.
    Without one the rows are persisted with spill to disk, and a lost block is
    recomputed from the lineage.
    """
    folder = shared_folder(df)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/shelfseries/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path for a table that nothing has used before: in the shared folder, or for a local session in a temporary one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} is not set: executors of a cluster share no temporary folder")
        folder = "file://" + tempfile.mkdtemp(prefix="shelfseries-")
    return f"{folder.rstrip('/')}/shelfseries/{name}-{uuid.uuid4().hex}"
