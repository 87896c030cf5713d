"""The folder all executors share, and rows kept there while a plan runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir`` if it is not set yet.

    A cluster needs one that all executors share; without one, or with a folder of this machine, this
    raises. Only a session that runs on this machine alone falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    local = context.master.startswith("local")
    if folder is None:
        if not local:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gridtally-")
    if folder.startswith(("file:/tmp/", "file:///tmp/", "/tmp/")) and not local:
        raise ValueError(f"{folder} is a folder of one machine; a cluster needs a shared one")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses. Its rows stay until the folder is deleted."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """``frame``, run once and kept by a reliable checkpoint, so that a lost executor costs nothing."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def free_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, lengthened until no column of ``frames`` is called so."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
