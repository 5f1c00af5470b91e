"""Lineage cuts for iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session's spark.checkpoint.dir names.

    A local master, as in tests, gets a temporary folder where none is set. A cluster must name one that its
    executors share: a folder of the driver's would lose data, so without one this raises.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or getattr(sc, "_petrel_folder", "")
    if not folder:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = sc._petrel_folder = tempfile.mkdtemp(prefix="checkpoints")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back.

    For states of many rounds: a checkpoint keeps its plan's size estimate, which joins multiply round by round
    until planning takes longer than the work; a table has the size of its files.
    """
    path = f"{shared_folder(df.sparkSession)}/state-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
