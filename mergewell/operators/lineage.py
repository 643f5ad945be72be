"""Plans that several consumers share are written once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder: ``spark.checkpoint.dir``, which all executors share.

    Only a local master may do without it and gets a temporary one; on a cluster
    no executor could read that.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the checkpoint folder: its plan is one scan, and lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same as Parquet: wide rows of numbers take a fraction of a checkpoint's disk, and readers of some columns read those."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
