"""What several operators share: tables, checkpoints and the word pattern."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a local master may do without one and gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage of ``df`` with a copy in the shared folder, which survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def seeded(seed: int, *keys: Column) -> Column:
    """A 60-bit pseudo-random number of the keys, the same in every run."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("null")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
