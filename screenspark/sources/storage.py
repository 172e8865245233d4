"""The folder that driver and executors share: checkpoints, and tables between stages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from screenspark.model import CountMatrix


def shared_folder(spark: SparkSession) -> str:
    """The one that the cluster names in ``spark.checkpoint.dir``.  Where that is unset a
    local one is taken, but only if all runs on this machine, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/screenspark-checkpoints"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint of the rows in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def settled_matrix(m: CountMatrix) -> CountMatrix:
    return CountMatrix(settled(m.obs), settled(m.var), settled(m.x))
