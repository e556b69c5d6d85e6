"""Cutting a plan by writing it to the shared folder and reading it again.

A written table survives lost executors, and what several branches of a plan
use is computed once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session on one machine may
    leave it unset; it then has a folder of its own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="nasij-"))


def cut(df: DataFrame) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/nasij/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
