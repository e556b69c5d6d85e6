"""Session builder with the settings that the engine is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName("nasij")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"} | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
