"""A SparkSession with the settings the operators expect."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **config: str) -> SparkSession:
    """Adaptive execution splits skewed joins and joins small partitions; ANSI casts stay on."""
    builder = SparkSession.builder.appName("helixtab")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    return builder.config(map=settings | config).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; a temporary one for a local master, where none is set."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="helixtab-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")
