"""Structured Streaming: windowed counts with watermarks, the latest row of a key, files as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def files(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """Rows of files as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(kind).load(path)


def tumbling(stream: DataFrame, time: str, width: str, keys: list[str], value: str, late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """(keys, start, end, n, total) per window; rows later than the watermark are dropped by Spark."""
    spans = F.window(time, width, slide) if slide else F.window(time, width)
    out = stream.withWatermark(time, late).groupBy(*keys, spans.alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def sessions(stream: DataFrame, time: str, gap: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    out = stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def unique(stream: DataFrame, time: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def to_parquet(stream: DataFrame, path: str, checkpoint: str):
    """Write what has come so far and stop: a restart goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
