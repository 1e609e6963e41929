"""Sequencing metrics: sections of small text files, one file a row until cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.functions import scalars as X


def _whole(spark: SparkSession, pattern: str, sample: str) -> DataFrame:
    return spark.read.text(pattern, wholetext=True).select("value", F.regexp_extract("_metadata.file_path", sample, 1).alias("sample"))


def _section(spark: SparkSession, pattern: str, mark: str, sample: str) -> DataFrame:
    """(sample, header, line, n) of the block that follows a line with mark, up to an empty line."""
    block = F.regexp_extract("value", rf"(?m)^## {mark}[^\n]*\n((?:[^\n]+\n?)+)", 1)
    lines = _whole(spark, pattern, sample).select("sample", F.filter(F.split(block, "\n"), lambda x: x != "").alias("l")).where(F.size("l") > 0)
    return lines.select("sample", F.split(F.get("l", F.lit(0)), "\t").alias("header"), F.posexplode(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0)))).alias("n", "line"))


def metrics(spark: SparkSession, pattern: str, sample: str = r"([^/]+)$") -> DataFrame:
    """(sample, n, metric, value): rows of metrics files, by name, so files with other columns go together."""
    rows = _section(spark, pattern, "METRICS CLASS", sample)
    cells = F.split("line", "\t", -1)
    named = F.transform("header", lambda h, i: F.struct(h.alias("metric"), F.get(cells, i).alias("value")))
    return rows.select("sample", "n", F.explode(named).alias("m")).select("sample", "n", "m.*")


def histogram(spark: SparkSession, pattern: str, sample: str = r"([^/]+)$") -> DataFrame:
    """(sample, n, key, value): the first two columns of histogram files."""
    rows = _section(spark, pattern, "HISTOGRAM", sample)
    cells = F.split("line", "\t")
    return rows.select("sample", "n", F.get(cells, F.lit(0)).cast("double").alias("key"), F.get(cells, F.lit(1)).cast("double").alias("value"))


def key_values(spark: SparkSession, pattern: str, keys: dict[str, str], sample: str = r"([^/]+)$") -> DataFrame:
    """(sample, ...): numbers that follow phrases in logs, such as 'Total reads processed: 1,234'; the largest if repeated."""
    every = lambda phrase: F.transform(F.regexp_extract_all("value", F.lit(rf"{phrase}\s*:?\s*([\d,.]+)"), F.lit(1)), X.local_number)
    return _whole(spark, pattern, sample).select("sample", *[F.array_max(every(p)).alias(n) for n, p in keys.items()])


def wide_metrics(long: DataFrame, names: list[str]) -> DataFrame:
    """(sample, n, ...) numbers of the metrics named."""
    return long.groupBy("sample", "n").pivot("metric", names).agg(F.first(X.metric_value(F.col("value"))))


def neither(unmapped, unpaired, clamp: bool = True):
    """Pairs of which neither read is aligned."""
    n = (unmapped - unpaired) / 2
    return F.greatest(F.lit(0.0), n) if clamp else n
