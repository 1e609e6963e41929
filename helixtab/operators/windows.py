"""Ordered scans: islands, clusters, ranks, adjusted p-values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixtab.operators.scans import LAST, LEAST, SUM, kept, ranged, scan


def _by(group: list[str], order: list[Column | str]):
    return Window.partitionBy(*group).orderBy(*order)


def counter_per_run(df: DataFrame, group: list[str], order: list[Column | str], key: str, name: str = "nth") -> DataFrame:
    """Numbers rows from 1 within each run of rows of one key."""
    by = _by(group, order)
    runs = df.withColumn("_run", F.sum((~F.col(key).eqNullSafe(F.lag(key).over(by)) | (F.row_number().over(by) == 1)).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.withColumn(name, F.row_number().over(_by([*group, "_run"], order))).drop("_run")


def longest_run(df: DataFrame, group: list[str], order: list[str], holds: Column, name: str = "longest") -> DataFrame:
    """Length of the longest stretch of rows for which a condition holds, 0 if never. A group may have any number of rows."""
    rows = ranged(df.select(*dict.fromkeys([*group, *order]), F.coalesce(holds, F.lit(False)).alias("_on")), group, order)
    runs = scan(rows, group, order, {"_break": (SUM, (~F.col("_on")).cast("long"))})
    each = runs.groupBy(*group, "_break").agg(F.count_if("_on").alias("_n"))
    return each.groupBy(*group).agg(F.max("_n").alias(name))


def gap_clusters(df: DataFrame, group: list[str], value: str, gap: float = 0.08, least: int = 1, name: str = "cluster") -> DataFrame:
    """Different values per group in order, numbered by clusters that gaps above gap part; a cluster of fewer than least values is 0. A group may have any number of values."""
    levels = ranged(df.where(F.col(value).isNotNull()).select(*group, value).distinct(), group, [value])
    after = scan(levels, group, [value], {"_before": (LAST, F.col(value))}, before=True)
    new = F.coalesce((F.col(value) - F.col("_before") > gap).cast("int"), F.lit(1))
    numbered = scan(after, group, [value], {name: (SUM, new)}).select(*group, value, name)
    size = numbered.groupBy(*group, name).agg(F.count("*").alias("_size")).where(F.col("_size") < least)
    small = size.select(*(F.col(c).alias(f"_s_{c}") for c in (*group, name)))
    same = F.lit(True)
    for c in (*group, name):
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return numbered.join(small, same, "left").select(*group, value, F.when(F.col(f"_s_{name}").isNotNull(), 0).otherwise(F.col(name)).alias(name))


def dense(df: DataFrame, group: list[str], position: str, within: float, least: int = 3, order: list[str] = (), name: str = "dense") -> DataFrame:
    """Marks rows in some stretch of least rows no longer than within: the k-th neighbour is near enough."""
    by = _by(group, [position, *order])
    k = least - 1
    near = F.lit(False)
    for back in range(k + 1):  # the row is the back-th of its stretch
        lo = F.lag(position, back).over(by) if back else F.col(position)
        hi = F.lead(position, k - back).over(by) if back < k else F.col(position)
        near = near | F.coalesce(hi - lo <= within, F.lit(False))
    return df.withColumn(name, near)


def adjust(df: DataFrame, group: list[str], p: str, name: str = "p_adjusted") -> DataFrame:
    """Benjamini-Hochberg: least of p * n / rank over this and larger p-values; missing ones don't count.

    Different p-values are counted first and scanned in ranges, so a group may have any number of rows. df is written once, so that p-values meet their own.
    """
    df = kept(df)
    own = [f"_g{i}" for i in range(len(group))]
    keys = [F.col(c).alias(k) for c, k in zip(group, own, strict=True)]
    counts = df.where(F.col(p).isNotNull()).groupBy(*keys, F.col(p).alias("_p")).agg(F.count("*").alias("_m"))
    levels = ranged(counts, own, ["_p"])
    total = levels.groupBy(*own).agg(F.sum("_m").alias("_n")).select(*(F.col(k).alias(f"{k}t") for k in own), "_n")
    same = F.lit(True)
    for k in own:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}t"))
    ranks = scan(levels, own, ["_p"], {"_last": (SUM, F.col("_m"))}).join(total, same).withColumn("_raw", F.col("_p") * F.col("_n") / F.col("_last"))
    found = scan(ranks.select(*own, "_p", "_range", "_raw"), own, ["_p"], {"_least": (LEAST, F.col("_raw"))}, reverse=True).select(*own, "_p", "_least")
    met = F.col(p) == F.col("_p")
    for c, k in zip(group, own, strict=True):
        met = met & F.col(c).eqNullSafe(F.col(k))
    return df.join(found, met, "left").withColumn(name, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.col("_least")))).select(*df.columns, name)


def least_of(df: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("_nth", F.row_number().over(_by(group, order))).where("_nth = 1").drop("_nth")


def head(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(_by(group, order))).where(F.col("_nth") <= n).drop("_nth")


def share_of_total(df: DataFrame, group: list[str], value: str, name: str = "share") -> DataFrame:
    return df.withColumn(name, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*group))))


def numbered(df: DataFrame, group: list[str], order: list[Column | str], prefix: Column, name: str = "label") -> DataFrame:
    """Labels such as INTRON_target_7: each row's number in its group."""
    return df.withColumn(name, F.concat(prefix, F.row_number().over(_by(group, order)).cast("string")))


def barcodes(df: DataFrame, order: list[Column | str], group: list[str] = (), form: str = "bc%04d", name: str = "barcode") -> DataFrame:
    return df.withColumn(name, F.format_string(form, F.row_number().over(_by(list(group), order))))


def differences(df: DataFrame, group: list[str], order: list[Column | str], value: str, name: str = "difference") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(_by(group, order)))


def latest(df: DataFrame, date: str, order: list[Column]) -> DataFrame:
    """Rows whose date is that of the last row in order."""
    last = df.agg(F.max_by(date, F.struct(*order)).alias("_date"))
    return df.join(last, F.col(date) == F.col("_date")).drop("_date")
