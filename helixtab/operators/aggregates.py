"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_where(df: DataFrame, group: list[str], of: Column, name: str, base: Column | None = None) -> DataFrame:
    """Share of a group's rows (of those in base) for which of holds; 0 if there are none."""
    base = F.lit(True) if base is None else base
    n = F.count_if(base)
    return df.groupBy(*group).agg(F.when(n > 0, F.count_if(base & of) / n).otherwise(0.0).alias(name))


def mean_where(df: DataFrame, group: list[str], value: Column, base: Column, name: str) -> DataFrame:
    """Mean over a group's rows in base, 0 if none."""
    return df.groupBy(*group).agg(F.coalesce(F.avg(F.when(base, value)), F.lit(0.0)).alias(name))


def groups_listed(df: DataFrame, group: list[str], name: str, qualifying: Column, least: int = 2, out: str = "names") -> DataFrame:
    """Groups with least rows or more of which least qualify, with their names sorted and joined by commas."""
    n, q = F.count("*").alias("n"), F.count_if(qualifying).alias("n_qualifying")
    grouped = df.groupBy(*group).agg(n, q, F.array_join(F.array_sort(F.collect_set(F.when(qualifying, F.col(name)))), ",").alias(out))
    return grouped.where((F.col("n") >= least) & (F.col("n_qualifying") >= least))


def contamination(df: DataFrame, tumor: str = "TumorId", gene: str = "Gene1", kind: str = "SV_Type", qualifying: Column | None = None, separator: str = ", ") -> DataFrame:
    """(tumor, genes): tumors with a gene that has two deletions or more, two of them qualifying; genes sorted and joined. Rows without a gene don't count."""
    q = F.lit(True) if qualifying is None else qualifying
    named = F.trim(F.coalesce(F.col(gene), F.lit(""))) != ""
    each = df.where((F.col(kind) == "DEL") & named).groupBy(tumor, gene).agg(F.count("*").alias("n"), F.count_if(q).alias("q")).where("n >= 2 and q >= 2")
    return each.groupBy(tumor).agg(F.array_join(F.array_sort(F.collect_set(gene)), separator).alias("genes"))


def like_cdna(site1: str = "Site1Description", site2: str = "Site2Description", fusion: str = "Fusion", breakpoint: str = "BrkptType") -> Column:
    """A precise deletion that isn't between exons and makes no fusion, in frame or out of frame."""
    frame = F.col(fusion).contains("in frame") | F.col(fusion).contains("out of frame")
    exons = F.col(site1).contains("Exon") & F.col(site2).contains("Exon")
    return ~(F.coalesce(exons, F.lit(False)) | F.coalesce(frame, F.lit(False)) | F.coalesce(F.col(breakpoint) == "IMPRECISE", F.lit(False)))


def percents(df: DataFrame, group: list[str], part: str, whole: str, name: str, digits: int | None = None) -> DataFrame:
    """100 * summed part / summed whole, 0 where the whole is 0."""
    sums = df.groupBy(*group).agg(F.sum(part).alias(part), F.sum(whole).alias(whole))
    p = F.when(F.col(whole) == 0, 0.0).otherwise(100 * F.try_divide(F.col(part), F.col(whole)))
    return sums.withColumn(name, F.bround(p, digits) if digits is not None else p)


def means(df: DataFrame, group: list[str], values: dict[str, int]) -> DataFrame:
    """Means rounded half-even to so many digits."""
    return df.groupBy(*group).agg(*[F.bround(F.avg(v), d).alias(f"mean_{v}") for v, d in values.items()])


def totals(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*group).agg(*[F.sum(v).alias(v) for v in values])


def medians(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Exact medians."""
    return df.groupBy(*group).agg(*[F.median(v).alias(f"median_{v}") for v in values])


def peak(df: DataFrame, group: list[str], key: str, count: str, first: int | None = None) -> DataFrame:
    """The key of the highest count per group, the smallest on ties; only among the first so many keys, if given."""
    if first is not None:
        df = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*group).orderBy(key))).where(F.col("_nth") <= first)
    return df.groupBy(*group).agg(F.min_by(key, F.struct(-F.col(count), F.col(key))).alias("peak"), F.max(count).alias("peak_count"))


def distinct_over(df: DataFrame, columns: list[str], name: str = "n") -> DataFrame:
    """Number of different values in the union of columns."""
    return df.select(F.explode(F.array(*columns)).alias("v")).agg(F.count_distinct("v").alias(name))


def extremes(df: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    return df.groupBy(*group).agg(F.min(start).alias(start), F.max(end).alias(end))


def low_share(df: DataFrame, key: str, value: str, most: float = 0.2) -> DataFrame:
    """df with value set to null for the keys of which more than a share is missing."""
    bad = df.groupBy(key).agg(F.avg(F.col(value).isNull().cast("int")).alias("_share")).where(F.col("_share") > most).select(key, F.lit(True).alias("_bad"))
    return df.join(bad, key, "left").withColumn(value, F.when(F.col("_bad").isNull(), F.col(value))).drop("_bad")


def noise(df: DataFrame, group: list[str], value: str, most_missing: int = 100) -> DataFrame:
    """Sum of squares per group, null if more than most_missing values are."""
    return df.groupBy(*group).agg(F.when(F.count_if(F.col(value).isNull()) <= most_missing, F.sum(F.col(value) * F.col(value))).alias("noise"))


def cluster_stats(df: DataFrame, group: list[str], cluster: str, value: str) -> DataFrame:
    """Mean, sd, number and share of each cluster in its group."""
    by = df.groupBy(*group, cluster).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"))
    return by.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*group)))


def alignment_stats(df: DataFrame, group: list[str]) -> DataFrame:
    """Counts of alignments by flag, and mean and median of positive insert sizes."""
    bit = lambda n: F.col("flag").bitwiseAND(n) != 0
    mapped, pair = ~bit(4), bit(1)
    first_insert = pair & bit(64) & mapped & ~bit(8) & (F.col("insert_size") != 0)
    size = F.when(first_insert, F.abs("insert_size"))
    counts = {
        "total": F.lit(True), "mapped": mapped, "forward": ~bit(16), "reverse": bit(16), "qc_fail": bit(512), "duplicate": bit(1024), "paired": pair,
        "proper": bit(2), "both_mapped": pair & mapped & ~bit(8), "first": bit(64), "second": bit(128), "singleton": pair & mapped & bit(8),
    }
    return df.groupBy(*group).agg(*[F.count_if(c).alias(n) for n, c in counts.items()], F.avg(size).alias("mean_insert"), F.percentile(size, 0.5).alias("median_insert"))


def read_groups(df: DataFrame, group: str = "read_group", middle: float = 0.9) -> DataFrame:
    """Fragment lengths per read group: median and the bounds that hold the middle share."""
    size = F.when(F.col("insert_size") > 0, F.col("insert_size"))
    tail = (1 - middle) / 2
    return df.groupBy(group).agg(F.count(size).alias("n"), F.percentile(size, 0.5).alias("median"), F.percentile(size, tail).alias("low"), F.percentile(size, 1 - tail).alias("high"))
