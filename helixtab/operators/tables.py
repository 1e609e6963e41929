"""Set operations, reshaping, upserts and order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixtab.operators.scans import SUM, ranged, scan

from helixtab.functions import scalars as X


class SchemaMismatch(ValueError):
    """Tables to be put together differ in their columns."""


def union_checked(*frames: DataFrame) -> DataFrame:
    """All rows of tables that must have the same columns, by name."""
    names = [set(f.columns) for f in frames]
    if any(n != names[0] for n in names[1:]):
        raise SchemaMismatch(f"columns differ: {sorted(set.union(*names) - set.intersection(*names))}")
    return reduce(DataFrame.unionByName, frames)


def union_with_source(frames: dict[str, DataFrame], name: str = "Sample") -> DataFrame:
    return reduce(DataFrame.unionByName, [f.withColumn(name, F.lit(k)) for k, f in frames.items()])


def upsert(store: DataFrame, new: DataFrame, key: list[str], order: list[Column] = ()) -> DataFrame:
    """store with the rows of new in place of those with their key; of rows with one key the first in order wins, then the one of the least hash."""
    tagged = store.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    hashed = F.xxhash64(*[c for c in tagged.columns if c != "_turn"])
    by = Window.partitionBy(*key).orderBy(F.desc("_turn"), *order, hashed)
    return tagged.withColumn("_nth", F.row_number().over(by)).where("_nth = 1").drop("_nth", "_turn")


def distinct_sorted(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def except_keys(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return left.join(right.select(*key).distinct(), key, "left_anti")


def common_keys(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return left.select(*key).distinct().join(right.select(*key).distinct(), key)


def shares_group(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def is_subset(values: Column, allowed: Column) -> Column:
    return F.size(F.array_except(values, allowed)) == 0


def pivot(df: DataFrame, rows: list[str], column: str, values: list, value: Column, fill=None) -> DataFrame:
    """A column for each of values; cells without rows get fill."""
    wide = df.groupBy(*rows).pivot(column, values).agg(value)
    if fill is None:
        return wide
    return wide.select(*rows, *[F.coalesce(F.col(f"`{v}`"), F.lit(fill)).alias(str(v)) for v in values])


def pivot_many(df: DataFrame, rows: list[str], column: str, values: list, aggregates: dict[str, Column]) -> DataFrame:
    """Several columns for each of values, named value_name."""
    return df.groupBy(*rows).pivot(column, values).agg(*[c.alias(n) for n, c in aggregates.items()])


def incidence(df: DataFrame, row: str, listed: str, values: list[str], separator: str = ",") -> DataFrame:
    """1 where a row's list has a value, otherwise 0."""
    each = df.select(row, F.explode(F.split(listed, separator)).alias("_value"))
    return pivot(each, [row], "_value", values, F.max(F.lit(1)), 0)


def unpivot(df: DataFrame, keys: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(keys, values, name, value)


def projected(df: DataFrame, names: list[str], missing: str | None = None) -> DataFrame:
    """Columns in a given order; one that isn't there is an error, or filled with missing."""
    if missing is None:
        return df.select(*[F.col(f"`{n}`") for n in names])
    return df.select(*[F.col(f"`{n}`") if n in df.columns else F.lit(missing).alias(n) for n in names])


def leading(df: DataFrame, n: int) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def karyotype_sorted(df: DataFrame, chrom: str, *then: str) -> DataFrame:
    return df.orderBy(X.karyotype_key(F.col(chrom)), *then)


def sampled(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """n rows, the same ones each time: the first by a hash of their key."""
    return df.withColumn("_h", F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))).orderBy("_h", *key).limit(n).drop("_h")


def split_by(df: DataFrame, key: str, path: str) -> None:
    """A folder for each value of a column."""
    df.write.partitionBy(key).mode("overwrite").parquet(path)


def combine_sites(frames: dict[str, DataFrame], site: list[str], value: str) -> DataFrame:
    """Sites that any caller has, with each one's value and the callers' names joined in order."""
    every = union_with_source({k: f.select(*site, F.col(value).cast("string").alias(value)) for k, f in frames.items()}, "_caller")
    names = list(frames)
    held = every.groupBy(*site).pivot("_caller", names).agg(F.first(value, True))
    callers = F.concat_ws(",", *[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in names])
    return held.withColumn("callers", callers)


def split_alleles(df: DataFrame, alts: str = "ALT", separator: str = ",") -> DataFrame:
    """A row for each alternative allele."""
    return df.withColumn(alts, F.explode(F.split(alts, separator)))


def reference_sample(df: DataFrame, name: str, format_: str = "FORMAT") -> DataFrame:
    """df with a sample that has no call: './.' where a format key contains GT, otherwise '.'."""
    return df.withColumn(name, F.array_join(F.transform(F.split(format_, ":"), lambda k: F.when(k.contains("GT"), "./.").otherwise(".")), ":"))


def mark_duplicates(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Alignments with duplicate = true but for the best of each key (where the fragment starts and ends)."""
    return df.withColumn("duplicate", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) > 1)


def alert(df: DataFrame, names: str, failed: Column, warned: Column, listed: int = 5) -> DataFrame:
    """(status, samples): 0FAIL, 1WARN or 2PASS, and the samples that caused it: their names, or how many if over listed.

    Names are only gathered where there are no more than listed + 1 of them.
    """
    marked = df.select(F.col(names).cast("string").alias("name"), F.when(failed, "0FAIL").when(warned, "1WARN").otherwise("2PASS").alias("status")).distinct()
    worst = marked.agg(F.coalesce(F.min("status"), F.lit("2PASS")).alias("status"))
    bad = marked.where("status != '2PASS'").groupBy("status").agg(F.count("*").alias("n"))
    first = marked.where("status != '2PASS'").withColumn("_nth", F.row_number().over(Window.partitionBy("status").orderBy("name"))).where(F.col("_nth") <= listed)
    few = first.groupBy("status").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    out = worst.join(bad, "status", "left").join(few, "status", "left")
    text = F.when(F.col("n").isNull(), "").when(F.col("n") <= listed, F.col("names")).otherwise(F.concat(F.col("n").cast("string"), F.lit(" samples")))
    return out.select("status", text.alias("samples"))


def worst_status(df: DataFrame, group: list[str], status: str) -> DataFrame:
    """The worst of statuses that sort from bad to good."""
    return df.groupBy(*group).agg(F.min(status).alias("status"), F.count_if(F.col(status) != "2PASS").alias("n_bad"))


def counterparts(df: DataFrame, a: str, b: str, separator: str = "<br>") -> DataFrame:
    """(sample, others): for each sample of either column those it is paired with, sorted."""
    both = df.select(F.col(a).alias("sample"), F.col(b).alias("other")).unionAll(df.select(F.col(b).alias("sample"), F.col(a).alias("other")))
    return both.groupBy("sample").agg(F.array_join(F.array_sort(F.collect_set("other")), separator).alias("others"))


def positioned(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """df with each row's place, from 1, in the order of columns (smallest first, nulls before): a sorted table of any size, numbered range by range."""
    return scan(ranged(df, [], order), [], order, {name: (SUM, F.lit(1).cast("long"))}).select(*df.columns, name)
