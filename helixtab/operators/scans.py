"""Running sums, least values and last values over groups of any size.

Rows are put in ranges of (group, order) and written, so a group with most of the rows is spread over many ranges. Each range is
scanned on its own; one row for each group and range meets in a window, and what came before is added. Where many rows share a value, aggregate
them first: equal values lie in one range.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixtab.session import shared_folder

SUM, LEAST, LAST = "sum", "least", "last"


def kept(df: DataFrame, name: str = "rows") -> DataFrame:
    """df, written to the shared folder (this runs a job): values that are worked out again may differ in their last digits, and wouldn't meet in a join."""
    path = f"{shared_folder(df.sparkSession)}/helixtab/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with _range, the number of the range that a row lies in; written to the shared folder (this runs a job), so that it stays the same."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept(df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def scan(rows: DataFrame, group: list[str], order: list[str], values: dict[str, tuple[str, Column]], reverse: bool = False, before: bool = False) -> DataFrame:
    """rows (of ranged()) with running values in order within each group: name to (SUM, LEAST or LAST, value).

    reverse: from the last row to the first. before: without the row itself. A sum of nothing is 0, other values of nothing are null; LAST passes
    over nulls. order must tell rows of a group apart, or rows with an equal order come in any order.
    """
    turn = (lambda c: F.desc_nulls_last(c)) if reverse else (lambda c: F.asc_nulls_first(c))
    upto = (Window.unboundedPreceding, -1 if before else 0)
    own = Window.partitionBy(*group, "_range").orderBy(*map(turn, order)).rowsBetween(*upto)
    earlier = Window.partitionBy(*group).orderBy(turn("_range")).rowsBetween(Window.unboundedPreceding, -1)
    over = {SUM: F.sum, LEAST: F.min, LAST: lambda c: F.last(c, True)}
    key = F.struct(*order)
    whole = {SUM: F.sum, LEAST: F.min, LAST: lambda c: (F.min_by if reverse else F.max_by)(c, F.when(c.isNotNull(), key))}
    named = rows.select("*", *(v.alias(f"_v_{n}") for n, (_, v) in values.items()))
    local = named.select("*", *(over[k](F.col(f"_v_{n}")).over(own).alias(f"_l_{n}") for n, (k, _) in values.items()))
    totals = named.groupBy(*group, "_range").agg(*(whole[k](F.col(f"_v_{n}")).alias(f"_t_{n}") for n, (k, _) in values.items()))
    carried = totals.select(*(F.col(c).alias(f"_k_{c}") for c in (*group, "_range")), *(over[k](F.col(f"_t_{n}")).over(earlier).alias(f"_c_{n}") for n, (k, _) in values.items()))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*group, "_range")])
    zero = F.lit(0)
    join = {
        SUM: lambda n: F.coalesce(F.col(f"_l_{n}"), zero) + F.coalesce(F.col(f"_c_{n}"), zero),
        LEAST: lambda n: F.least(f"_l_{n}", f"_c_{n}"),
        LAST: lambda n: F.coalesce(f"_l_{n}", f"_c_{n}"),
    }
    return local.join(carried, same).select(*rows.columns, *(join[k](n).alias(n) for n, (k, _) in values.items()))
