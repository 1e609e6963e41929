"""Equi-joins with the semantics that annotation and pairing need. Broadcasts are left to the optimiser's size checks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixtab.operators.intervals import listed

#: Parts into which the rows of a class are dealt; parts of each side of dealt_join().
DEAL, SIDE = 64, 16


class Unmatched(ValueError):
    """Rows of one side have no match though each must have one."""


def last_by_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Of rows with one key the last in order."""
    back = [o.desc() for o in order]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*back))).where("_nth = 1").drop("_nth")


def first_by_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_nth = 1").drop("_nth")


def matched(left: DataFrame, right: DataFrame, key: list[str], check: bool = True) -> DataFrame:
    """Inner join in which every row of left must find exactly one row of right."""
    if check:
        lost = left.join(right, key, "left_anti").limit(1).count()
        twice = right.groupBy(*key).count().where("count > 1").limit(1).count()
        if lost or twice:
            raise Unmatched(f"on {key}: {'a row has no match' if lost else 'a key is repeated'}")
    return left.join(right, key)


def annotate(left: DataFrame, right: DataFrame, key: list[str], order: list[Column] | None = None, fill: dict | None = None) -> DataFrame:
    """Left outer join with the last row of right for each key; fill gives values where there is none."""
    joined = left.join(last_by_key(right, key, order) if order else right, key, "left")
    for c, v in (fill or {}).items():
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return joined


def flagged(left: DataFrame, right: DataFrame, key: list[str], name: str, yes="T", no="F") -> DataFrame:
    """left with yes or no: whether its key is in right."""
    known = right.select(*key).distinct().withColumn("_hit", F.lit(True))
    return left.join(known, key, "left").withColumn(name, F.when(F.col("_hit"), F.lit(yes)).otherwise(F.lit(no))).drop("_hit")


def two_probe(left: DataFrame, right: DataFrame, first: Column, second: Column, key: str, values: list[str]) -> DataFrame:
    """values of right by a first key and, where that finds nothing, by a second; the right key must be unique."""
    a = right.select(F.col(key).alias("_key1"), F.struct(*values).alias("_v1"))
    b = right.select(F.col(key).alias("_key2"), F.struct(*values).alias("_v2"))
    both = left.withColumn("_first", first).withColumn("_second", second)
    both = both.join(a, F.col("_first") == F.col("_key1"), "left").join(b, F.col("_second") == F.col("_key2"), "left")
    return both.withColumn("_v", F.coalesce("_v1", "_v2")).select(*left.columns, *[F.col("_v")[v].alias(v) for v in values])


def paired(calls: DataFrame, pairs: DataFrame, site: list[str], sample: str = "sample", tumor: str = "tumor", normal: str = "normal", values: list[str] | None = None) -> DataFrame:
    """Tumor calls beside the normal's calls at the same site: columns of the tumor, and n_ those of the normal."""
    values = values or [c for c in calls.columns if c not in (*site, sample)]
    t = calls.select(*site, F.col(sample).alias(tumor), *values)
    n = calls.select(*site, F.col(sample).alias(normal), *[F.col(v).alias(f"n_{v}") for v in values])
    return t.join(pairs, tumor).join(n, [*site, normal])


def overriding(base: DataFrame, sources: list[DataFrame], key: list[str], values: list[str]) -> DataFrame:
    """base's keys with each value from the last source that has one."""
    out = base.select(*key)
    for i, s in enumerate(sources):
        out = out.join(s.select(*key, *[F.col(v).alias(f"_{i}_{v}") for v in values if v in s.columns]), key, "left")
    pick = {v: [F.col(f"_{i}_{v}") for i, s in reversed(list(enumerate(sources))) if v in s.columns] for v in values}
    return out.select(*key, *[F.coalesce(*cs).alias(v) for v, cs in pick.items()])


def details(base: DataFrame, metrics: dict[str, DataFrame], key: str) -> DataFrame:
    """base with one column from each metric table (key, value), null where it has no row."""
    for name, m in metrics.items():
        m = m.toDF(key, name)
        base = base.join(m, key, "left")
    return base


def fill_out(events: DataFrame, samples: DataFrame, called: DataFrame, group: str, event: str, sample: str) -> DataFrame:
    """Each event of a group with those samples of the group in which it wasn't called."""
    every = events.select(event, group).distinct().join(samples.select(sample, group).distinct(), group)
    return every.join(called.select(event, sample).distinct(), [event, sample], "left_anti")


def discordance(genotypes: DataFrame, sample: str, site: str, genotype: str, homozygous: Column | None = None, none: str = "--") -> DataFrame:
    """For each ordered pair of samples, over sites that both have: the share on which they disagree.

    Samples with the same genotypes are one class. Classes meet on the site and are counted; the pairs of their samples are then laid
    out from lists, dealt out evenly, and neither counted nor shuffled. A sample's sites are held at once: those of a panel.
    """
    rows = genotypes.where(F.col(genotype) != none) if homozygous is None else genotypes.where(homozygous)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = rows.where(F.col(site).isNotNull() & F.col(sample).isNotNull()).groupBy(F.col(sample).alias("_sample")).agg(F.array_sort(F.collect_list(F.struct(F.col(site).alias("site"), F.col(genotype).alias("value")))).alias("_profile"))
    classes = own.groupBy("_profile").agg(F.min("_sample").alias("_class"))
    members = own.join(classes, "_profile").select("_sample", "_class")
    at = lambda c: classes.select(F.col("_class").alias(f"_class{c}"), F.explode("_profile").alias("_p")).select(f"_class{c}", F.col("_p.site").alias("_site"), F.col("_p.value").alias(c))
    met = at("a").join(at("b"), "_site").groupBy("_classa", "_classb").agg(F.count("*").alias("sites"), F.sum((F.col("a") != F.col("b")).cast("long")).alias("differ"))
    left = members.select(F.col("_sample").alias("reference"), F.col("_class").alias("_classa")).join(met, "_classa").withColumn("_deal", F.pmod(F.xxhash64("reference"), F.lit(DEAL)).cast("int"))
    lists = listed(members.select(F.col("_sample").alias("query"), F.col("_class").alias("_classb")), ["_classb"]).withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))
    pairs = left.repartition(n, "_classb", "_deal").join(lists.repartition(n, "_classb", "_deal"), ["_classb", "_deal"])
    laid = pairs.select("reference", F.explode("_rows").alias("_row"), "sites", "differ").select("reference", F.col("_row.query").alias("query"), "sites", "differ")
    return laid.where("reference != query").withColumn("discordance", F.col("differ") / F.col("sites"))


def dealt_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join on a key of few values, which gives far more rows than it takes: each side is dealt into SIDE parts, and every part of one meets every part of the other under a key of its own."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1)))
    deal = lambda df, own, other: df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(SIDE)).cast("int")).withColumn(other, every).repartition(n, key, "_one", "_two")
    return deal(left, "_one", "_two").join(deal(right, "_two", "_one"), [key, "_one", "_two"]).drop("_one", "_two")


def by_ends(left: DataFrame, right: DataFrame, combined: str, name: str) -> DataFrame:
    """Rows whose combined name starts or ends with a name of right: equi-joins on prefixes and suffixes of the lengths that names have.

    right is read once for its lengths, of which there are few; a name that is both start and end gives one row.
    """
    lengths = [r[0] for r in right.where(F.length(name) > 0).select(F.length(name)).distinct().collect()]
    parts = F.array_distinct(F.flatten(F.array(*[F.array(F.left(combined, F.lit(n)), F.right(combined, F.lit(n))) for n in lengths]))) if lengths else F.array().cast("array<string>")
    keyed = left.withColumn("_part", F.explode(parts))
    return keyed.join(right, F.col("_part") == F.col(name)).drop("_part")


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(rule, n) of broken rules: each check is a table of offending rows."""
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = row if out is None else out.unionAll(row)
    return out


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent, F.col(child_key) == F.col(parent_key), "left_anti")


def repeated(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1")


def aliases(genes: DataFrame, symbol: str, others: list[str], separator: str = r",\s*") -> DataFrame:
    """(alias, symbols): each alias or previous symbol with the current symbols it may stand for, sorted."""
    names = F.array_compact(F.array(*[F.col(o) for o in others]))
    each = genes.select(symbol, F.explode(F.flatten(F.transform(names, lambda n: F.split(n, separator)))).alias("alias")).where("alias != ''")
    return each.groupBy("alias").agg(F.array_sort(F.collect_set(symbol)).alias("symbols"))


def census(df: DataFrame, genes: DataFrame, sites: list[tuple[str, str]], symbol: str, columns: list[str], separator: str = "<=>") -> DataFrame:
    """df with a text of what genes says of each of its genes: 'label:column values', in the order of sites.

    Every row stays, equal ones too; the text is null where genes knows none of a row's.
    """
    own = list(dict.fromkeys(c for c, _ in sites))
    labelled = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(label).alias("label"), F.col(c).alias("gene")) for i, (c, label) in enumerate(sites)])
    row = df.select(*own).distinct().select(F.struct(*own).alias("_row"), F.explode(labelled).alias("_site"))
    text = F.concat_ws(separator, *[F.concat(F.col("_site.label"), F.lit(":"), F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(" "))) for c in columns])
    hits = row.join(genes, F.col("_site.gene") == F.col(symbol)).select("_row", F.struct(F.col("_site.i").alias("i"), text.alias("text")).alias("hit"))
    found = hits.groupBy("_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list("hit")), lambda h: h["text"]), separator).alias("census"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col("_row")[c]) for c in own])
    return df.join(found, same, "left").drop("_row")
