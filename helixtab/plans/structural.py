"""Structural variants: annotation of their breakpoints; and gene tables of a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators import intervals, joins


def at_hotspots(sv: DataFrame, hotspots: DataFrame, key: list[str], compat: bool = True) -> DataFrame:
    """sv with hotspot: whether a breakpoint lies in a hotspot (chrom, start, end).

    compat: the second breakpoint is only looked at where the first's chromosome has no hotspot at all.
    """
    h = hotspots.select(F.col("chrom").alias("h_chrom"), F.col("start").alias("h_start"), F.col("end").alias("h_end"))
    one = intervals.point_join(sv.select(*key, "chrom", "pos"), h, "pos", ("h_start", "h_end"), (("chrom", "h_chrom"),)).select(*key)
    second = sv.join(h.select(F.col("h_chrom").alias("chrom")).distinct(), "chrom", "left_anti") if compat else sv
    two = intervals.point_join(second.select(*key, "chrom2", "end"), h, "end", ("h_start", "h_end"), (("chrom2", "h_chrom"),)).select(*key)
    return joins.flagged(sv, one.unionAll(two), key, "hotspot", True, False)


def annotated(sv: DataFrame, repeats: DataFrame, key: list[str], name: str = "repeats", separator: str = "<=>", width: float = intervals.BIN) -> DataFrame:
    """sv with the names of regions (chrom with chr, start, end, name) that hold either breakpoint, first's then second's, in order of start.

    Equal regions are one, with a count, and what is listed at a place, however many breakpoints lie there, has a name once with its count: names are laid out
    beside each row of sv at the end, so they aren't shuffled. width: see overlap_join().
    """
    region = ["r_chrom", "r_start", "r_end", "r_name"]
    r = repeats.select(X.without_chr(F.col("chrom")).alias("r_chrom"), F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("name").alias("r_name"))
    r = r.where("r_name is not null").groupBy(*region).agg(F.count("*").alias("r_n"))
    side = lambda c, p: F.struct(X.without_chr(F.col(c)).alias("c"), F.col(p).alias("p"))
    own = sv.withColumn("_both", F.struct(side("chrom", "pos").alias("one"), side("chrom2", "end").alias("two")))
    spots = own.select("_both").distinct()
    places = spots.select(F.explode(F.array("_both.one", "_both.two")).alias("_at")).distinct().select("_at", "_at.c", "_at.p")
    hits = intervals.point_join(places, r, "p", ("r_start", "r_end"), (("c", "r_chrom"),), width, deal=True).groupBy("_at", "r_start", "r_name").agg(F.sum("r_n").cast("int").alias("r_n"))
    names = hits.groupBy("_at").agg(F.array_sort(F.collect_list(F.struct("r_start", "r_name", "r_n"))).alias("_names"))
    for i, c in enumerate(("one", "two")):
        spots = intervals.per_position(spots.withColumn("_at", F.col(f"_both.{c}")), "_at", names.withColumnRenamed("_names", f"_names{i}"), "left").drop("_at")
    none = F.array().cast(names.schema["_names"].dataType)
    listed = intervals.per_position(own, "_both", spots)
    text = lambda i: F.flatten(F.transform(F.coalesce(f"_names{i}", none), lambda x: F.array_repeat(x["r_name"], x["r_n"])))
    return listed.withColumn(name, F.array_join(F.concat(text(0), text(1)), separator)).select(*sv.columns, name)


def with_fusions(sv: DataFrame, fusions: DataFrame) -> DataFrame:
    """sv with fusion annotation by both breakpoints; the last row counts where one is repeated."""
    key = ["chrom", "pos", "chrom2", "end"]
    numbered = fusions.withColumn("chrom", X.sex_to_number(X.without_chr(F.col("chrom")))).withColumn("chrom2", X.sex_to_number(X.without_chr(F.col("chrom2")))).withColumn("_line", F.monotonically_increasing_id())
    last = joins.last_by_key(numbered, key, [F.col("_line")]).drop("_line")
    own = sv.withColumn("_c", F.col("chrom")).withColumn("_c2", F.col("chrom2")).withColumn("chrom", X.sex_to_number(X.without_chr(F.col("chrom")))).withColumn("chrom2", X.sex_to_number(X.without_chr(F.col("chrom2"))))
    return own.join(last, key, "left").withColumn("chrom", F.col("_c")).withColumn("chrom2", F.col("_c2")).drop("_c", "_c2")


def panel(targets: DataFrame, exons: DataFrame, bands: DataFrame, least: float = 0.5) -> DataFrame:
    """targets (target, chrom, start, end) with gene, exon of the first exon half covered, cytoband of the first band touched, and label.

    Exons: (e_chrom, e_start, e_end, gene, exon); bands: (b_chrom, b_start, b_end, band). Labels
    number the targets of each run of one gene in order.
    """
    covered = intervals.covering_match(intervals.overlap_join(targets, exons, ("start", "end"), ("e_start", "e_end"), (("chrom", "e_chrom"),)), ("start", "end"), ("e_start", "e_end"), least)
    gene = intervals.first_match(covered, ["target"], [F.col("e_start"), F.col("e_end"), F.col("exon")]).select("target", "gene", "exon")
    band = intervals.first_match(intervals.overlap_join(targets, bands, ("start", "end"), ("b_start", "b_end"), (("chrom", "b_chrom"),), 1 << 20), ["target"], [F.col("b_start")]).select("target", "band")
    named = targets.join(gene, "target", "left").join(band, "target", "left")
    from helixtab.operators.windows import counter_per_run

    counted = counter_per_run(named, ["chrom"], ["start", "end", "target"], "gene")
    return counted.withColumn("label", F.when(F.col("gene").isNotNull(), F.concat(F.col("gene"), F.lit("_target_"), F.col("nth").cast("string")))).drop("nth")
