"""Copy number of a project, from coverage of targets to calls of genes, and tables that portals read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.operators import copynumber as N
from helixtab.operators import intervals, joins, tables


def project(coverage: DataFrame, normals: DataFrame, targets: DataFrame, fold: float = 2, p: float = 0.05, permutations: int = 99, levels: int = 1) -> dict[str, DataFrame]:
    """segments, targets and genes of tumors.

    coverage, normals: (target, sample, cov), normalised; targets: (target, chrom, position, gene). Targets on Y are left out. Each
    tumor is compared with the normal of least noise; segment means go back to their targets; a gene is
    called from its targets' mean against the tumor's null cluster, of at least levels different segment means.
    """
    used = targets.where(~F.col("chrom").isin("Y", "chrY"))
    tumors = coverage.withColumnRenamed("sample", "tumor").join(used.select("target"), "target")
    base = normals.select("target", F.col("sample").alias("normal"), F.col("cov").alias("n_cov"))
    ratios = N.log_ratios(tumors, base)
    best = N.best_normals(ratios).select("tumor", "normal")
    own = ratios.join(best, ["tumor", "normal"]).join(used, "target").select("tumor", "chrom", "target", "position", "gene", "lr")
    segments = N.segments(own, ["tumor", "chrom"], "position", "lr", permutations=permutations)
    of = segments.select(F.col("tumor").alias("s_tumor"), F.col("chrom").alias("s_chrom"), F.col("start").alias("s_start"), F.col("end").alias("s_end"), F.col("mean").alias("s_mean"))
    held = intervals.point_join(own.where("lr is not null"), of, "position", ("s_start", "s_end"), (("tumor", "s_tumor"), ("chrom", "s_chrom")), 1 << 20)
    probes = held.select("tumor", "chrom", "target", "position", "gene", "lr", F.round("s_mean", 6).alias("segment"))
    null = N.null_cluster(probes, ["tumor"], "segment", least=levels)
    genes = probes.where("gene is not null").groupBy("tumor", "gene").agg(F.avg("segment").alias("lr"), F.count("*").alias("n_targets"))
    spread = probes.groupBy("tumor").agg(F.stddev_samp(F.col("lr") - F.col("segment")).alias("noise"))
    tested = genes.join(null, "tumor").join(spread, "tumor").withColumn("sd", F.greatest("null_sd", F.col("noise") / F.sqrt("n_targets"), F.lit(1e-6)))
    called = N.significance(tested, ["tumor"], "lr", "null_mean", "sd", fold, p)
    calls = N.gene_calls(called.withColumnRenamed("tumor", "sample"))
    return {"segments": segments, "targets": probes, "genes": called.select("tumor", "gene", "n_targets", "lr", "fc", "p_adjusted", "significant"), "calls": calls}


def call_matrix(calls: DataFrame, samples: list[str]) -> DataFrame:
    """Genes by samples, NA where a gene has no call."""
    return tables.pivot(calls.withColumn("call", F.col("call").cast("string")), ["gene"], "sample", samples, F.first("call"), "NA")


def named_by_tumor(calls: DataFrame, tumors: DataFrame, combined: str) -> DataFrame:
    """Calls under a pair's combined name, with the tumor it starts or ends with; tumors: (tumor), a list of samples."""
    return joins.by_ends(calls, tumors, combined, "tumor")


def tumor_normal_counts(tumor: DataFrame, normal: DataFrame, least: int = 25, depth: str = "BASEQ_depth") -> DataFrame:
    """Count matrices of both samples side by side, columns suffixed, where the normal is covered; single letters only, no N."""
    key = ["Chrom", "Pos", "Ref", "Alt"]
    single = (F.length("Ref") == 1) & (F.length("Alt") == 1) & (F.col("Ref") != "N")
    side = lambda df, suffix: df.where(single).select(*key, *[F.col(c).alias(f"{c}.{suffix}") for c in df.columns if c not in key])
    return side(tumor, "TUM").join(side(normal.where(F.col(depth).try_cast("int") >= least), "NOR"), key)


def gene_names(targets: DataFrame, *sources: DataFrame, least: float = 0.5) -> DataFrame:
    """targets (target, chrom, start, end, name) with gene: of the first source (e_chrom, e_start, e_end, gene, exon) with an exon half covered, else their own name."""
    out = targets
    found = []
    for i, exons in enumerate(sources):
        pairs = intervals.overlap_join(targets.select("target", "chrom", "start", "end"), exons, ("start", "end"), ("e_start", "e_end"), (("chrom", "e_chrom"),))
        first = intervals.first_match(intervals.covering_match(pairs, ("start", "end"), ("e_start", "e_end"), least), ["target"], [F.col("e_start"), F.col("e_end"), F.col("exon")])
        out = out.join(first.select("target", F.col("gene").alias(f"_gene{i}")), "target", "left")
        found.append(F.col(f"_gene{i}"))
    return out.withColumn("gene", F.coalesce(*found, F.col("name"))).drop(*[f"_gene{i}" for i in range(len(sources))])


def gene_matrices(calls: DataFrame, samples: list[str], compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """(states, alleles): genes by samples, of (sample, gene, start, end, wgd, mcn, lcn, state, call), a row for each sample and gene.

    alleles joins wgd, mcn, lcn, state and call by ';'. compat: start and end stand where wgd and mcn
    should, and a missing cell is a list of five NA as text; otherwise the right columns, and NA.
    """
    if joins.repeated(calls, ["sample", "gene"]).limit(1).count():
        raise ValueError("a sample has a gene twice")
    first = ("start", "end") if compat else ("wgd", "mcn")
    text = F.concat_ws(";", *[F.col(c).cast("string") for c in (*first, "lcn", "state", "call")])
    rows = calls.select("gene", "sample", F.col("state").cast("string").alias("state"), text.alias("alleles"))
    states = tables.pivot(rows, ["gene"], "sample", samples, F.first("state"), "NA")
    return states, tables.pivot(rows, ["gene"], "sample", samples, F.first("alleles"), str(["NA"] * 5) if compat else "NA")
