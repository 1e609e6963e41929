"""From genotype tables to an annotated mutation table, and its fill-out over a patient's samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab import schema as S
from helixtab.functions import scalars as X
from helixtab.operators import filters, joins, tables


def genotype_calls(calls: DataFrame, keep_common: bool = False, verbose: bool = False) -> DataFrame:
    """(gene, sample, chrom, pos, ref, alt, filter, qual, id, gt, gq, alt_freq, ad_ref, ad_alt) of genotypes().

    keep_common: alleles stay as they are, with alternatives joined by ';'. verbose: sites without
    the alternative are kept, as 0/0 with no depths.
    """
    f = lambda k: F.col("fields")[k]
    gt = F.when(f("GT").isNull(), "NA").otherwise(X.genotype(f("GT")))
    depths = X.allele_depths(f("AD"), f("RD"), f("DP4"))
    total = F.coalesce(f("DP").try_cast("int"), F.aggregate(depths, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))))
    has = depths.isNotNull() & (F.coalesce(total, F.lit(0)) > 0)
    alt_depth = X.alternative_depth(depths, gt)
    none = gt.isin("./.", "0/0")
    rows = calls.where(gt != "./.") if not verbose else calls
    chosen = F.concat_ws(";", "alts") if keep_common else X.chosen_allele(F.col("ref"), F.col("alts"), gt)
    event = F.struct("pos", "ref", chosen.alias("alt")) if keep_common else X.stripped_event(F.col("pos"), F.col("ref"), chosen)
    zero = lambda c, z: F.when(none, z).otherwise(c) if verbose else c
    return rows.select(
        F.lit(".").alias("gene"), "sample", "chrom", event.alias("e"), "filter", F.coalesce("qual", F.lit(".")).alias("qual"), F.coalesce("id", F.lit(".")).alias("id"),
        zero(gt if keep_common else X.biallelic_genotype(gt, F.size("alts")), F.lit("0/0")).alias("gt"), F.coalesce(f("GQ"), F.lit("NA")).alias("gq"),
        F.when(has, X.four_digits(alt_depth / total)).otherwise("NA").alias("alt_freq"), F.when(has, F.get(depths, F.lit(0))).otherwise(0).alias("ad_ref"), F.when(has, alt_depth).otherwise(0).alias("ad_alt"),
    ).select("gene", "sample", "chrom", "e.pos", "e.ref", "e.alt", "filter", "qual", "id", "gt", "gq", "alt_freq", "ad_ref", "ad_alt")


def tumor_normal(calls: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tumor calls beside those of their normal, at the same site and alleles as recorded."""
    n = calls.select("chrom", F.col("sample").alias("normal"), "pos", *[F.col(c).alias(f"n_{c}") for c in ("gt", "gq", "alt_freq", "ad_ref", "ad_alt")]).dropDuplicates(["chrom", "normal", "pos"])
    return calls.withColumnRenamed("sample", "tumor").join(pairs, "tumor").join(n, ["chrom", "normal", "pos"])


def mutation_table(calls: DataFrame, genome: str, keep_common: bool = False, verbose: bool = False) -> DataFrame:
    """Columns of schema.MAF_COLUMNS (others empty), GT and FILTER, from genotype_calls() or tumor_normal()."""
    rows = calls if verbose else calls.where(~F.col("gt").contains("0/0") & ~F.col("gt").contains("./."))
    kind = X.variant_type_unstripped(F.col("ref"), F.col("alt")) if keep_common else X.variant_type(F.col("ref"), F.col("alt"))
    rows = rows.withColumn("_kind", kind).withColumn("_end", F.col("pos") + F.length("ref") - 1)
    if keep_common:  # take the common base off
        tail = lambda c: F.when(F.length(c) > 1, F.expr(f"substring({c}, 2)"))
        deletion, insertion = F.col("_kind") == "DEL", F.col("_kind") == "INS"
        rows = rows.select(
            "*", F.when(deletion, F.col("pos") + 1).otherwise(F.col("pos")).alias("_start"), F.when(insertion & (F.length("ref") == 1), F.col("_end") + 1).otherwise(F.col("_end")).alias("_e"),
            F.when(deletion | insertion, F.coalesce(tail("ref"), F.lit("-"))).otherwise(F.col("ref")).alias("_ref"), F.when(deletion, F.coalesce(tail("alt"), F.lit("-"))).when(insertion, F.expr("substring(alt, 2)")).otherwise(F.col("alt")).alias("_alt"),
        )
    else:
        rows = rows.select("*", F.col("pos").alias("_start"), F.col("_end").alias("_e"), F.col("ref").alias("_ref"), F.col("alt").alias("_alt"))
    normal = F.col("normal") if "normal" in calls.columns else F.lit(f"REF.{genome}")
    known = {
        "Hugo_Symbol": F.col("gene"), "NCBI_Build": F.lit(genome), "Chromosome": F.col("chrom"), "Start_Position": F.col("_start"), "End_Position": F.col("_e"), "Variant_Type": F.col("_kind"), "Reference_Allele": F.col("_ref"),
        "Tumor_Seq_Allele1": F.when(F.split_part("gt", F.lit("/"), F.lit(1)) != "0", F.col("_alt")).otherwise(F.col("_ref")), "Tumor_Seq_Allele2": F.col("_alt"), "dbSNP_RS": F.col("id"),
        "Tumor_Sample_Barcode": F.col("tumor") if "tumor" in calls.columns else F.col("sample"), "Matched_Norm_Sample_Barcode": normal, "t_ref_count": F.col("ad_ref"), "t_alt_count": F.col("ad_alt"),
    }
    if "n_ad_ref" in calls.columns:
        known |= {"n_ref_count": F.col("n_ad_ref"), "n_alt_count": F.col("n_ad_alt")}
    if "Caller" in calls.columns:
        known["Caller"] = F.col("Caller")
    return rows.select(*[known.get(c, F.lit("")).alias(c) for c in S.MAF_COLUMNS], F.col("gt").alias("GT"), F.col("filter").alias("FILTER"))


def annotate(maf: DataFrame, sequences: dict[str, DataFrame] = {}, panels: dict[str, DataFrame] = {}, population: DataFrame | None = None, compat: bool = True) -> DataFrame:
    """maf with POS, TAG, LABEL, frequencies, and what tables keyed by POS say; the last row of each LABEL stays.

    sequences: (POS, seq); panels: (POS), flagged T or F; population: (POS, AC, AN). compat: positions of the
    population table carry chr, so chromosomes named without it find nothing; otherwise names are brought together.
    """
    alt = X.changed_allele(F.col("Reference_Allele"), F.col("Tumor_Seq_Allele1"), F.col("Tumor_Seq_Allele2"))
    pos = X.event_tag(F.col("Chromosome"), F.col("Start_Position"), F.col("End_Position"))
    out = maf.withColumn("_line", F.monotonically_increasing_id()).withColumn("POS", pos).withColumn("TAG", F.concat_ws(":", "POS", "Reference_Allele", alt))
    out = out.withColumn("LABEL", F.concat(F.col("TAG"), F.lit("::"), F.col("Tumor_Sample_Barcode"), F.lit(":"), F.col("Matched_Norm_Sample_Barcode")))
    out = joins.last_by_key(out, ["LABEL"], [F.col("_line")]).drop("_line").withColumn("Chromosome", X.without_chr(F.col("Chromosome")))
    for name, table in sequences.items():
        out = joins.annotate(out, table.select("POS", F.upper("seq").alias(name)).dropDuplicates(["POS"]), ["POS"], fill={name: ""})
    for name, table in panels.items():
        out = joins.flagged(out, table, ["POS"], name)
    number = lambda c: F.col(c).cast("string").try_cast("double")
    depth = lambda p: F.coalesce(number(f"{p}_depth") if f"{p}_depth" in maf.columns else F.lit(None).cast("double"), number(f"{p}_alt_count") + number(f"{p}_ref_count"))
    out = out.withColumn("t_var_freq", F.try_divide(number("t_alt_count"), depth("t")))
    out = out.withColumn("n_var_freq", F.when(F.coalesce(F.col("n_alt_count").cast("string"), F.lit("")) == "", "-").when(depth("n") > 0, (number("n_alt_count") / depth("n")).cast("string")).otherwise("0.0"))
    if population is not None:
        known = population.select("POS", F.col("AC").alias("pop_AC"), F.col("AN").alias("pop_AN")).dropDuplicates(["POS"])
        if not compat:
            known = known.withColumn("POS", X.without_chr(F.col("POS")))
            return out.withColumn("_p", X.without_chr(F.col("POS"))).join(known.withColumnRenamed("POS", "_p"), "_p", "left").drop("_p")
        out = joins.annotate(out, known, ["POS"])
    return out


def coding_annotation(maf: DataFrame, records: DataFrame, values: list[str]) -> DataFrame:
    """maf with values of coding records (key: position_ref_alt), by the first allele, else the second; '' where none."""
    where = F.concat(F.replace("Chromosome", F.lit("chr"), F.lit("")), F.lit(":"), F.col("Start_Position").cast("string"), F.lit("-"), F.col("End_Position").cast("string"))
    ref = F.when(F.col("Variant_Type") == "INS", "?").otherwise(F.col("Reference_Allele"))
    side = lambda c: F.when(F.col("Variant_Type") == "DEL", "?").otherwise(F.col(c))
    key = lambda c: F.concat_ws("_", where, ref, side(c))
    out = joins.two_probe(maf, records.dropDuplicates(["key"]), key("Tumor_Seq_Allele1"), key("Tumor_Seq_Allele2"), "key", values)
    return out.fillna("", values)


def fill_out(events: DataFrame, counts: DataFrame, samples: DataFrame, pairs: DataFrame, compat: bool = True) -> DataFrame:
    """(event, tumor, normal, status, ref_count, alt_count, n_ref_count, n_alt_count) of every pair of a patient.

    events: (event, tumor, normal) as called; counts: (event, sample, counts) with counts as 'DP=;RD=;AD=;VF=';
    samples: (sample, patient, class); pairs: (tumor, normal). A called pair is SOMATIC if it is one of pairs, of one
    patient, and its normal of class Normal; otherwise UNPAIRED (compat=False: SOMATIC_VS_POOL where only the class differs).
    The patient's other pairs, of a sample without the event, are NONE. A normal of another class is REF, without counts.
    """
    s = samples.select("sample", "patient", F.col("class").alias("_class"))
    of = lambda c, name: s.select(F.col("sample").alias(c), F.col("patient").alias(f"{name}_patient"), F.col("_class").alias(f"{name}_class"))
    known = pairs.select("tumor", "normal").distinct()
    called = events.select("event", "tumor", "normal").distinct().join(of("tumor", "t"), "tumor").join(of("normal", "n"), "normal", "left")
    called = called.join(known.withColumn("_pair", F.lit(True)), ["tumor", "normal"], "left")
    own_pair = F.col("_pair").isNotNull() & F.col("n_patient").eqNullSafe(F.col("t_patient"))
    status = F.when(own_pair & (F.col("n_class") == "Normal"), "SOMATIC").when(own_pair & F.lit(not compat), "SOMATIC_VS_POOL").otherwise("UNPAIRED")
    own = called.select("event", "tumor", "normal", "n_class", status.alias("status"))
    mutated = called.select("event", F.col("t_patient").alias("patient")).distinct()
    tumors = called.select("event", "tumor").distinct()
    placed = known.join(of("tumor", "t"), "tumor", "left").join(of("normal", "n"), "normal", "left")
    without = lambda side: placed.join(mutated, F.col(f"{side}_patient") == F.col("patient"))
    by_tumor = without("t").join(tumors, ["event", "tumor"], "left_anti")
    by_normal = without("n").join(tumors.withColumnRenamed("tumor", "normal"), ["event", "normal"], "left_anti")
    columns = ["event", "tumor", "normal", "n_class"]
    others = by_tumor.select(*columns).unionByName(by_normal.select(*columns)).distinct().join(called.select("event", "tumor", "normal"), ["event", "tumor", "normal"], "left_anti")
    every = own.unionByName(others.withColumn("status", F.lit("NONE"))).withColumn("_n", F.when(F.col("n_class") == "Normal", F.col("normal")))
    c = counts.select("event", "sample", F.str_to_map("counts", F.lit(";"), F.lit("=")).alias("m"))
    t = c.select("event", F.col("sample").alias("tumor"), F.col("m")["RD"].try_cast("int").alias("ref_count"), F.col("m")["AD"].try_cast("int").alias("alt_count"))
    n = c.select("event", F.col("sample").alias("_n"), F.col("m")["RD"].try_cast("int").alias("n_ref_count"), F.col("m")["AD"].try_cast("int").alias("n_alt_count"))
    out = every.join(t, ["event", "tumor"], "left").join(n, ["event", "_n"], "left")
    return out.select("event", "tumor", F.coalesce("_n", F.lit("REF")).alias("normal"), "status", "ref_count", "alt_count", "n_ref_count", "n_alt_count")


def somatic(callers: dict[str, DataFrame], limits: filters.Limits = filters.SOMATIC, compat: bool = True) -> DataFrame:
    """Mutation tables of several callers, labelled, put together and filtered; mutations with the same event keep each caller's row."""
    named = [df.withColumn("Caller", F.lit(c)) for c, df in callers.items()]
    return filters.depth_frequency(tables.union_checked(*named), limits, compat=compat)


def post_filters(maf: DataFrame, low_confidence: Column | None = None, blacklist: DataFrame | None = None, artefact: Column | None = None) -> DataFrame:
    """In this order: rows of low confidence go, rows of the blacklist (key: POS), and artefacts."""
    if low_confidence is not None:
        maf = maf.where(~low_confidence)
    if blacklist is not None:
        maf = maf.join(blacklist.select("POS").distinct(), "POS", "left_anti")
    return maf if artefact is None else maf.where(~artefact)
