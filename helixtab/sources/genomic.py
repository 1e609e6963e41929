"""Variant, alignment, interval and sequence sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.sources.tables import comments, tsv

FIXED = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """A wide table: the fixed columns, and one for each sample."""
    return tsv(spark, path, mark="##", header_mark="#", required=FIXED[:8])


def vcf_declared(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Types of the INFO and FORMAT fields that the header declares."""
    out: dict[str, dict[str, str]] = {"INFO": {}, "FORMAT": {}}
    for line in comments(spark, path, "##"):
        m = re.match(r"##(INFO|FORMAT)=<ID=([^,]+),.*?Type=([^,>]+)", line)
        if m:
            out[m[1]][m[2]] = m[3]
    return out


def genotypes(wide: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """(chrom, pos, id, ref, alts, qual, filter, info, sample, fields): a row per site and sample; fields is a map."""
    samples = samples or [c for c in wide.columns if c not in FIXED]
    each = F.array(*[F.struct(F.lit(s).alias("sample"), F.col(f"`{s}`").alias("v")) for s in samples])
    return wide.select(
        F.col("CHROM").alias("chrom"), F.col("POS").cast("long").alias("pos"), X.missing(F.col("ID"), ".").alias("id"), F.col("REF").alias("ref"), F.split("ALT", ",").alias("alts"),
        X.missing(F.col("QUAL"), ".").alias("qual"), F.when(F.col("FILTER").isin("", "."), "PASS").otherwise(F.col("FILTER")).alias("filter"), X.info_map(F.col("INFO")).alias("info"), F.explode(each).alias("s"), "FORMAT",
    ).select("chrom", "pos", "id", "ref", "alts", "qual", "filter", "info", F.col("s.sample").alias("sample"), X.sample_map(F.col("FORMAT"), F.col("s.v")).alias("fields"))


def maf(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, required=("Hugo_Symbol", "Chromosome", "Start_Position", "Reference_Allele", "Tumor_Seq_Allele2", "Tumor_Sample_Barcode"))


def maf_variants(table: DataFrame, reference: DataFrame, chunk: int) -> DataFrame:
    """(chrom, pos0, ref, alt) of mutation rows, with the base before put back where an allele is '-'.

    reference: (ref_chrom, chunk_no, seq) with chunk bases a row.
    """
    alt = X.changed_allele(F.col("Reference_Allele"), F.col("Tumor_Seq_Allele1"), F.col("Tumor_Seq_Allele2"))
    start = F.col("Start_Position").cast("long")
    before = F.when(F.col("Reference_Allele") == "-", start).otherwise(start - 1)
    rows = table.select("*", start.alias("_start"), alt.alias("_alt"), before.alias("_before"), F.floor((before - 1) / chunk).alias("_chunk"))
    joined = rows.join(reference, (F.col("Chromosome") == F.col("ref_chrom")) & (F.col("_chunk") == F.col("chunk_no")), "left")
    base = F.upper(F.col("seq").substr((F.col("_before") - F.col("_chunk") * chunk).cast("int"), F.lit(1)))
    event = X.anchored_event(F.col("_start"), F.col("Reference_Allele"), F.col("_alt"), base)
    return joined.withColumn("_e", event).select(*table.columns, F.col("Chromosome").alias("chrom"), (F.col("_e.pos") - 1).alias("pos0"), F.col("_e.ref").alias("ref"), F.col("_e.alt").alias("alt"))


def variant_list(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos0, ref, alt) of a list with five columns as a VCF starts; text that is no number counts as 0."""
    rows = tsv(spark, path, names=["CHROM", "POS", "ID", "REF", "ALT"])
    return rows.select(F.col("CHROM").alias("chrom"), (X.leading_int(F.col("POS")) - 1).alias("pos0"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"))


def panel_list(spark: SparkSession, path: str) -> DataFrame:
    """The same of a table (sample, normal, chrom, pos, ref, alt, ...) with a header."""
    rows = tsv(spark, path, required=("Sample", "NormalUsed", "Chrom", "Start", "Ref", "Alt"))
    return rows.select("Sample", "NormalUsed", F.col("Chrom").alias("chrom"), (X.leading_int(F.col("Start")) - 1).alias("pos0"), F.col("Ref").alias("ref"), F.col("Alt").alias("alt"))



def sam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """Alignments of SAM text: sample, read_name, flag, chrom, pos0, mapq, cigar, mate fields, insert_size, query, quals, tags.

    Tags are a map from name to value. Write them partitioned by chromosome to read regions alone.
    """
    cells = F.split("value", "\t", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    text = lambda i: F.get(cells, F.lit(i))
    tags = F.map_from_entries(F.transform(F.slice(cells, F.lit(12), F.greatest(F.size(cells) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^[^:]*:[^:]*:", ""))))
    return rows.select(
        (F.lit(sample) if sample else F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.sam)?$", 1)).alias("sample"), text(0).alias("read_name"), text(1).cast("int").alias("flag"), text(2).alias("chrom"),
        (text(3).cast("long") - 1).alias("pos0"), text(4).cast("int").alias("mapq"), text(5).alias("cigar"), text(6).alias("mate_chrom"), (text(7).cast("long") - 1).alias("mate_pos0"), text(8).cast("int").alias("insert_size"),
        text(9).alias("query"), text(10).alias("quals"), tags.alias("tags"),
    )


def fasta(spark: SparkSession, path: str, chunk: int = 10_000) -> DataFrame:
    """(ref_chrom, chunk_no, seq): sequences in chunks of fixed length, joined from lines by where they start.

    Lines are numbered within their file and summed per sequence; a chunk gathers only the lines that touch it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    by = Window.partitionBy("file").orderBy("block", "line")
    named = lines.withColumn("_n", F.count_if(F.col("value").startswith(">")).over(by)).withColumn("_head", F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>(\S+)", 1)))
    own = Window.partitionBy("file", "_n").orderBy("block", "line")
    placed = named.withColumn("ref_chrom", F.first("_head", True).over(own)).withColumn("_len", F.when(F.col("_head").isNull(), F.length(F.trim("value"))).otherwise(0)).withColumn("_end", F.sum("_len").over(own)).where("_head is null and _len > 0")
    spread = placed.withColumn("_start", F.col("_end") - F.col("_len")).withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("_start") / chunk), F.floor((F.col("_end") - 1) / chunk))))
    lo = F.greatest(F.col("chunk_no") * chunk, F.col("_start"))
    part = F.trim("value").substr((lo - F.col("_start") + 1).cast("int"), (F.least((F.col("chunk_no") + 1) * chunk, F.col("_end")) - lo).cast("int"))
    return spread.select("ref_chrom", "chunk_no", F.struct(lo.alias("at"), part.alias("part")).alias("p")).groupBy("ref_chrom", "chunk_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "").alias("seq"))


def bed(spark: SparkSession, path: str, names: tuple[str, ...] = ("name",)) -> DataFrame:
    """(chrom, start1, end1, ...): 0-based half-open lines as closed 1-based intervals."""
    rows = tsv(spark, path, names=["chrom", "start0", "end", *names])
    return rows.where(~F.col("chrom").startswith("track")).select("chrom", (F.col("start0").cast("long") + 1).alias("start1"), F.col("end").cast("long").alias("end1"), *names)


def interval_list(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start1, end1, strand, name) of a 1-based list below '@' lines."""
    rows = tsv(spark, path, mark="@", names=["chrom", "start1", "end1", "strand", "name"])
    return rows.withColumn("start1", F.col("start1").cast("long")).withColumn("end1", F.col("end1").cast("long"))


def regions(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start1, end1) of lines 'chrom:start-end'; others are left out."""
    m = lambda i: F.regexp_extract("value", r"^(.*):(\d+)-(\d+)", i)
    return spark.read.text(path).where(m(1) != "").select(m(1).alias("chrom"), m(2).cast("long").alias("start1"), m(3).cast("long").alias("end1"))


def pileup(spark: SparkSession, path: str) -> DataFrame:
    rows = tsv(spark, path, names=["chrom", "pos", "ref_base", "depth", "bases", "quals"])
    return rows.withColumn("pos", F.col("pos").cast("long")).withColumn("depth", F.col("depth").cast("int"))


def base_depths(spark: SparkSession, path: str) -> DataFrame:
    """(locus, depths): base counts 'A:n C:n G:n T:n N:n' as a map."""
    rows = tsv(spark, path, names=["locus", "total", "mean", "sample_depth", "bases"]).where(F.col("locus") != "Locus")
    return rows.select("locus", F.str_to_map("bases", F.lit(" "), F.lit(":")).alias("depths"))


def coding_records(table: DataFrame, cds: str, position: str) -> DataFrame:
    """table with key: 'position_ref_alt' of a coding change; rows without one are left out."""
    rows = table.where((F.col(cds) != "c.?") & ~F.col(cds).contains("N/A") & (F.coalesce(F.col(position), F.lit("")) != ""))
    change = X.coding_change(F.col(cds))
    return rows.withColumn("_c", change).where("_c is not null and _c.ref != '' and _c.alt != ''").withColumn("key", F.concat_ws("_", F.col(position), F.col("_c.ref"), F.col("_c.alt"))).drop("_c")


def tumor_normal_counts(spark: SparkSession, path: str) -> DataFrame:
    """Count matrices with a header, gzipped or not."""
    return spark.read.csv(path, header=True, sep="\t")
