"""Queries over files: the driver's tables are written in a source's format to the shared folder, read by the source, and compared by SQL.

Files hold whole tables; each run writes to a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators import counting as C
from helixtab.operators import intervals as I  # noqa: E741
from helixtab.operators import joins as J
from helixtab.operators import tables as T
from helixtab.plans import copynumber, structural
from helixtab.plans.queries import LINE, query
from helixtab.session import shared_folder
from helixtab.sources import genomic as G
from helixtab.sources import metrics as M
from helixtab.sources import tables as S
from helixtab.sources import writers as K


def _path(t) -> str:
    return f"{shared_folder(t.spark)}/helixtab/files-{uuid.uuid4().hex}"


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _lines(t, df: DataFrame, *cells: Column, separator: str = "\t") -> str:
    """Write a line for each row, its cells parted by separator."""
    path = _path(t)
    df.select(F.concat_ws(separator, *[_text(c) for c in cells])).write.text(path)
    return path


def _per_sample(t, df: DataFrame, sample: str, text: Column) -> str:
    """Write a file for each row, in a folder named by its sample."""
    path = _path(t)
    df.select(_text(sample).alias("sample"), text.alias("value")).write.partitionBy("sample").text(path)
    return f"{path}/sample=*/*"


IN_FOLDER = r"sample=([^/]+)/"

# ---------------------------------------------------------------- tables


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def tsv_source(t):
    path = _path(t)
    K.tsv(t.customer.select("c_custkey", "c_name", "c_nationkey"), path)
    back = S.tsv(t.spark, path, required=("c_custkey", "c_name"))
    return back.select(X.as_int(F.col("c_custkey")).alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query("SELECT s_suppkey, s_name FROM supplier")
def preamble_source(t):
    path = _path(t)
    K.single(t.supplier.select("s_suppkey", "s_name"), path, ["call statistics of a run"])
    return S.preamble_tsv(t.spark, path).select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")


@query("SELECT 's' || c_custkey AS tumor, 's' || c_custkey + 1 AS normal FROM customer WHERE c_custkey % 5 <> 0")
def pairing_source(t):
    k = F.col("c_custkey")
    path = _lines(t, t.customer, F.when(k % 10 == 0, "na").when(k % 5 == 0, "NA").otherwise(F.concat(F.lit("s"), _text(k + 1))), F.concat(F.lit("s"), _text(k)))
    return S.pairing(t.spark, path)


@query("SELECT c_custkey AS sample, c_nationkey AS patient, c_mktsegment AS class FROM customer")
def patient_source(t):
    path = _path(t)
    K.tsv(t.customer.select(F.col("c_custkey").alias("Sample_ID"), F.col("c_nationkey").alias("Patient_ID"), F.col("c_mktsegment").alias("Class"), F.lit("v3").alias("Bait_version")), path)
    return S.patients(t.spark, path).select(F.col("Sample_ID").cast("long").alias("sample"), F.col("Patient_ID").cast("int").alias("patient"), F.col("Class").alias("class"))


@query("SELECT 'g' || c_nationkey AS \"group\", count(*) AS n_samples, count(DISTINCT c_mktsegment) AS n_runs FROM customer GROUP BY 1")
def grouped_libraries(t):
    sample = F.concat(F.lit("s"), _text("c_custkey"))
    groups = S.grouping(t.spark, _lines(t, t.customer, sample, F.concat(F.lit("g"), _text("c_nationkey"))))
    runs = S.mapping(t.spark, _lines(t, t.customer, F.lit("lib"), sample, F.col("c_mktsegment"), F.lit("/a/b"), F.lit("PE")))
    return J.matched(groups, runs, ["sample"]).groupBy("group").agg(F.count("*").alias("n_samples"), F.count_distinct("run").alias("n_runs"))


@query("SELECT c_mktsegment AS folder, count(*) AS n, min(c_name) AS first_name FROM customer GROUP BY 1")
def sample_paths(t):
    """Lines of files under a glob, with a part of their path and the name found in it."""
    path = _path(t)
    t.customer.select(F.col("c_mktsegment").alias("sample"), F.col("c_name").alias("value")).write.partitionBy("sample").text(path)
    rows = S.files(t.spark, f"{path}/sample=*/*", IN_FOLDER)
    folder = F.regexp_replace(S.path_part(F.col("path"), -2), "^sample=", "")
    return rows.where(folder == F.col("sample")).groupBy(F.col("sample").alias("folder")).agg(F.count("*").alias("n"), F.min("value").alias("first_name"))


@query("SELECT n_name AS sample, md5(n_name) AS md5, length(n_name)::BIGINT AS length FROM nation")
def file_checksums(t):
    pattern = _per_sample(t, t.nation.select("n_name", F.regexp_replace("n_name", " ", "_").alias("s")), "s", F.col("n_name"))
    rows = S.fingerprints(t.spark, pattern)
    known = t.nation.select("n_name", F.regexp_replace("n_name", " ", "_").alias("s"))
    met = rows.withColumn("s", X.sample_of_path(F.col("path"), IN_FOLDER)).join(known, "s")
    # Spark's text files end with a line end
    return met.where(F.col("md5") == F.md5(F.concat("n_name", F.lit("\n")))).select(F.col("n_name").alias("sample"), F.md5("n_name").alias("md5"), (F.col("length") - 1).alias("length"))


@query("SELECT p_partkey, p_type AS \"Hugo_Symbol\", p_brand AS \"TEST_brand\", 'hc' AS \"Caller\", '' AS \"Extra\" FROM part")
def projected_columns(t):
    """A table cut to its first columns, renamed by caller, overwritten, filled and put in order."""
    names = X.caller_columns("TEST", ["brand"])
    rows = T.leading(t.part.select("p_partkey", "p_name", F.col("p_brand").alias("brand"), "p_type", "p_size"), 4)
    rows = rows.withColumn("Hugo_Symbol", F.col("p_type")).withColumn("Caller", F.lit("hc")).withColumnsRenamed(names)
    return T.projected(rows, ["p_partkey", "Hugo_Symbol", "TEST_brand", "Caller", "Extra"], "")


@query("SELECT r_name AS source, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def sources_stacked(t):
    """One table of a file for each region, each row with its source; the same header in all."""
    path = _path(t)
    names = [r.r_name for r in t.region.select("r_name").collect()]
    frames = {}
    for n in names:
        K.tsv(t.nation.join(t.region.where(F.col("r_name") == n), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name")), f"{path}/{n.replace(' ', '_')}")
        frames[n] = S.tsv(t.spark, f"{path}/{n.replace(' ', '_')}")
    return T.union_with_source(frames, "source")


# ---------------------------------------------------------------- variants


VCF = """SELECT p_partkey AS pos, '' || (p_partkey % 24 + 1) AS chrom, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS n_alts, CASE WHEN p_partkey % 7 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter,
  '' || p_size AS dp, {s} AS sample, {g} AS gt, {a} AS ad, CASE WHEN p_partkey % 5 = 0 THEN 'PRECISE' ELSE 'IMPRECISE' END AS precision FROM part"""


def _vcf(t) -> DataFrame:
    k = F.col("p_partkey")
    wide = t.part.select(
        _text(k % 24 + 1).alias("CHROM"), _text(k).alias("POS"), F.lit(".").alias("ID"), F.lit("A").alias("REF"), F.when(k % 3 == 0, "C,G").otherwise("C").alias("ALT"), F.lit(".").alias("QUAL"), F.when(k % 7 == 0, "LowQual").otherwise(".").alias("FILTER"),
        F.concat(F.lit("DP="), _text("p_size"), F.when(k % 5 == 0, ";PRECISE").otherwise("")).alias("INFO"), F.lit("GT:AD").alias("FORMAT"),
        F.concat(F.when(k % 3 == 0, "1/2").when(k % 3 == 1, "0/1").otherwise("1/1"), F.lit(":"), _text(k % 11), F.lit(","), _text(k % 13)).alias("T"), F.concat(F.when(k % 2 == 0, "0/0").otherwise("0/1"), F.lit(":.")).alias("N"),
    )
    path = _path(t)
    K.vcf(wide, path, ["##fileformat=VCFv4.1", '##INFO=<ID=DP,Number=1,Type=Integer,Description="depth">'])
    assert G.vcf_declared(t.spark, path)["INFO"]["DP"] == "Integer"
    return G.vcf(t.spark, path)


@query(VCF.format(s="'T'", g="CASE p_partkey % 3 WHEN 0 THEN '1/2' WHEN 1 THEN '0/1' ELSE '1/1' END", a="(p_partkey % 11) || ',' || (p_partkey % 13)") + " UNION ALL " + VCF.format(s="'N'", g="CASE WHEN p_partkey % 2 = 0 THEN '0/0' ELSE '0/1' END", a="'.'"))
def vcf_genotypes(t):
    rows = G.genotypes(_vcf(t))
    return rows.select("pos", "chrom", F.size("alts").alias("n_alts"), "filter", F.col("info")["DP"].alias("dp"), "sample", F.col("fields")["GT"].alias("gt"), F.col("fields")["AD"].alias("ad"), X.precision(F.col("info")).alias("precision"))


@query("SELECT p_partkey AS pos FROM part WHERE p_partkey % 2 = 0")
def germline_filter(t):
    """Rows of a VCF in which the tumor has a call and depths."""
    from helixtab.operators.filters import called

    return called(_vcf(t), "T", "N", False).where(F.col("N").startswith("0/0")).select(F.col("POS").cast("long").alias("pos"))


@query("""SELECT p_partkey AS pos, CASE p_partkey % 3 WHEN 0 THEN 'G' ELSE 'C' END AS alt, CASE p_partkey % 3 WHEN 0 THEN '1/1' WHEN 1 THEN '0/1' ELSE '1/1' END AS gt,
CASE p_partkey % 3 WHEN 0 THEN NULL ELSE p_partkey % 13 END AS alt_depth FROM part""")
def allele_choice(t):
    """The allele that a genotype names, the genotype without the others, and the depth of the allele it ends with."""
    f = F.col("fields")
    rows = G.genotypes(_vcf(t), ["T"])
    depths = X.allele_depths(f["AD"], F.lit(None).cast("string"), F.lit(None).cast("string"))
    return rows.select("pos", X.chosen_allele(F.col("ref"), F.col("alts"), f["GT"]).alias("alt"), X.biallelic_genotype(f["GT"], F.size("alts")).alias("gt"), X.alternative_depth(depths, f["GT"]).cast("long").alias("alt_depth"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '0;3;5' ELSE '0;1;2' END AS picked FROM part")
def likelihood_choice(t):
    """Of the likelihoods of three alleles' genotypes those of two."""
    gt = F.when(F.col("p_partkey") % 2 == 0, "0/2").otherwise("0/1")
    return t.part.select("p_partkey", X.likelihoods(F.lit("0;1;2;3;4;5"), gt).alias("picked"))


EVENTS = "(SELECT p_partkey, p_partkey::BIGINT AS pos, CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'ACG' WHEN 2 THEN 'A' ELSE 'ACGT' END AS ref, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'A' WHEN 2 THEN 'ATT' ELSE 'AC' END AS alt FROM part)"


def _events(t) -> DataFrame:
    k = F.col("p_partkey")
    pick = lambda *v: F.get(F.array(*map(F.lit, v)), (k % 4).cast("int"))
    return t.part.select("p_partkey", k.cast("long").alias("pos"), pick("A", "ACG", "A", "ACGT").alias("ref"), pick("C", "A", "ATT", "AC").alias("alt"))


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 4 IN (0, 2) THEN pos ELSE pos + 1 END AS start, CASE p_partkey % 4 WHEN 0 THEN pos WHEN 1 THEN pos + 2 WHEN 2 THEN pos + 1 ELSE pos + 3 END AS "end",
CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 2 THEN '-' ELSE substr(ref, 2) END AS ref, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN '-' ELSE substr(alt, 2) END AS alt FROM {EVENTS}""")
def padded_events(t):
    return _events(t).select("p_partkey", X.padded_event(F.col("pos"), F.col("ref"), F.col("alt")).alias("e")).select("p_partkey", "e.*")


@query(f"SELECT p_partkey, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) > length(alt) THEN 'DEL' ELSE 'INS' END AS kind, 'chr' || pos % 9 || ':' || pos || '-' || (pos + length(ref) - 1) || ':' || ref || ':' || alt AS tag FROM {EVENTS}")
def event_tags(t):
    chrom = F.concat(F.lit("chr"), _text(F.col("pos") % 9))
    return _events(t).select("p_partkey", X.variant_type_unstripped(F.col("ref"), F.col("alt")).alias("kind"), X.event_tag(chrom, F.col("pos"), F.col("pos") + F.length("ref") - 1, F.col("ref"), F.col("alt")).alias("tag"))


@query(f"SELECT '' || pos % 9 AS chrom, CASE WHEN p_partkey % 6 = 0 THEN -1 ELSE pos - 1 END AS pos0, ref, alt FROM {EVENTS}")
def variant_list_source(t):
    rows = _events(t)
    path = _lines(t, rows, F.col("pos") % 9, F.when(F.col("p_partkey") % 6 == 0, "x").otherwise(_text("pos")), F.lit("."), F.col("ref"), F.col("alt"))
    return G.variant_list(t.spark, path)


@query(f"SELECT 's' || p_partkey % 5 AS sample, '' || pos % 9 AS chrom, pos - 1 AS pos0, ref, alt FROM {EVENTS}")
def panel_list_source(t):
    rows = _events(t)
    path = _path(t)
    K.tsv(rows.select(F.concat(F.lit("s"), _text(F.col("p_partkey") % 5)).alias("Sample"), F.lit("n").alias("NormalUsed"), (F.col("pos") % 9).alias("Chrom"), F.col("pos").alias("Start"), F.col("ref").alias("Ref"), F.col("alt").alias("Alt")), path)
    return G.panel_list(t.spark, path).select(F.col("Sample").alias("sample"), "chrom", "pos0", "ref", "alt")


@query("SELECT p_partkey, 'c.' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN 'A>G' WHEN 1 THEN 'delTT' ELSE '_' || (p_partkey + 1) || 'insCA' END AS cds, p_size || CASE p_partkey % 3 WHEN 0 THEN '_A_G' WHEN 1 THEN '_TT_?' ELSE '_?_CA' END AS key FROM part WHERE p_partkey % 4 <> 0")
def coding_change_source(t):
    k = F.col("p_partkey")
    change = F.when(k % 3 == 0, "A>G").when(k % 3 == 1, "delTT").otherwise(F.concat(F.lit("_"), _text(k + 1), F.lit("insCA")))
    path = _path(t)
    K.tsv(t.part.select("p_partkey", F.concat(F.lit("c."), _text(k), change).alias("cds"), F.when(k % 8 == 0, "").when(k % 4 != 0, _text("p_size")).alias("position")), path)
    rows = S.tsv(t.spark, path)
    return G.coding_records(rows, "cds", "position").select(F.col("p_partkey").cast("long").alias("p_partkey"), "cds", "key")


# ---------------------------------------------------------------- sequences


SEQUENCES = "(SELECT n_nationkey AS k, (SELECT string_agg(translate(md5(n_nationkey || ':' || i), '0123456789abcdef', 'ACGTACGTACGTACGT'), '' ORDER BY i) FROM range(40) AS r(i)) AS seq FROM nation)"
CHUNK = 100


def _fasta(t) -> DataFrame:
    line = lambda i: F.translate(F.md5(F.concat_ws(":", _text("n_nationkey"), _text(i))), "0123456789abcdef", "ACGTACGTACGTACGT")
    text = F.concat_ws("\n", F.concat(F.lit(">"), _text("n_nationkey"), F.lit(" a nation")), F.transform(F.sequence(F.lit(0), F.lit(39)), line))
    return G.fasta(t.spark, _lines(t, t.nation, text), CHUNK)


@query(f"SELECT p_partkey, substr(seq, (p_partkey % 1000 + 1)::INT, (p_size + 1)::INT) AS seq, translate(reverse(substr(seq, (p_partkey % 1000 + 1)::INT, (p_size + 1)::INT)), 'ACGT', 'TGCA') AS other, round(len(regexp_replace(substr(seq, (p_partkey % 1000 + 1)::INT, (p_size + 1)::INT), '[^GC]', '', 'g')) / (p_size + 1)::DOUBLE, 9) AS gc FROM part LEFT JOIN {SEQUENCES} s ON s.k = p_partkey % 30")
def reference_windows(t):
    """Bases around sites, their other strand and share of G and C, from FASTA in chunks; unknown chromosomes give null."""
    start = F.col("p_partkey") % 1000 + 1
    rows = t.part.select("p_partkey", _text(F.col("p_partkey") % 30).alias("chrom"), start.alias("start"), (start + F.col("p_size")).alias("end"))
    out = I.fetch(rows, _fasta(t), "chrom", "start", "end", "seq", CHUNK)
    return out.select("p_partkey", "seq", X.reverse_complement(F.col("seq")).alias("other"), F.round(I.gc_share(F.col("seq")), 9).alias("gc"))


@query(f"""
WITH e AS (SELECT p_partkey, '' || p_partkey % 25 AS chrom, (p_partkey % 1000 + 10)::BIGINT AS pos, p_partkey % 3 AS kind, seq FROM part JOIN {SEQUENCES} s ON s.k = p_partkey % 25)
SELECT p_partkey, chrom, CASE kind WHEN 1 THEN pos - 2 ELSE pos - 1 END AS pos0, CASE kind WHEN 0 THEN 'A' WHEN 1 THEN substr(seq, (pos - 1)::INT, 1) || 'CC' ELSE substr(seq, pos::INT, 1) END AS ref,
  CASE kind WHEN 0 THEN 'T' WHEN 1 THEN substr(seq, (pos - 1)::INT, 1) ELSE substr(seq, pos::INT, 1) || 'GG' END AS alt FROM e""")
def mutation_table_variants(t):
    """Rows of a mutation table as variants, with the base before put back where an allele is empty."""
    k = F.col("p_partkey")
    pick = lambda *v: F.get(F.array(*map(F.lit, v)), (k % 3).cast("int"))
    path = _path(t)
    K.tsv(t.part.select("p_partkey", F.lit("G").alias("Hugo_Symbol"), (k % 25).alias("Chromosome"), (k % 1000 + 10).alias("Start_Position"), pick("A", "CC", "-").alias("Reference_Allele"), pick("A", "CC", "-").alias("Tumor_Seq_Allele1"), pick("T", "-", "GG").alias("Tumor_Seq_Allele2"), F.lit("s").alias("Tumor_Sample_Barcode")), path)
    out = G.maf_variants(G.maf(t.spark, path), _fasta(t), CHUNK)
    return out.select(F.col("p_partkey").cast("long").alias("p_partkey"), "chrom", "pos0", "ref", "alt")


@query("SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS read_name, (l_orderkey % 2 * 16)::INT AS flag, l_partkey - 1 AS pos0, 60 AS mapq, '' || l_suppkey AS nm FROM lineitem")
def sam_source(t):
    name = F.concat_ws("/", *[_text(c) for c in LINE])
    path = _lines(t, t.lineitem, name, F.col("l_orderkey") % 2 * 16, F.lit("chr1"), F.col("l_partkey"), F.lit(60), F.lit("5M"), F.lit("="), F.col("l_partkey"), F.lit(0), F.lit("ACGTA"), F.lit("IIIII"), F.concat(F.lit("NM:i:"), _text("l_suppkey")))
    return G.sam(t.spark, path, "s").select("read_name", "flag", "pos0", "mapq", F.col("tags")["NM"].alias("nm"))


@query("SELECT p_partkey, '@' || p_partkey || chr(10) || 'ACGTA' || chr(10) || '+' || chr(10) || 'IIIII' AS record FROM part")
def converted_alignments(t):
    """Alignments written as FASTQ and put together again from its lines."""
    rows = t.part.select(_text("p_partkey").alias("read_name"), F.lit("ACGTA").alias("query"), F.lit("IIIII").alias("quals"), F.lit(0).alias("flag"))
    path = _path(t)
    K.alignments(rows, path, "fastq")
    back = t.spark.read.option("lineSep", "\n@").text(path).where("value != ''")
    record = F.concat(F.lit("@"), F.regexp_replace(F.regexp_replace("value", "^@", ""), r"\s+$", ""))
    return back.select(F.regexp_extract("value", r"(\d+)", 1).cast("long").alias("p_partkey"), record.alias("record"))


@query("SELECT p_brand AS brand, count(*) AS n, sum(p_size)::BIGINT AS total FROM part GROUP BY 1")
def split_and_gathered(t):
    """A table written in a folder for each value of a key, and read as one."""
    path = _path(t)
    T.split_by(t.part.select("p_brand", "p_size"), "p_brand", path)
    return t.spark.read.parquet(path).groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"), F.sum("p_size").alias("total"))


# ---------------------------------------------------------------- intervals


@query("SELECT '' || p_partkey % 9 AS chrom, p_size::BIGINT AS start1, p_size + 10::BIGINT AS end1, p_name AS name FROM part")
def bed_roundtrip(t):
    rows = t.part.select(_text(F.col("p_partkey") % 9).alias("c"), F.col("p_size").alias("s"), (F.col("p_size") + 10).alias("e"), "p_name")
    path = _path(t)
    K.bed(rows, path, "c", "s", "e", "p_name")
    return G.bed(t.spark, path)


@query("SELECT 'chr' || p_partkey % 9 AS chrom, p_size::BIGINT AS start1, p_size + 10::BIGINT AS end1, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_name AS name FROM part")
def interval_list_roundtrip(t):
    rows = t.part.select(F.concat(F.lit("chr"), _text(F.col("p_partkey") % 9)).alias("c"), F.col("p_size").alias("s"), (F.col("p_size") + 10).alias("e"), "p_partkey", "p_name")
    path = _path(t)
    K.interval_list(rows, path, "c", "s", "e", F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-"), F.col("p_name"), [("chr1", 1000)])
    return G.interval_list(t.spark, path)


@query("SELECT 'chr' || p_partkey % 9 AS chrom, p_size::BIGINT AS start1, p_size + 10::BIGINT AS end1 FROM part WHERE p_partkey % 5 <> 0")
def region_lines(t):
    s = F.col("p_size")
    line = F.when(F.col("p_partkey") % 5 == 0, "no region").otherwise(F.concat(F.lit("chr"), _text(F.col("p_partkey") % 9), F.lit(":"), _text(s), F.lit("-"), _text(s + 10)))
    return G.regions(t.spark, _lines(t, t.part, line))


@query("""
WITH g AS (SELECT p_partkey AS target, (p_partkey * 20)::BIGINT AS s, p_partkey * 20 + 9 AS e, p_partkey % 4 AS kind FROM part)
SELECT target, CASE kind WHEN 0 THEN 'canonical' WHEN 1 THEN 'other' ELSE 't' || target END AS gene FROM g""")
def gene_fallback(t):
    """The gene of a canonical exon that is half covered, else of another, else the target's own name."""
    k = F.col("p_partkey")
    targets = t.part.select(k.alias("target"), F.lit("1").alias("chrom"), (k * 20).alias("start"), (k * 20 + 9).alias("end"), F.concat(F.lit("t"), _text(k)).alias("name"))
    exons = lambda keep, width, gene: t.part.where(keep).select(F.lit("1").alias("e_chrom"), (k * 20).alias("e_start"), (k * 20 + width).alias("e_end"), F.lit(gene).alias("gene"), _text(k).alias("exon"))
    # kind 2 has an exon that is covered too little
    other = exons(k % 4 < 2, 9, "other").unionAll(t.part.where(k % 4 == 2).select(F.lit("1"), (k * 20 + 8), (k * 20 + 17), F.lit("little"), _text(k)))
    return copynumber.gene_names(targets, exons(k % 4 == 0, 9, "canonical"), other).select("target", "gene")


@query("""
WITH s AS (SELECT c_custkey AS segment, c_nationkey * 4 AS lo, c_nationkey * 4 + 9 AS hi, c_acctbal AS mean FROM customer)
SELECT p_partkey AS probe, round(avg(mean), 6) AS mean, count(*) AS n FROM part JOIN s ON p_size * 2 BETWEEN lo AND hi GROUP BY 1""")
def segment_means(t):
    """The mean of the segments that hold a probe."""
    probes = t.part.select(F.col("p_partkey").alias("probe"), (F.col("p_size") * 2).alias("at"))
    lo = F.col("c_nationkey") * 4
    found = t.customer.select(lo.alias("lo"), (lo + 9).alias("hi"), F.col("c_acctbal").alias("mean"))
    totals = I.holder_totals(probes, found, "at", ("lo", "hi"), "mean", width=10).groupBy("probe").agg(F.sum("total").alias("total"), F.sum("counted").alias("counted"), F.sum("n").alias("n"))
    return totals.select("probe", F.round(F.try_divide("total", "counted"), 6).alias("mean"), "n")


@query("SELECT event_id, (user_id % 9 IN (0, 1) OR user_id % 7 IN (0, 1)) AND value BETWEEN 10 AND 20 AS hotspot FROM events WHERE value IS NOT NULL")
def hotspot_breakpoints(t):
    """Whether a breakpoint lies in a hotspot; here both have one value, so either counts."""
    u = F.col("user_id")
    sv = t.events.where("value is not null").select("event_id", _text(u % 9).alias("chrom"), F.col("value").alias("pos"), _text(u % 7).alias("chrom2"), F.col("value").alias("end"))
    spots = t.spark.createDataFrame([("0", 10.0, 20.0), ("1", 10.0, 20.0)], "chrom string, start double, end double")
    return structural.at_hotspots(sv, spots, ["event_id"]).select("event_id", "hotspot")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'fusion ' || p_partkey END AS fusion FROM part")
def fusion_annotation(t):
    """Junctions with what a table says of both breakpoints; X and Y are 23 and 24 there."""
    k = F.col("p_partkey")
    sv = t.part.select("p_partkey", F.when(k % 2 == 0, "chrX").otherwise("7").alias("chrom"), k.alias("pos"), F.lit("Y").alias("chrom2"), (k + 5).alias("end"))
    known = t.part.where(k % 3 != 0).select(F.when(k % 2 == 0, "23").otherwise("chr7").alias("chrom"), k.alias("pos"), F.lit("24").alias("chrom2"), (k + 5).alias("end"), F.concat(F.lit("fusion "), _text(k)).alias("fusion"))
    return structural.with_fusions(sv, known).select("p_partkey", "fusion")


# ---------------------------------------------------------------- counting


@query("""SELECT p_partkey AS pos, p_size % 3 + p_size % 2 + p_size % 4 + p_size % 5 AS total, p_size % 3 AS ref_forward, p_size % 2 AS ref_reverse, p_size % 4 AS alt_forward, p_size % 5 AS alt_reverse,
printf('%.5f', (p_size % 4 + p_size % 5) / greatest(1, p_size % 3 + p_size % 2 + p_size % 4 + p_size % 5)::DOUBLE) AS vf FROM part""")
def pileup_source(t):
    """Allele counts by strand from lines of mpileup, with read starts and ends, gaps and an insertion between."""
    n = lambda m: F.col("p_size") % m
    many = lambda c, m: F.repeat(F.lit(c), n(m))
    bases = F.concat(many("^].", 3), many(",", 2), many("C", 4), F.lit("*"), many("c$", 5), F.lit("*"))
    depth = n(3) + n(2) + n(4) + n(5)
    path = _lines(t, t.part, F.lit("chr1"), F.col("p_partkey"), F.lit("A"), depth, bases, F.lit("I"))
    lines = G.pileup(t.spark, path)
    sites = t.part.select(F.lit("chr1").alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    return C.pileup_counts(lines, sites).select("pos", "total", "ref_forward", "ref_reverse", "alt_forward", "alt_reverse", "vf")


READS = "(SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey AS name, l_orderkey % 4 = 1 AS rev, l_partkey AS s, l_orderkey % 3 AS kind, l_partkey + CASE l_orderkey % 3 WHEN 1 THEN 34 WHEN 2 THEN 31 ELSE 32 END AS e FROM lineitem)"


def _indel_reads(t) -> DataFrame:
    k = F.col("l_orderkey")
    return t.lineitem.select(F.lit(0).alias("sample"), F.concat_ws("/", _text(k), _text("l_linenumber"), _text("l_partkey")).alias("read_name"), F.when(k % 4 == 1, 16).otherwise(0).alias("flag"), F.lit("1").alias("chrom"), F.col("l_partkey").alias("pos0"), F.lit(60).alias("mapq"),
        F.when(k % 3 == 1, "10M2D22M").when(k % 3 == 2, "10M1I21M").otherwise("32M").alias("cigar"), F.lit("ACGT" * 8).alias("query"), F.lit("I" * 32).alias("quals"))


@query(f"""
WITH v AS (SELECT p_partkey AS pos FROM part), o AS (SELECT pos, name, rev, kind, CASE WHEN kind = 1 AND pos = s + 9 THEN 'alt' WHEN kind = 2 AND pos = s + 9 OR kind = 1 AND pos IN (s + 10, s + 11) THEN 'other' ELSE 'ref' END AS shows FROM v JOIN {READS} ON pos BETWEEN s AND e - 2)
SELECT pos + twin AS variant_id, count(*) AS dp, count(*) FILTER (shows = 'ref') AS rd, count(*) FILTER (shows = 'alt') AS ad, count(*) FILTER (NOT rev) AS dpp FROM o, (VALUES (0), (10000000)) AS t(twin) GROUP BY 1""")
def indel_counts(t):
    """A deletion's reads: the same operation right after the site; each variant is there twice and counted once."""
    site = lambda more: t.part.select((F.col("p_partkey") + more).alias("variant_id"), F.lit("1").alias("chrom"), F.col("p_partkey").alias("pos0"), F.lit("ACG").alias("ref"), F.lit("A").alias("alt"))
    return C.base_counts(_indel_reads(t), site(0).unionAll(site(10_000_000))).select("variant_id", "dp", "rd", "ad", "dpp")


@query("""
WITH o AS (SELECT l_suppkey AS variant_id, l_orderkey AS name, l_linenumber % 2 = 1 AS rev, substr('ACGT', (l_partkey % 4 + 1)::INT, 1) AS b FROM lineitem),
f AS (SELECT variant_id, name, count(*) FILTER (b = 'A') AS rd, count(*) FILTER (b = 'C') AS ad, greatest(count(*) FILTER (rev), count(*) FILTER (NOT rev)) > 1 AS many FROM o GROUP BY 1, 2)
SELECT variant_id, count(*) AS dpf, sum(CASE WHEN many THEN 0 WHEN rd > 0 AND ad > 0 THEN 0.5 WHEN rd > 0 THEN 1 ELSE 0 END)::DOUBLE AS rdf, sum(CASE WHEN many THEN 0 WHEN rd > 0 AND ad > 0 THEN 0.5 WHEN ad > 0 THEN 1 ELSE 0 END)::DOUBLE AS adf FROM f GROUP BY 1""")
def fragment_counts(t):
    """Counts by fragment: lines of an order are its reads, a supplier a site."""
    base = F.get(F.array(*map(F.lit, "ACGT")), (F.col("l_partkey") % 4).cast("int"))
    reads = t.lineitem.select(F.lit(0).alias("sample"), _text("l_orderkey").alias("read_name"), F.when(F.col("l_linenumber") % 2 == 1, 16).otherwise(0).alias("flag"), F.lit("1").alias("chrom"), F.col("l_suppkey").alias("pos0"), F.lit(60).alias("mapq"), F.lit("1M").alias("cigar"), base.alias("query"), F.lit("I").alias("quals"))
    sites = t.lineitem.select(F.col("l_suppkey").alias("variant_id")).distinct().select("variant_id", F.lit("1").alias("chrom"), F.col("variant_id").alias("pos0"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    return C.base_counts(reads, sites).select("variant_id", "dpf", "rdf", "adf")


@query("SELECT p_partkey AS locus, p_size AS a, p_size % 7 AS c FROM part")
def base_depth_source(t):
    path = _lines(t, t.part, F.col("p_partkey"), F.lit(9), F.lit(9), F.lit(9), F.concat(F.lit("A:"), _text("p_size"), F.lit(" C:"), _text(F.col("p_size") % 7), F.lit(" G:0 T:0 N:0")))
    d = F.col("depths")
    return G.base_depths(t.spark, path).select(F.col("locus").cast("long").alias("locus"), d["A"].cast("int").alias("a"), d["C"].cast("int").alias("c"))


@query("SELECT '' || p_partkey % 9 AS \"Chrom\", '' || p_partkey AS \"Pos\", '' || p_size AS \"BASEQ_depth.TUM\", '' || (p_size + 20) AS \"BASEQ_depth.NOR\" FROM part WHERE p_size + 20 >= 30 AND p_partkey % 10 <> 0")
def tumor_normal_counts(t):
    k = F.col("p_partkey")
    path = [_path(t), _path(t)]
    for p, depth in zip(path, (F.col("p_size"), F.col("p_size") + 20), strict=True):
        K.tsv(t.part.select((k % 9).alias("Chrom"), k.alias("Pos"), F.when(k % 10 == 0, "N").otherwise("A").alias("Ref"), F.lit("C").alias("Alt"), depth.alias("BASEQ_depth")), p)
    return copynumber.tumor_normal_counts(*[G.tumor_normal_counts(t.spark, p) for p in path], least=30).select("Chrom", "Pos", "`BASEQ_depth.TUM`", "`BASEQ_depth.NOR`")


# ---------------------------------------------------------------- metrics


@query("SELECT n_nationkey::VARCHAR AS sample, n_nationkey * 10.0::DOUBLE AS reads, CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE 0.0::DOUBLE END AS rate, greatest(0, (n_nationkey - 6) / 2.0)::DOUBLE AS neither FROM nation")
def picard_metrics(t):
    k = F.col("n_nationkey")
    text = F.concat(F.lit("## htsjdk\n## METRICS CLASS\tx\nREADS\tRATE\tUNMAPPED\tUNPAIRED\n"), _text(k * 10), F.when(k % 2 == 0, "\t?\t").otherwise("\t\t"), _text(k), F.lit("\t6\n\n## HISTOGRAM\tx\nsize\tn\n"), _text(k), F.lit("\t1\n9\t"), _text(k * 2), F.lit("\n"))
    wide = M.wide_metrics(M.metrics(t.spark, _per_sample(t, t.nation, "n_nationkey", text), IN_FOLDER), ["READS", "RATE", "UNMAPPED", "UNPAIRED"])
    return wide.select("sample", F.col("READS").alias("reads"), F.col("RATE").alias("rate"), M.neither(F.col("UNMAPPED"), F.col("UNPAIRED")).alias("neither"))


@query("SELECT n_nationkey::VARCHAR AS sample, n_nationkey::DOUBLE AS key, 1.0::DOUBLE AS value FROM nation UNION ALL SELECT n_nationkey::VARCHAR, 99.0, n_nationkey * 2.0 FROM nation")
def histogram_source(t):
    k = _text("n_nationkey")
    text = F.concat(F.lit("## METRICS CLASS\tx\nA\n1\n\n## HISTOGRAM\tx\nsize\tn\n"), k, F.lit("\t1\n99\t"), _text(F.col("n_nationkey") * 2), F.lit("\n"))
    return M.histogram(t.spark, _per_sample(t, t.nation, "n_nationkey", text), IN_FOLDER).select("sample", "key", "value")


@query("SELECT n_nationkey::VARCHAR AS sample, (1000 + n_nationkey)::DOUBLE AS reads, n_nationkey::DOUBLE AS trimmed FROM nation")
def log_numbers(t):
    k = F.col("n_nationkey")
    text = F.concat(F.lit("log of a run\nTotal reads processed: 1,"), F.lpad(_text(k), 3, "0"), F.lit("\nTrimmed reads: "), _text(k), F.lit("\nTrimmed reads: 0\n"))
    return M.key_values(t.spark, _per_sample(t, t.nation, "n_nationkey", text), {"reads": "Total reads processed", "trimmed": "Trimmed reads"}, IN_FOLDER)


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 <> 0")
def rejects_apart(t):
    """Rows kept and rejected in two files; what the second has is gone from the first."""
    kept, log = _path(t), _path(t)
    bad = F.col("p_partkey") % 3 == 0
    K.with_rejects(t.part.where(~bad).select("p_partkey", "p_name"), t.part.where(bad).select("p_partkey"), kept, log)
    rejected = S.tsv(t.spark, log).select(F.col("p_partkey").cast("long").alias("p_partkey"))
    back = S.tsv(t.spark, kept).select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name")
    return J.orphans(back, rejected.withColumnRenamed("p_partkey", "_k"), "p_partkey", "_k")


@query("SELECT p_partkey, p_size, p_name FROM part")
def report_formats(t):
    """A report as TSV and as JSON: what both have."""
    path = _path(t)
    K.report(t.part.select("p_partkey", "p_size", "p_name"), path)
    a = S.tsv(t.spark, f"{path}/tsv").select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("int").alias("p_size"))
    b = t.spark.read.schema("p_partkey long, p_name string").json(f"{path}/json")
    return a.join(b, "p_partkey")


@query("SELECT '' || p_partkey AS id, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS second FROM part")
def segment_sink(t):
    """White space in a segment's text becomes tabs, so that it is several columns."""
    path = _path(t)
    K.segments(t.part.select(F.concat_ws(" ", _text("p_partkey"), "p_name").alias("text")), path)
    parts = F.split(F.regexp_replace("value", '"', ""), "\t")
    return t.spark.read.text(path).where("value != 'text'").select(F.get(parts, F.lit(0)).alias("id"), F.get(parts, F.lit(1)).alias("first"), F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("second"))


@query("SELECT p_partkey, p_brand AS class FROM part WHERE p_partkey % 4 <> 0")
def functional_class(t):
    """Rows with a functional class."""
    from helixtab.operators.filters import with_value

    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, ".").otherwise(F.col("p_brand")).alias("class"))
    return with_value(rows.withColumn("class", X.missing(F.col("class"), ".")), "class")

