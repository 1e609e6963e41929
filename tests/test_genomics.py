"""Genomic semantics on small hand-made tables with literal expected rows."""

import random

import pytest
from pyspark.sql import functions as F

from helixtab import schema as S
from helixtab.functions import scalars as X
from helixtab.operators import copynumber as N
from helixtab.operators import counting as C
from helixtab.operators import filters as P
from helixtab.operators import intervals as I  # noqa: E741
from helixtab.operators import joins as J
from helixtab.operators import tables as T
from helixtab.operators import windows as W
from helixtab.plans import quality, somatic, structural
from helixtab.sources import genomic, metrics, tables, writers
from helixtab.streaming import events

VCF = """##fileformat=VCFv4.2
##INFO=<ID=DP,Number=1,Type=Integer,Description="x">
##FORMAT=<ID=GT,Number=1,Type=String,Description="x">
#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	T1	N1
1	100	rs1	A	G	50	PASS	DP=9;SOMATIC	GT:AD:DP:GQ	0/1:10,5:15:9	0/0:20,0:20:30
1	12252333	.	CTGTG	C,CTG,CTGTGTG	.	.	DP=3	GT:AD:DP	2/3:1,2,3,4:10	0/0:9,0,0,0:9
2	5	.	T	C	inf	LowQual	.	GT:AD	./.:.	0/0:3,0
X	7	.	AC	A	9	PASS	.	GT:AD:DP	0/1:6,6:12	0/1:5,5:10
"""


def put(path, text):
    path.write_text(text)
    return f"file://{path}"


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


@pytest.fixture
def vcf(spark, tmp_path):
    return genomic.vcf(spark, put(tmp_path / "a.vcf", VCF))


def test_vcf(spark, tmp_path, vcf):
    assert genomic.vcf_declared(spark, f"file://{tmp_path}/a.vcf") == {"INFO": {"DP": "Integer"}, "FORMAT": {"GT": "String"}}
    assert vcf.count() == 4 and vcf.columns[-2:] == ["T1", "N1"]
    long = genomic.genotypes(vcf)
    assert long.count() == 8
    first = long.where("pos = 100 and sample = 'T1'").first()
    assert first.info == {"DP": "9", "SOMATIC": ""} and first.fields == {"GT": "0/1", "AD": "10,5", "DP": "15", "GQ": "9"} and first["filter"] == "PASS"
    assert rows(P.called(vcf, "T1", "N1", True), "POS") == [("100",), ("12252333",)]
    assert [r[0] for r in rows(P.called(vcf, "T1", "N1", False), "POS")] == ["100", "12252333", "7"]
    kept, rejected = P.standard_alleles(vcf)
    assert kept.count() == 3 and rejected.first().reason == "infinite quality"


def test_mutation_table(spark, vcf):
    calls = somatic.genotype_calls(genomic.genotypes(vcf))
    got = {(r.pos, r["sample"]): r for r in calls.collect()}
    indel = got[12252337 if (12252337, "T1") in got else 12252333 + 5 - 1, "T1"]
    assert (indel.ref, indel.alt, indel.gt, indel.ad_alt) == ("-", "TG", "1/1", 4)
    assert (got[101 - 1, "T1"].alt_freq, got[100, "T1"].ad_ref) == ("0.3333", 10)
    deletion = got[8, "T1"]
    assert (deletion.ref, deletion.alt, deletion.gt) == ("C", "-", "0/1")
    assert (5, "T1") not in got
    pairs = spark.createDataFrame([("T1", "N1")], "tumor string, normal string")
    table = somatic.mutation_table(somatic.tumor_normal(calls, pairs), "GRCh37")
    one = table.where("Start_Position = 100").first()
    assert table.columns[: len(S.MAF_COLUMNS)] == list(S.MAF_COLUMNS)
    assert (one.Variant_Type, one.Tumor_Seq_Allele1, one.Tumor_Seq_Allele2, one.n_ref_count, one.End_Position) == ("SNP", "A", "G", "20", 100) or one.n_ref_count == 20
    common = somatic.mutation_table(somatic.genotype_calls(genomic.genotypes(vcf), keep_common=True).where("pos = 7 and sample = 'T1'"), "GRCh37", keep_common=True).first()
    assert (common.Variant_Type, common.Start_Position, common.Reference_Allele, common.Tumor_Seq_Allele2, common.End_Position) == ("DEL", 8, "C", "-", 8)


def test_annotate(spark):
    cols = "Chromosome string, Start_Position int, End_Position int, Reference_Allele string, Tumor_Seq_Allele1 string, Tumor_Seq_Allele2 string, Tumor_Sample_Barcode string, Matched_Norm_Sample_Barcode string, t_alt_count string, t_ref_count string, t_depth string, n_alt_count string, n_ref_count string, n_depth string, Variant_Type string"
    maf = spark.createDataFrame([("chr1", 5, 5, "A", "A", "G", "T", "N", "3", "1", "", "", "", "", "SNP"), ("2", 6, 6, "C", "T", "T", "T", "N", "1", "1", "2", "0", "0", "0", "SNP")], cols)
    pos = lambda *p: spark.createDataFrame([(x,) for x in p], "POS string")
    population = spark.createDataFrame([("chr1:5-5", 7, 70), ("chr2:6-6", 8, 80)], "POS string, AC int, AN int")
    seq = spark.createDataFrame([("chr1:5-5", "cag")], "POS string, seq string")
    out = {r.POS: r for r in somatic.annotate(maf, {"tri": seq}, {"panel": pos("2:6-6")}, population).collect()}
    a, b = out["chr1:5-5"], out["2:6-6"]
    assert (a.Chromosome, a.TAG, a.LABEL, a.tri, a.panel, a.t_var_freq, a.n_var_freq, a.pop_AC) == ("1", "chr1:5-5:A:G", "chr1:5-5:A:G::T:N", "CAG", "F", 0.75, "-", 7)
    assert (b.tri, b.panel, b.n_var_freq, b.pop_AC) == ("", "T", "0.0", None)
    repaired = {r.POS: r.pop_AC for r in somatic.annotate(maf, population=population, compat=False).collect()}
    assert repaired == {"chr1:5-5": 7, "2:6-6": 8}
    records = genomic.coding_records(spark.createDataFrame([("c.194A>G", "1:5-5", "lung"), ("c.?", "1:5-5", "no"), ("c.10_11insTG", "3:1-2", "x"), ("c.5+1delAC", "", "y")], "cds string, place string, site string"), "cds", "place")
    assert sorted(rows(records, "key")) == [("1:5-5_A_G",), ("3:1-2_?_TG",)]
    assert sorted(rows(somatic.coding_annotation(maf, records, ["site"]), "Chromosome", "site")) == [("2", ""), ("chr1", "lung")]


def test_rescue_and_filters(spark):
    kind = "id int, FILTER string, covered string, failure_reasons string, ta int, tr int, na int, nr int"
    data = [(1, "REJECT", "COVERED", "triallelic_site", 10, 90, 0, 50), (2, "REJECT", "COVERED", "triallelic_site,poor", 10, 90, 0, 50), (3, "REJECT", "COVERED", "DBSNP Site", 2, 98, 0, 50), (4, "REJECT", "UNCOVERED", "triallelic_site", 10, 9, 0, 5), (5, "REJECT", "COVERED", "triallelic_site", 10, 90, 5, 50)]
    df = spark.createDataFrame(data, kind)
    args = [F.col(c) for c in ("ta", "tr", "na", "nr")]
    assert [r[0] for r in rows(P.rescue(df, *args).where("FILTER = 'RESCUE'"), "id")] == [1, 3]
    assert [r[0] for r in rows(P.rescue(df, *args, compat=False).where("FILTER = 'RESCUE'"), "id")] == [1]
    counts = "id int, FILTER string, t_alt_count string, t_ref_count string, n_alt_count string, n_ref_count string"
    edge = [(1, None, "5", "0", "", ""), (2, None, "4", "0", "", ""), (3, "LowQual", "50", "0", "", ""), (4, None, "6", "14", "0", "8"), (5, None, "6", "13", "0", "8"), (6, None, "0", "0", "", ""), (7, "x", "NA", "1", "", ""), (8, None, "20", "20", "4", "4")]
    maf = spark.createDataFrame(edge, counts)
    assert [r[0] for r in rows(P.depth_frequency(maf), "id")] == [1, 4, 5, 8]
    assert [r[0] for r in rows(P.depth_frequency(maf, P.SOMATIC), "id")] == [4]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    assert [one(X.four_digits(lit(v))) for v in (0.5, 1 / 3, 0.0, 1.0, 12345.0, 0.00001234)] == ["0.5", "0.3333", "0", "1", "1.234e+04", "1.234e-05"]
    assert one(X.likelihoods(lit("a;b;c;d;e;f"), lit("0/2"))) == "a;d;f"
    assert one(X.likelihoods(lit("a;b;c"), lit("0/1"))) == "a;b;c"
    assert one(X.alternative_depth(F.array(lit(5), lit(2), lit(3)), lit("0/0"))) == 5 and one(X.alternative_depth(F.array(lit(5), lit(2), lit(3)), lit("1/2"))) == 3
    assert one(X.allele_depths(lit(None).cast("string"), lit(None).cast("string"), lit("1,2,3,4"))) == [3, 7]
    assert tuple(one(X.padded_event(lit(10), lit("CTG"), lit("C")))) == (11, 12, "TG", "-") and tuple(one(X.padded_event(lit(10), lit("C"), lit("CT")))) == (10, 11, "-", "T")
    assert tuple(one(X.anchored_event(lit(11), lit("TG"), lit("-"), lit("C")))) == (10, "CTG", "C") and tuple(one(X.anchored_event(lit(10), lit("-"), lit("T"), lit("C")))) == (10, "C", "CT")
    assert one(X.reverse_complement(lit("ACGTN"))) == "NACGT" and one(X.sex_to_number(lit("Y"))) == "24" and one(X.with_chr(lit("1"))) == "chr1"
    assert [one(X.same_major_band(lit(a), lit(b))) for a, b in (("7q31.2", "7q32"), ("7q31", "7q33"), ("7p1", "7q1"), ("7qter", "7q1"), ("7", "7q5"), ("8q1", "7q1"))] == [True, False, False, True, True, False]
    assert one(X.clean_name(lit("Mutation CDS (x)"))) == "mutation_cds_x_" and one(X.local_number(lit("1,234"))) == 1234.0 and one(X.leading_int(lit("12x"))) == 12 and one(X.leading_int(lit("x"))) == 0
    assert one(X.metric_value(lit("?"))) is None and one(X.metric_value(lit(""))) == 0.0 and one(X.two_decimals(lit(0.125))) == "0.12"
    assert abs(one(X.normal_p_value(lit(1.959964))) - 0.05) < 1e-6
    assert [tuple(one(X.read_offset(X.cigar_operations(lit("5S10M2D5M")), lit(100), lit(p)))) for p in (100, 109, 110, 112, 99, 117)] == [(5, "base"), (14, "base"), (14, "deletion"), (15, "base"), (None, None), (None, None)]
    alleles = one(X.pileup_bases(lit("^].,+2AG-1tA*$c"), lit("G")))
    assert [(a.allele, a.strand) for a in alleles] == [("G", "+"), ("G", "-"), ("+AG", "+"), ("-T", "-"), ("A", "+"), ("-", "+"), ("C", "-")]
    assert tuple(one(X.strands(lit("3to5")))) == (0, 1) and one(X.info_map(lit("a=1;b;a=2"))) == {"a": "2", "b": ""}


def test_sources(spark, tmp_path):
    assert rows(tables.pairing(spark, put(tmp_path / "p", "n1 t1\nNA t2\n\nn3\tt3\n"))) == [("t1", "n1"), ("t3", "n3")]
    assert tables.config(spark, put(tmp_path / "c", "A /x\n>S one\nk = v w\nj: 2\n#no\n")) == {"": {"A": "/x"}, "S one": {"k": "v w", "j": "2"}}
    assert rows(tables.preamble_tsv(spark, put(tmp_path / "m", "## x\ncontig\tposition\n1\t5\n"))) == [("1", "5")]
    with pytest.raises(tables.BadHeader):
        tables.tsv(spark, put(tmp_path / "t", "a\tb\n1\n"), required=("z",))
    assert rows(tables.tsv(spark, f"file://{tmp_path}/t")) == [("1", None)]
    assert rows(genomic.bed(spark, put(tmp_path / "b", "1\t0\t10\tx\n")), "start1", "end1", "name") == [(1, 10, "x")]
    assert rows(genomic.interval_list(spark, put(tmp_path / "i", "@HD\tx\n1\t5\t9\t+\tg\n"))) == [("1", 5, 9, "+", "g")]
    assert rows(genomic.regions(spark, put(tmp_path / "r", "1:5-9\nbad\n"))) == [("1", 5, 9)]
    ref = genomic.fasta(spark, put(tmp_path / "f", ">1 x\nACGTA\nCGT\n>2\nTTTT\n"), 3)
    assert sorted(rows(ref)) == [("1", 0, "ACG"), ("1", 1, "TAC"), ("1", 2, "GT"), ("2", 0, "TTT"), ("2", 1, "T")]
    spans = spark.createDataFrame([("1", 2, 7), ("2", 4, 4)], "chrom string, s int, e int")
    assert sorted(rows(I.fetch(spans, ref, "chrom", "s", "e", "bases", 3))) == [("1", 2, 7, "CGTACG"), ("2", 4, 4, "T")]
    picard = "## htsjdk\n## METRICS CLASS\tx\nA\tB\n1\t?\n2\t\n\n## HISTOGRAM\tint\nsize\tn\n5\t7\n6\t8\n"
    put(tmp_path / "s1.metrics", picard)
    long = metrics.metrics(spark, f"file://{tmp_path}/*.metrics", r"([^/]+)\.metrics$")
    assert sorted(rows(metrics.wide_metrics(long, ["A", "B"]))) == [("s1", 0, 1.0, None), ("s1", 1, 2.0, 0.0)]
    assert rows(metrics.histogram(spark, f"file://{tmp_path}/*.metrics", r"([^/]+)\.metrics$"), "key", "value") == [(5.0, 7.0), (6.0, 8.0)]
    put(tmp_path / "c.log", "Total reads processed:   1,234\nx\nReads written: 12\n")
    assert rows(metrics.key_values(spark, f"file://{tmp_path}/*.log", {"n": "Total reads processed", "w": "Reads written"}), "n", "w") == [(1234.0, 12.0)]
    reads = genomic.sam(spark, put(tmp_path / "x.sam", "@HD\tVN:1\nr1\t16\t1\t101\t60\t5M\t*\t0\t0\tACGTA\tIIIII\tNM:i:0\tRG:Z:a:b\n"))
    r = reads.first()
    assert (r["sample"], r.pos0, r.tags) == ("x", 100, {"NM": "0", "RG": "a:b"})
    writers.alignments(reads, f"file://{tmp_path}/out-fastq", "fastq")
    assert [x.value for x in spark.read.text(f"file://{tmp_path}/out-fastq").collect()] == ["@r1", "ACGTA", "+", "IIIII"]
    writers.single(spans, f"file://{tmp_path}/one", ["#v 1"], ["s"])
    assert sorted(x.value for x in spark.read.text(f"file://{tmp_path}/one").collect()) == ["#v 1", "1\t2\t7", "2\t4\t4", "chrom\ts\te"]
    maf = spark.createDataFrame([("1", 3, "G", "G", "-"), ("1", 3, "-", "-", "TT")], "Chromosome string, Start_Position int, Reference_Allele string, Tumor_Seq_Allele1 string, Tumor_Seq_Allele2 string")
    assert sorted(rows(genomic.maf_variants(maf, ref, 3), "pos0", "ref", "alt")) == [(1, "CG", "C"), (2, "G", "GTT")]


def slow_counts(reads, variants):
    out = {}
    for vid, pos, ref, alt in variants:
        for name, flag, start, cigar, query in reads:
            import re

            at, q, shows = start, 0, None
            ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDS])", cigar)]
            end = start + sum(n for n, o in ops if o in "MD") - 1
            if not start <= pos <= end:
                continue
            after, base = None, None
            for n, o in ops:
                if o in "IS":
                    if o == "I" and at == pos + 1:
                        after = ("I", n, query[q : q + n])
                    q += n
                elif o == "M":
                    if at <= pos < at + n:
                        base = query[q + pos - at]
                    at, q = at + n, q + n
                else:
                    if at == pos + 1:
                        after = ("D", n, "")
                    if at <= pos < at + n:
                        base = "U"
                    at += n
            if len(ref) == len(alt):
                shows = "U" if base == "U" else "ref" if base == ref[0] else "alt" if base == alt[0] else "other"
            elif pos < end:
                want = ("I", len(alt) - len(ref), alt[len(ref) :]) if len(alt) > len(ref) else ("D", len(ref) - len(alt), "")
                shows = "alt" if after == want else "ref" if after is None and base != "U" else "other"
            if shows:
                c = out.setdefault(vid, dict(dp=0, rd=0, ad=0))
                c["dp"] += 1
                c["rd"] += shows == "ref"
                c["ad"] += shows == "alt"
    return out


def test_base_counts(spark):
    r = random.Random(3)
    reads = []
    for i in range(120):
        cigar = r.choice(["30M", "10M2D20M", "12M3I15M", "5S25M", "20M1D5M2I3M"])
        import re

        n = sum(int(k) for k, o in re.findall(r"(\d+)([MIS])", cigar))
        reads.append((f"r{i // 2}", r.choice((0, 16)), r.randint(80, 110), cigar, "".join(r.choice("ACGT") for _ in range(n))))
    variants = [(1, 105, "A", "C"), (2, 110, "GT", "G"), (3, 112, "A", "AGCT"), (4, 115, "TAA", "T"), (5, 105, "A", "C")]
    aln = spark.createDataFrame([("s", *x[:2], "1", x[2], 60, x[3], x[4], "I" * len(x[4])) for x in reads], "sample string, read_name string, flag int, chrom string, pos0 long, mapq int, cigar string, query string, quals string")
    v = spark.createDataFrame([(i, "1", p, a, b) for i, p, a, b in variants], "variant_id int, chrom string, pos0 long, ref string, alt string")
    out = {x.variant_id: x for x in C.base_counts(aln, v, ["s", "none"]).where("sample = 's'").collect()}
    want = slow_counts(reads, variants)
    for i, *_ in variants:
        assert {k: out[i][k] for k in ("dp", "rd", "ad")} == want[i], i
    assert out[1].asDict() | {"variant_id": 0} == out[5].asDict() | {"variant_id": 0}
    assert C.base_counts(aln, v, ["s", "none"]).where("sample = 'none' and dp = 0").count() == 5
    assert out[1].rdf + out[1].adf <= out[1].dpf <= out[1].dp


def test_pileup_counts(spark):
    pile = spark.createDataFrame([("1", 5, "A", 6, "..,Cc+2TT."), ("1", 9, "G", 3, ".+1A,.")], "chrom string, pos long, ref_base string, depth int, bases string")
    mut = spark.createDataFrame([("1", 5, "A", "C"), ("1", 9, "G", "GA"), ("2", 1, "A", "T")], "chrom string, pos long, ref string, alt string")
    out = {(r.chrom, r.pos): (r.total, r.ref_forward, r.ref_reverse, r.alt_forward, r.alt_reverse, r.vf) for r in C.pileup_counts(pile, mut).collect()}
    assert out == {("1", 5): (6, 3, 1, 1, 1, "0.33333"), ("1", 9): (3, 1, 1, 1, 0, "0.33333"), ("2", 1): (0, 0, 0, 0, 0, "0.00000")}


def test_intervals_against_naive(spark):
    r = random.Random(11)
    make = lambda n, p: [(i, r.choice("12X"), a := r.randint(0, 3000), a + r.choice((0, 5, 80, 900))) for i in range(n)]
    a, b = make(150, "a"), make(150, "b") + [(999, "1", 50, 10), (998, "1", None, 5)]
    left = spark.createDataFrame(a, "i int, c string, s int, e int")
    right = spark.createDataFrame(b, "j int, c2 string, s2 int, e2 int")
    want = sorted((x[0], y[0]) for x in a for y in b if y[2] is not None and y[2] <= y[3] and x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    for width in (7, 100, 16_384):
        got = I.overlap_join(left, right, ("s", "e"), ("s2", "e2"), (("c", "c2"),), width)
        assert sorted(rows(got, "i", "j")) == want
    assert sorted(rows(I.merge(left, ["c"], "s", "e"))) == sorted(rows(I.merge(left, ["c"], "s", "e", width=50)))
    assert sorted(rows(I.depth(left, ["c"], "s", "e"))) == sorted(rows(I.depth(left, ["c"], "s", "e", width=64)))


def test_fingerprint(spark):
    counts = spark.createDataFrame([("T", "l1", {"A": "50", "C": "50"}), ("N", "l1", {"A": "100", "C": "1"}), ("T", "l2", {"G": "99", "T": "1"}), ("N", "l2", {"G": "100"}), ("T", "l3", {}), ("N", "l3", {"A": "9"})], "sample string, locus string, depths map<string,string>")
    sites = spark.createDataFrame([("l1", "A/C"), ("l2", "G/T"), ("l3", "A/C")], "locus string, alleles string")
    g = quality.fingerprint_genotypes(counts, sites)
    assert {(r["sample"], r.locus): r.genotype for r in g.collect()} == {("T", "l1"): "AC", ("N", "l1"): "AA", ("T", "l2"): "GG", ("N", "l2"): "GG", ("T", "l3"): "--", ("N", "l3"): "AA"}
    groups = spark.createDataFrame([("T", "g1"), ("N", "g2")], "sample string, group string")
    pairs = spark.createDataFrame([("T", "N")], "tumor string, normal string")
    out = quality.fingerprint(g, groups, pairs)
    assert {r["sample"]: round(r.heterozygous, 3) for r in out["heterozygous"].collect()} == {"T": 0.333, "N": 0.0}
    assert {r["sample"]: round(r.minor, 4) for r in out["minor"].collect()} == {"T": 0.005, "N": round((1 / 101) / 3, 4)}
    assert {(r.reference, r.query): (r.sites, r.discordance) for r in out["discordance"].collect()} == {("T", "N"): (1, 0.0), ("N", "T"): (3, 0.0), ("T", "T"): (1, 0.0), ("N", "N"): (3, 0.0)}
    assert rows(out["unexpected_match"], "a", "b") == [("N", "T")] and out["unexpected_mismatch"].count() == 0
    repaired = quality.fingerprint(g, groups, pairs, compat=False)
    assert {r["sample"]: round(r.minor, 4) for r in repaired["minor"].collect()}["T"] == 0.01 and {r["sample"]: r.heterozygous for r in repaired["heterozygous"].collect()}["T"] == 0.5


def test_structural(spark):
    sv = spark.createDataFrame([(1, "1", 100, "2", 500), (2, "1", 100, "1", 900), (3, "X", 7, "3", 3)], "id int, chrom string, pos long, chrom2 string, end long")
    hot = spark.createDataFrame([("2", 400, 600), ("1", 800, 1000)], "chrom string, start long, end long")
    assert [r.hotspot for r in structural.at_hotspots(sv, hot, ["id"]).orderBy("id").collect()] == [False, False, False]
    assert [r.hotspot for r in structural.at_hotspots(sv, hot.where("chrom = '2'"), ["id"]).orderBy("id").collect()] == [True, False, False]
    assert [r.hotspot for r in structural.at_hotspots(sv, hot, ["id"], compat=False).orderBy("id").collect()] == [True, True, False]
    rows_of = lambda kind, **o: [r.id for r in P.structural_variants(calls, kind, **o).orderBy("id").collect()]
    base = dict(chrom="1", chrom2=None, pos=1, end=900, mapq=10, pairs=5, split_reads=0, t_reads=2, n_reads=2, label="x", n_label="x", hotspot=False)
    edges = [{}, {"mapq": 9}, {"end": 500}, {"n_reads": 3}, {"hotspot": True, "pairs": 3, "mapq": 5, "t_reads": 1, "n_reads": 3}, {"hotspot": True, "pairs": 0, "label": "PASS", "n_label": "LowQual"}, {"chrom2": "GL1"}, {"chrom": "chrX"}]
    names = "chrom string, chrom2 string, pos int, end int, mapq int, pairs int, split_reads int, t_reads int, n_reads int, label string, n_label string, hotspot boolean"
    calls = spark.createDataFrame([(i, *(base | x).values()) for i, x in enumerate(edges)], f"id int, {names}")
    assert rows_of("DEL") == [0, 4, 5, 7] and rows_of("BND") == [0, 2, 4, 5, 7] and rows_of("TRA") == [] and rows_of("TRA", compat=False) == rows_of("BND")
    fusions = spark.createDataFrame([("chr1", 100, "chr2", 500, "old"), ("chr1", 100, "chr2", 500, "new"), ("chrX", 7, "chr3", 3, "x")], "chrom string, pos long, chrom2 string, end long, fusion string").coalesce(1)
    assert sorted(rows(structural.with_fusions(sv, fusions), "id", "fusion")) == [(1, "new"), (2, None), (3, "x")]
    targets = spark.createDataFrame([("a", "1", 1, 100), ("b", "1", 200, 300), ("c", "1", 400, 500), ("d", "1", 600, 700)], "target string, chrom string, start long, end long")
    exons = spark.createDataFrame([("1", 1, 100, "G", "e1"), ("1", 240, 280, "H", "e1"), ("1", 390, 600, "G", "e2"), ("1", 650, 660, "G", "e3")], "e_chrom string, e_start long, e_end long, gene string, exon string")
    bands = spark.createDataFrame([("1", 0, 250, "p1"), ("1", 251, 9000, "p2")], "b_chrom string, b_start long, b_end long, band string")
    out = structural.panel(targets, exons, bands)
    assert sorted(rows(out, "target", "label", "band")) == [("a", "G_target_1", "p1"), ("b", "H_target_1", "p1"), ("c", None, "p2"), ("d", "G_target_1", "p2")]


def test_copy_number(spark):
    import numpy as np

    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(0, 0.1, 60), r.normal(1, 0.1, 25), r.normal(0, 0.1, 40)])
    found = N.circular_segments(x, permutations=99)
    assert [round(m) for *_, m in found] == [0, 1, 0] and abs(found[0][1] - 60) <= 1 and abs(found[1][1] - 85) <= 1
    assert len(N.circular_segments(r.normal(0, 1, 80), permutations=99)) == 1
    gc = r.uniform(0.2, 0.8, 400)
    cov = (10 + 8 * (gc - 0.5) ** 2 * 4) ** 2 + r.normal(0, 1, 400)
    df = spark.createDataFrame([("s", f"t{i}", "1", bool(i % 2), float(gc[i]), float(cov[i])) for i in range(400)], "sample string, target string, chrom string, tiling boolean, gc double, cov double")
    norm = np.array([x.norm for x in N.gc_normalised(df).collect()])
    assert np.std(norm) / np.mean(norm) < 0.5 * np.std(cov) / np.mean(cov)
    values = [(1, i, v) for i, v in enumerate([0.1, 0.0, -0.05, 0.02, -1.5, -1.6, -1.55, 0.04])]
    genes = spark.createDataFrame(values, "gene int, pos int, lr double")
    hit = N.intragenic(genes, ["gene"], "pos", "lr").first()
    assert (hit.run, hit.n_outer) == (3, 3) and N.intragenic(genes.where("lr > -1"), ["gene"], "pos", "lr", ratio=50).count() == 0


def test_segments_at_full_resolution():
    import numpy as np

    r = np.random.default_rng(1)
    for n in (4, 7, 100, 401, 777):
        x = r.normal(0, 1, n).cumsum() if n % 2 else r.normal(0, 1, n)
        s = np.concatenate(([0.0], np.cumsum(x - x.mean())))
        i, j = np.triu_indices(n + 1, 2)
        i, j = i[j - i <= n - 2], j[j - i <= n - 2]
        top = (np.abs(s[j] - s[i]) / np.sqrt((j - i) * (n - j + i) / n)).max()
        assert abs(N._arc(x, 2)[0] - top) < 1e-9 * max(1, top)
    x = r.normal(0, 0.1, 5000)
    x[3001:3009] += 1
    assert [(p, q) for p, q, _ in N.circular_segments(x)] == [(0, 3001), (3001, 3009), (3009, 5000)]


def test_segments_query_can_cut(spark, tmp_path):
    from datetime import datetime, timedelta

    from helixtab.plans import queries as Q

    rows = [(h, datetime(2024, 1, 1) + timedelta(hours=h), h % 24, "click", 1.0 + h % 3 / 10, "{}") for h in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, payload string").write.parquet(str(tmp_path / "events.parquet"))
    assert [r.n for r in Q.QUERIES["cbs_segments"](spark, str(tmp_path)).orderBy("start").collect()] == [67, 67, 66]  # the step that the query plants over the middle third


def test_quality_plan(spark):
    facts = spark.createDataFrame([("s1", "1.0", "?"), ("s2", "", "3")], "sample string, a string, b string")
    later = spark.createDataFrame([("s1", "9")], "sample string, a string")
    store = spark.createDataFrame([("s0", 5.0, 5.0), ("s1", 0.0, 0.0)], "sample string, a double, b double")
    assert sorted(rows(quality.stored_facts(store, [facts, later], ["sample"], ["a", "b"]), "sample", "a", "b")) == [("s0", 5.0, 5.0), ("s1", 9.0, None), ("s2", 0.0, 3.0)]
    m = spark.createDataFrame([("s1", "coverage", 40.0), ("s2", "coverage", 100.0), ("s1", "aligned", 0.99)], "sample string, metric string, value double")
    assert {r.metric: r.status for r in quality.alerts(m).collect()} == {"coverage": "0FAIL", "aligned": "2PASS"}
    status = quality.sample_status(m)
    assert {r["sample"]: r.status for r in status.collect()} == {"s1": "0FAIL", "s2": "1WARN"} and quality.project_status(status).first().status == "FAIL"
    hist = spark.createDataFrame([("a", 0, 1.0, 5.0), ("b", 0, 2.0, 6.0), ("b", 1, 2.0, 7.0)], "sample string, n int, key double, value double")
    assert sorted(rows(quality.merged_histograms(hist, ["a", "b"]))) == [(1.0, 5.0, 0.0), (2.0, 0.0, 6.0)]
    mapping = spark.createDataFrame([("l", "s1", "p1"), ("l", "s2", "p1")], "library string, sample string, path string")
    grouping = spark.createDataFrame([("s1", "g"), ("s9", "g")], "sample string, group string")
    pairing = spark.createDataFrame([("s1", "s7")], "tumor string, normal string")
    patients = spark.createDataFrame([("s1",)], "Sample_ID string")
    found = {r.rule: r.n for r in quality.integrity(mapping, grouping, pairing, patients).collect()}
    assert found == {"sample without group": 1, "group of unknown sample": 1, "pair of unknown sample": 1, "sample without patient": 1, "pair twice": 0, "path twice": 1}


def test_checked_operators(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    with pytest.raises(T.SchemaMismatch):
        T.union_checked(a, a.withColumnRenamed("y", "z"))
    with pytest.raises(J.Unmatched):
        J.matched(a, a.where("false"), ["x"])
    with pytest.raises(ValueError):
        P.property_filter(a, {"one": {"x": ">0"}}, "two")
    assert W.adjust(spark.createDataFrame([("g", 0.01), ("g", 0.04), ("g", 0.03), ("g", None)], "g string, p double"), ["g"], "p").select(F.round("p_adjusted", 6)).where("p is not null").count() == 3


def test_streaming(spark, tmp_path):
    data = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    data.repartition(3).write.parquet(f"file://{tmp_path}/in")
    stream = events.files(spark, f"file://{tmp_path}/in", data.schema)
    for name, made in (("t", events.tumbling(stream, "ts", "1 hour", ["event_type"], "value", "400 days")), ("s", events.sessions(stream, "ts", "30 minutes", ["user_id"], "400 days")), ("u", events.unique(stream, "ts", ["event_id"], "400 days"))):
        events.to_parquet(made, f"file://{tmp_path}/{name}", f"file://{tmp_path}/check-{name}").awaitTermination()
    assert spark.read.schema(data.schema).parquet(f"file://{tmp_path}/u").count() == data.count()


def test_copy_number_plan(spark):
    import numpy as np

    from helixtab.plans import copynumber as K

    r = np.random.default_rng(8)
    targets = [(f"t{i}", "1" if i < 80 else "Y", i * 1000, f"G{i // 10}") for i in range(100)]
    cov = [(t[0], s, float(100 * (4 if s == "T1" and 20 <= i < 40 else 1) * 2 ** r.normal(0, 0.05))) for s in ("T1", "T2") for i, t in enumerate(targets)]
    norm = [(t[0], s, float(100 * 2 ** r.normal(0, n))) for s, n in (("N1", 0.05), ("N2", 0.5)) for t in targets]
    table = lambda rows: spark.createDataFrame(rows, "target string, sample string, cov double")
    out = K.project(table(cov), table(norm), spark.createDataFrame(targets, "target string, chrom string, position long, gene string"))
    assert {(x.tumor, round(x["mean"])) for x in out["segments"].collect()} == {("T1", 0), ("T1", 2), ("T2", 0)}
    calls = {(x.gene, x["sample"]): x.call for x in out["calls"].collect()}
    assert {k for k, v in calls.items() if v == 2} == {("G2", "T1"), ("G3", "T1")} and set(calls.values()) == {0, 2}
    wide = {x.gene: (x.T1, x.T2, x.T3) for x in K.call_matrix(out["calls"], ["T1", "T2", "T3"]).collect()}
    assert wide["G2"] == ("2", "0", "NA") and len(wide) == 8
    counts = "Chrom string, Pos int, Ref string, Alt string, BASEQ_depth string"
    t = spark.createDataFrame([("1", 1, "A", "C", "9"), ("1", 2, "N", "C", "9"), ("1", 3, "A", "CT", "9"), ("1", 4, "A", "C", "9")], counts)
    n = spark.createDataFrame([("1", 1, "A", "C", "25"), ("1", 2, "N", "C", "99"), ("1", 4, "A", "C", "24")], counts)
    assert rows(K.tumor_normal_counts(t, n)) == [("1", 1, "A", "C", "9", "25")]
    exons = lambda *x: spark.createDataFrame([*x], "e_chrom string, e_start long, e_end long, gene string, exon string")
    places = spark.createDataFrame([("a", "1", 1, 10, "x"), ("b", "1", 20, 30, "y"), ("c", "1", 40, 50, "z")], "target string, chrom string, start long, end long, name string")
    named = K.gene_names(places, exons(("1", 5, 8, "G", "e")), exons(("1", 5, 8, "no", "e"), ("1", 21, 25, "H", "e"), ("1", 49, 90, "far", "e")))
    assert sorted(rows(named, "target", "gene")) == [("a", "G"), ("b", "H"), ("c", "z")]


def test_contamination(spark):
    from helixtab.operators import aggregates as A

    names = "TumorId string, Gene1 string, SV_Type string, Site1Description string, Site2Description string, Fusion string, BrkptType string"
    good, exon = ("Intron 1", "Exon 2", "-", "PRECISE"), ("Exon 1", "Exon 2", "-", "PRECISE")
    data = [("t1", "A", "DEL", *good), ("t1", "A", "DEL", *good), ("t1", "B", "DEL", *good), ("t1", "B", "DEL", *exon), ("t1", "C", "DEL", *good), ("t1", "C", "DEL", *good), ("t2", " ", "DEL", *good), ("t2", " ", "DEL", *good), ("t3", "A", "INV", *good), ("t3", "A", "INV", *good)]
    frame = [("t4", "A", "DEL", "Intron", "Intron", "Protein fusion: in frame", "PRECISE")] * 2 + [("t5", "A", "DEL", "Intron", "Intron", "-", "IMPRECISE")] * 2
    assert rows(A.contamination(spark.createDataFrame(data + frame, names), qualifying=A.like_cdna())) == [("t1", "A, C")]


def test_gene_matrices(spark):
    from helixtab.plans import copynumber as K

    calls = spark.createDataFrame([("a", "G", 1, 9, "no", 2, 1, 0, "DIPLOID"), ("b", "H", 3, 4, "yes", 3, 0, 2, "AMP")], "sample string, gene string, start int, end int, wgd string, mcn int, lcn int, state int, call string")
    states, alleles = K.gene_matrices(calls, ["a", "b"])
    assert sorted(rows(states)) == [("G", "0", "NA"), ("H", "NA", "2")]
    assert sorted(rows(alleles))[0] == ("G", "1;9;1;0;DIPLOID", "['NA', 'NA', 'NA', 'NA', 'NA']")
    assert sorted(rows(K.gene_matrices(calls, ["a", "b"], compat=False)[1])) == [("G", "no;2;1;0;DIPLOID", "NA"), ("H", "NA", "yes;3;0;2;AMP")]
    with pytest.raises(ValueError):
        K.gene_matrices(calls.unionAll(calls), ["a", "b"])


def test_fill_out(spark):
    samples = spark.createDataFrame([("T1", "P", "Tumor"), ("T2", "P", "Tumor"), ("N1", "P", "Normal"), ("N2", "P", "Normal"), ("PL", "P", "PoolNormal"), ("X", "Q", "Tumor")], "sample string, patient string, class string")
    pairs = spark.createDataFrame([("T1", "N1"), ("T1", "N2"), ("T2", "PL"), ("X", "N1")], "tumor string, normal string")
    events = spark.createDataFrame([("e", "T1", "N1"), ("f", "T2", "PL")], "event string, tumor string, normal string")
    counts = spark.createDataFrame([("e", s, f"DP={d};RD=1;AD={d - 1};VF=0") for s, d in (("T1", 9), ("T2", 3), ("N1", 2), ("N2", 1))], "event string, sample string, counts string")
    out = {(r.event, r.tumor, r.normal): (r.status, r.alt_count, r.n_alt_count) for r in somatic.fill_out(events, counts, samples, pairs).collect()}
    assert out == {
        ("e", "T1", "N1"): ("SOMATIC", 8, 1), ("e", "T1", "N2"): ("NONE", 8, 0), ("e", "T2", "REF"): ("NONE", 2, None), ("e", "X", "N1"): ("NONE", None, 1),
        ("f", "T2", "REF"): ("UNPAIRED", None, None), ("f", "T1", "N1"): ("NONE", None, None), ("f", "T1", "N2"): ("NONE", None, None), ("f", "X", "N1"): ("NONE", None, None),
    }
    assert somatic.fill_out(events, counts, samples, pairs, compat=False).where("status = 'SOMATIC_VS_POOL'").count() == 1


def test_fetch_and_census_keep_every_row(spark):
    from helixtab.operators import intervals, joins

    reference = spark.createDataFrame([("1", 0, "ACGTA"), ("1", 1, "CGTAC")], "ref_chrom string, chunk_no long, seq string")
    rows = spark.createDataFrame([("1", 2, 4), ("1", 2, 4), ("1", 4, 7), ("9", 1, 2), (None, 1, 2)], "chrom string, s long, e long")
    got = sorted(((r.chrom or "", r.s, r.seq) for r in intervals.fetch(rows, reference, "chrom", "s", "e", "seq", 5).collect()), key=str)
    assert got == [("", 1, None), ("1", 2, "CGT"), ("1", 2, "CGT"), ("1", 4, "TACG"), ("9", 1, None)]
    genes = spark.createDataFrame([("A", "x"), ("B", "")], "symbol string, says string")
    sites = spark.createDataFrame([("A", None), ("A", None), ("B", "A"), ("Z", "Z"), (None, None)], "g1 string, g2 string")
    out = joins.census(sites, genes, [("g1", "site1"), ("g2", "site2")], "symbol", ["says"])
    assert sorted(((r.g1, r.g2, r.census) for r in out.collect()), key=str) == sorted([("A", None, "site1:x"), ("A", None, "site1:x"), ("B", "A", "site1: <=>site2:x"), ("Z", "Z", None), (None, None, None)], key=str)


def test_upsert_does_not_depend_on_the_order_of_rows(spark):
    store = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = [(1, "a"), (1, "b"), (3, "c")]
    got = {tuple(sorted(map(tuple, T.upsert(store, spark.createDataFrame(n, "k int, v string"), ["k"]).collect()))) for n in (new, new[::-1])}
    assert len(got) == 1
    assert (1, "b") in map(tuple, T.upsert(store, spark.createDataFrame(new, "k int, v string"), ["k"], [F.desc("v")]).collect())


def test_circular_segments_find_planted_steps():
    import numpy as np

    from helixtab.operators import copynumber

    for n, at, end in ((390, 100, 160), (1000, 503, 1000), (4000, 2001, 2031)):
        x = np.random.default_rng(n).normal(size=n)
        x[at:end] += 10
        assert [s[:2] for s in copynumber.circular_segments(x)] == [c for c in ((0, at), (at, end), (end, n)) if c[0] < c[1]]
    with pytest.raises(ValueError):
        copynumber.circular_segments(x, permutations=49)


def test_smoothing_draws_in_single_outliers():
    import numpy as np

    from helixtab.operators import copynumber

    x = np.random.default_rng(1).normal(size=200)
    y = x.copy()
    y[50], y[120] = 40, -40
    out = copynumber.smoothed(y)
    assert abs(out[50]) < 5 and abs(out[120]) < 5
    keep = np.delete(np.arange(200), [50, 120])
    assert np.allclose(out[keep], x[keep])
