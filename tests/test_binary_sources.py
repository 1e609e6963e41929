"""Alignments and variants as data sources: whole files, stretches of every size, regions through indexes."""

import gzip
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from helixtab.sources import bam, bgzf, genomic, lines, variants

REFERENCES = [["chr1", 3_000_000], ["chr2", 3_000_000], ["chr3", 3_000_000]]
READS = "read_name string, flag int, chrom string, pos0 long, mapq int, cigar string, mate_chrom string, mate_pos0 long, insert_size int, query string, quals string, tags map<string,string>"
NAMES = [c.split()[0] for c in re.split(r", (?=\w+ )", READS)]


def reads(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        size, chrom = r.choice((10, 33, 100)), r.choice(("chr1", "chr2", "chr3", "*"))
        cigar = f"{size}M" if r.random() < 0.7 else f"4S{size - 4}M{r.choice((1, 3000, 200000))}N7M2I1D3M"
        letters = sum(int(a) for a, o in re.findall(r"(\d+)([MISX=])", cigar))
        query = "".join(r.choice("ACGTN") for _ in range(letters))
        placed = chrom != "*"
        tags = {"NM": str(r.randrange(5)), "RG": "g%d" % r.randrange(3), "XX": r.choice(("a b", "007", ""))}
        out.append((f"r{i}", r.randrange(4096), chrom, r.randrange(2_000_000) if placed else -1, r.randrange(61), cigar if placed else "*", r.choice(("=", "*")) if placed else "*", r.randrange(1000), r.randrange(-500, 500), query if i % 50 else "*", "".join(chr(33 + r.randrange(60)) for _ in query) if i % 7 and i % 50 else "*", tags))
    return out


def rows(df):
    return sorted((tuple(tuple(sorted(r[n].items())) if n == "tags" else r[n] for n in NAMES) for r in df.collect()), key=repr)


def expected(table):
    return sorted(((*x[:-1], tuple(sorted(x[-1].items()))) for x in table), key=repr)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    bam.register(spark)
    variants.register(spark)
    folder, table = str(tmp_path_factory.mktemp("bam")), reads(6000)
    place = F.when(F.col("chrom") == "*", "~").otherwise(F.col("chrom"))
    df = spark.createDataFrame(table, READS).repartitionByRange(2, place, "pos0").sortWithinPartitions(place, "pos0")
    df.write.format("bam").option("references", json.dumps(REFERENCES)).mode("append").save(folder + "/x")
    return folder + "/x", table


@pytest.mark.parametrize("split", [1 << 30, 60_000, 9_000])
def test_whole_file_in_stretches(spark, written, split):
    path, table = written
    got = spark.read.format("bam").option("split", split).load(path)
    assert got.rdd.getNumPartitions() >= (1 << 17) // split
    assert rows(got) == expected(table)


def test_equal_to_text(spark, written, tmp_path):
    path, table = written
    kind = lambda v: "i" if re.fullmatch(r"-?\d+", v) and str(int(v)) == v else "Z"
    text = "@HD\tVN:1.6\n" + "".join("\t".join(map(str, [x[0], x[1], x[2], x[3] + 1, x[4], x[5], x[6], x[7] + 1, *x[8:11], *(f"{k}:{kind(v)}:{v}" for k, v in x[11].items())])) + "\n" for x in table)
    (tmp_path / "s.sam").write_text(text)
    by_text = genomic.sam(spark, str(tmp_path / "s.sam"))
    assert rows(spark.read.format("bam").load(path)) == rows(by_text)
    for split in (1 << 30, 30_000):
        source = spark.read.format("sam").option("split", split).load(str(tmp_path / "s.sam"))
        assert rows(source) == rows(by_text) and {r.sample for r in source.select("sample").distinct().collect()} == {"s"}
    some = spark.read.format("sam").schema("chrom string, pos0 long").load(str(tmp_path / "s.sam")).where("chrom = 'chr2' and pos0 >= 500000")
    assert some.count() == sum(x[2] == "chr2" and x[3] >= 500_000 for x in table)


def test_region_reads_few_blocks(spark, written):
    path, _ = written
    whole = spark.read.format("bam").schema("read_name string, chrom string, pos0 long, end0 long, offset long").load(path)
    blocks = lambda reader: {(p.path, o.as_py() >> 16) for p in reader.partitions() for b in reader.read(p) for o in b["offset"]}
    kept = whole.select("*", (F.col("pos0") + 0).alias("p"), (F.col("end0") + 0).alias("e")).collect()
    for chrom, low, high in (("chr2", 400_000, 420_000), ("chr1", 0, 10), ("chr3", 1_999_000, 3_000_000), ("chr9", 0, 5)):
        part = whole.where((F.col("chrom") == chrom) & (F.col("pos0") < high) & (F.col("end0") > low))
        assert sorted(r.read_name for r in part.collect()) == sorted(r.read_name for r in kept if r.chrom == chrom and r.p < high and r.e > low)
    reader = bam.Alignments(whole.schema, {"path": path})
    every = blocks(reader)
    for f in (variants_filter("EqualTo", "chrom", "chr2"), variants_filter("LessThan", "pos0", 420_000), variants_filter("GreaterThan", "end0", 400_000)):
        list(reader.pushFilters([f]))
    assert blocks(reader) < every and 0 < len(blocks(reader)) <= 4 and len(every) > 12


def variants_filter(kind, column, value):
    from pyspark.sql import datasource

    return getattr(datasource, kind)((column,), value)


def test_overwrite_unordered_and_empty(spark, written, tmp_path):
    table = reads(50, 3)
    path = str(tmp_path / "y")
    for chosen in (table[:20], table):
        spark.createDataFrame(chosen, READS).coalesce(1).write.format("bam").option("references", json.dumps(REFERENCES)).mode("overwrite").save(path)
    assert rows(spark.read.format("bam").load(path)) == expected(table)
    assert not list((tmp_path / "y").glob("*.bai"))  # rows weren't in order
    assert spark.read.format("bam").load(path).where("chrom = 'chr1'").count() == sum(x[2] == "chr1" for x in table)
    spark.createDataFrame([], READS).coalesce(1).write.format("bam").option("references", json.dumps(REFERENCES)).mode("overwrite").save(path)
    assert spark.read.format("bam").load(path).count() == 0


@pytest.mark.parametrize("kind", ["plain", "gzip", "blocks"])
def test_every_line_is_read_once(tmp_path, kind):
    r = random.Random(5)
    for n in (0, 1, 40):
        text = "".join("x" * r.randrange(30) + f"{i}\n" for i in range(n)).encode()
        text = text[:-1] if n == 40 else text
        path = str(tmp_path / f"{kind}{n}.txt{'' if kind == 'plain' else '.gz'}")
        if kind == "plain":
            open(path, "wb").write(text)
        elif kind == "gzip":
            open(path, "wb").write(gzip.compress(text[: len(text) // 2]) + gzip.compress(text[len(text) // 2 :]))
        else:
            cuts = sorted([0, len(text), *(r.randrange(len(text) + 1) for _ in range(25))])
            open(path, "wb").write(b"".join(bgzf.block(text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a) + bgzf.END)
        size = (tmp_path / path).stat().st_size
        for split in (1, 7, 50, 1000):
            got = b"".join(b"".join(lines.read(p)) for p in lines.planned(path, size, split))
            assert got.splitlines() == text.splitlines(), (kind, n, split)


HEADER = ['##INFO=<ID=DP,Number=1,Type=Integer,Description="d">', '##INFO=<ID=AF,Number=A,Type=Float,Description="f">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="b">', '##INFO=<ID=GENE,Number=1,Type=String,Description="g">']


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    r = random.Random(2)
    table = []
    for _ in range(3000):
        table.append((f"chr{r.randrange(1, 4)}", r.randrange(1, 2_000_000), r.choice((None, "rs1")), r.choice("ACGT"), "T,G", "50", "PASS", r.choice((None, 30)), r.choice((None, [0.5, 0.25])), r.random() < 0.5, r.choice((None, "TP53")), "GT:AD", "0/1:3,4"))
    kind = "CHROM string, POS long, ID string, REF string, ALT string, QUAL string, FILTER string, INFO_DP long, INFO_AF array<double>, INFO_DB boolean, INFO_GENE string, FORMAT string, S1 string"
    variants.register(spark)
    path = str(tmp_path_factory.mktemp("vcf")) + "/v"
    df = spark.createDataFrame(table, kind).repartitionByRange(2, "CHROM", "POS").sortWithinPartitions("CHROM", "POS")
    df.write.format("vcf").option("header", json.dumps(HEADER)).mode("append").save(path)
    return path, table


@pytest.mark.parametrize("split", [1 << 30, 4000])
def test_variants_with_types_of_the_header(spark, calls, split):
    path, table = calls
    df = spark.read.format("vcf").option("split", split).load(path)
    assert [f"{n} {t}" for n, t in df.dtypes if n.startswith("INFO_")] == ["INFO_DP bigint", "INFO_AF array<double>", "INFO_DB boolean", "INFO_GENE string"]
    got = sorted((tuple(r) for r in df.drop("INFO").collect()), key=repr)
    assert got == sorted(((c, p, i or ".", *rest) for c, p, i, *rest in table), key=repr)


def test_variants_of_a_region(spark, calls):
    path, table = calls
    df = spark.read.format("vcf").schema("CHROM string, POS long, INFO_DP long").load(path).where("CHROM = 'chr2' and POS between 900001 and 1000000")
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(((x[0], x[1], x[7]) for x in table if x[0] == "chr2" and 900_001 <= x[1] <= 1_000_000), key=repr)
    reader = variants.VcfReader(df.schema, {"path": path}, variants.Region("CHROM", "POS", origin=1))
    every = sum(p.last - p.first for p in reader.partitions())
    assert {p.kind for p in reader.partitions()} == {"blocks"}
    for f in (variants_filter("EqualTo", "CHROM", "chr2"), variants_filter("GreaterThanOrEqual", "POS", 900_001), variants_filter("LessThanOrEqual", "POS", 1_000_000)):
        list(reader.pushFilters([f]))
    assert {p.kind for p in reader.partitions()} == {"records"}
    assert sum((p.last >> 16) - (p.first >> 16) for p in reader.partitions()) < every


def test_plain_text_equals_the_wide_table(spark, tmp_path):
    path = tmp_path / "a.vcf"
    path.write_text("##fileformat=VCFv4.2\n" + "\n".join(HEADER) + "\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n" + "".join(f"chr{i % 3}\t{i}\t.\tA\tC\t.\tPASS\tDP={i};AF=0.5,.;DB;X=\"q\t" + "GT\t0/1\n" for i in range(1, 400)))
    variants.register(spark)
    wide = genomic.vcf(spark, str(path))
    for split in (1 << 30, 100):
        got = spark.read.format("vcf").option("split", split).load(str(path))
        assert sorted(map(tuple, got.select(*(F.col(c).cast("string") for c in wide.columns)).collect())) == sorted(map(tuple, wide.collect()))
        assert got.where("INFO_DP > 390 and INFO_DB and INFO_AF[0] = 0.5 and INFO_AF[1] is null").count() == 9
