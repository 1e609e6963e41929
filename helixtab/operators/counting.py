"""Counts of alleles at variants from alignments.

Alignments: sample, read_name, flag, chrom, pos0 (0-based), mapq, cigar, query, quals (text, Phred + 33).
Variants: variant_id, chrom, pos0, ref, alt (in the form that keeps a common first base).
Everything but the walk along a cigar is joins and grouped sums; that walk is a column expression, once a read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators.filters import usable_reads
from helixtab.operators.intervals import point_join
from helixtab.operators.scans import kept

#: Least base quality; Phred offset; usual span of an alignment, for the join's bins.
BASE_QUALITY, PHRED, SPAN = 20, 33, 128


def reference_length(cigar: Column) -> Column:
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(ops, F.lit(0), lambda a, x: a + x.cast("int"))


def observations(alignments: DataFrame, variants: DataFrame, mapq: int = 20, base_quality: int = BASE_QUALITY, **switches: bool) -> DataFrame:
    """A row for each read that covers a variant's position: what it shows (ref, alt, other or U for a gap), sample, read_name, flag and shared.

    Cigars are walked once a read, to blocks with what follows them, so a pair of a block and a site is two letters and no walk. shared: whether
    another read of the fragment may cover the same place.
    """
    reads = usable_reads(alignments, mapq, **switches)
    own = ["sample", "read_name", "flag", "chrom"]
    reads = _marked_shared(reads.select(*own, "pos0", "cigar", "query", "quals"))
    blocks = reads.withColumn("_b", F.explode(reference_blocks(X.cigar_operations(F.col("cigar")), F.col("pos0"), F.col("query"))))
    part = lambda c: F.when(F.col("_b.op").isin("M", "=", "X"), F.col(c).substr(F.col("_b.offset") + 1, F.col("_b.n")))
    name = F.when(F.col("shared"), F.col("read_name")).alias("read_name")  # of others it isn't asked
    blocks = blocks.select("sample", name, "flag", "chrom", "shared", F.col("_b.start").alias("b_start"), F.col("_b.end").alias("b_end"), F.col("_b.op").alias("op"), F.col("_b.next").alias("next"), part("query").alias("query"), part("quals").alias("quals"))
    sites = variants.select("variant_id", F.col("chrom").alias("v_chrom"), "pos0", "ref", "alt")
    # the hint keeps few sites from being sent to reads that lie in few tasks; reads are dealt out by bins
    met = point_join(sites.hint("shuffle_hash"), blocks, "pos0", ("b_start", "b_end"), (("v_chrom", "chrom"),), SPAN)

    at = (F.col("pos0") - F.col("b_start") + 1).cast("int")
    on_base, gap = F.col("op").isin("M", "=", "X"), F.col("op") == "D"
    base, quality = F.upper(F.col("query").substr(at, F.lit(1))), F.ascii(F.col("quals").substr(at, F.lit(1))) - PHRED
    snp = F.when(gap, "U").when(on_base & (quality < base_quality), None).when(on_base & (base == F.upper(F.substring("ref", 1, 1))), "ref").when(on_base & (base == F.upper(F.substring("alt", 1, 1))), "alt").otherwise("other")
    # a read that ends at the position doesn't count; the same operation of the same length (and bases) right after it is the alternative
    last, after, n_ref, n_alt = F.col("pos0") == F.col("b_end"), F.col("next"), F.length("ref"), F.length("alt")
    same = F.when(n_alt > n_ref, (after["op"] == "I") & (after["n"] == n_alt - n_ref) & (after["bases"] == F.upper(F.col("alt").substr(n_ref + 1, n_alt)))).otherwise((after["op"] == "D") & (after["n"] == n_ref - n_alt))
    indel = F.when(last & ~after["goes_on"], None).when(last & F.coalesce(same, F.lit(False)), "alt").when((~last | after["op"].isNull()) & on_base, "ref").otherwise("other")
    shown = F.when(n_ref != n_alt, indel).otherwise(snp)
    return met.withColumn("shows", shown).where("shows is not null").select("variant_id", "sample", "read_name", "flag", "shared", "shows")


def reference_blocks(ops: Column, start: Column, query: Column) -> Column:
    """array of struct(start, end, offset, n, op, next): the stretches of reference that a read's operations take up, offset in the read.

    next: struct(goes_on, op, n, bases): whether the alignment goes on after the block, with the insertion or deletion that comes first there.
    """
    nothing = F.struct(F.lit(False).alias("goes_on"), F.lit(None).cast("string").alias("op"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("bases"))
    block = lambda start, offset, n, op: F.struct(start.alias("start"), (start + n - 1).alias("end"), offset.alias("offset"), n.alias("n"), op.alias("op"), nothing.alias("next"))
    long, none = start.cast("long"), F.lit(None)
    kind = "struct<start: bigint, end: bigint, offset: int, n: int, op: string, next: struct<goes_on: boolean, op: string, n: int, bases: string>>"
    zero = F.struct(long.alias("ref"), F.lit(0).alias("read"), none.cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done"))

    def step(a, o):
        on_ref, on_read, gap = o["op"].isin("M", "=", "X", "D", "N"), o["op"].isin("M", "=", "X", "I", "S"), o["op"].isin("I", "D")
        was = a["open"]
        first = gap & was["next"]["op"].isNull()
        here = F.struct(
            (was["next"]["goes_on"] | on_ref | gap).alias("goes_on"), F.when(first, o["op"]).otherwise(was["next"]["op"]).alias("op"), F.when(first, o["n"]).otherwise(was["next"]["n"]).alias("n"),
            F.when(first, F.when(o["op"] == "I", F.upper(query.substr(a["read"] + 1, o["n"])))).otherwise(was["next"]["bases"]).alias("bases"),
        )
        known = F.when(was.isNotNull(), F.struct(*(was[c].alias(c) for c in ("start", "end", "offset", "n", "op")), here.alias("next")))
        new = on_ref & (o["n"] > 0)
        return F.struct(
            (a["ref"] + F.when(on_ref, o["n"]).otherwise(0)).alias("ref"), (a["read"] + F.when(on_read, o["n"]).otherwise(0)).alias("read"),
            F.when(new, block(a["ref"], a["read"], o["n"], o["op"])).otherwise(known).cast(kind).alias("open"), F.when(new & was.isNotNull(), F.concat(a["done"], F.array(known.cast(kind)))).otherwise(a["done"]).alias("done"),
        )

    walked = F.aggregate(ops, zero, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))
    only = F.get(ops, F.lit(0))
    return F.when((F.size(ops) == 1) & only["op"].isin("M", "=", "X") & (only["n"] > 0), F.array(block(long, F.lit(0), only["n"], only["op"]).cast(kind))).otherwise(walked)


def _marked_shared(reads: DataFrame) -> DataFrame:
    """reads with shared: false where no other read of the sample, name and chromosome can cover the same place.

    Fragments are told apart by a hash; where two have the same, their reads count as shared, which only makes them go the longer way. The list of hashes of
    fragments that have such reads is written (this runs a job), so that Spark knows its size.
    """
    keyed = reads.withColumn("_fragment", F.xxhash64("sample", "read_name", "chrom"))
    end = F.col("pos0") + reference_length(F.col("cigar"))
    several = keyed.select("_fragment", F.col("pos0").alias("_s"), end.alias("_e")).groupBy("_fragment").agg(F.count("*").alias("n"), F.sum(F.col("_e") - F.col("_s")).alias("covered"), (F.max("_e") - F.min("_s")).alias("spanned"))
    shared = kept(several.where("n > 2 or n = 2 and not coalesce(covered <= spanned, false)").select("_fragment", F.lit(True).alias("shared")), "fragments")
    return keyed.join(shared, "_fragment", "left").withColumn("shared", F.coalesce("shared", F.lit(False))).drop("_fragment")


def base_counts(alignments: DataFrame, variants: DataFrame, samples: list[str] | None = None, **options) -> DataFrame:
    """(variant_id, sample, dp, rd, ad, dpp, rdp, adp, dpf, rdf, adf, vf).

    p: on the forward strand. f: by fragment; a fragment whose two reads differ counts half for
    each, and one aligned more than once on a strand only in dpf. Equal variants are counted once.
    """
    distinct = variants.groupBy("chrom", "pos0", "ref", "alt").agg(F.min("variant_id").alias("variant_id"))
    seen = observations(alignments, distinct, **options)
    forward = F.col("flag").bitwiseAND(16) == 0
    count = lambda c: F.count_if(c)
    by = ["variant_id", "sample"]
    ref, alt = F.col("shows") == "ref", F.col("shows") == "alt"
    each = [count(c).alias(n) for n, c in {"dp": F.lit(True), "rd": ref, "ad": alt, "dpp": forward, "rdp": ref & forward, "adp": alt & forward}.items()]
    sums = lambda: [F.sum(c).alias(c) for c in ("dp", "rd", "ad", "dpp", "rdp", "adp")]
    # reads that are alone in their fragment at a site are summed where they meet it; only the others are grouped by name
    alone = seen.where("not shared").groupBy(*by).agg(*each).select("*", F.col("dp").alias("dpf"), F.col("rd").cast("double").alias("rdf"), F.col("ad").cast("double").alias("adf"))
    per_fragment = seen.where("shared").groupBy(*by, "read_name").agg(*each, (F.greatest(count(forward), count(~forward)) > 1).alias("many"))
    half = F.when(F.col("many"), 0.0).when((F.col("rd") > 0) & (F.col("ad") > 0), 0.5)
    together = per_fragment.groupBy(*by).agg(
        *sums(), F.count("*").alias("dpf"),
        F.sum(F.coalesce(half, F.when(F.col("rd") > 0, 1.0).otherwise(0.0))).alias("rdf"), F.sum(F.coalesce(half, F.when(F.col("ad") > 0, 1.0).otherwise(0.0))).alias("adf"),
    )
    counts = alone.unionByName(together).groupBy(*by).agg(*sums(), *(F.sum(c).alias(c) for c in ("dpf", "rdf", "adf")))
    counts = counts.withColumn("vf", F.when(F.col("dp") > 0, F.col("ad") / F.col("dp")).otherwise(0.0))
    same = variants.select(F.col("variant_id").alias("id"), "chrom", "pos0", "ref", "alt").join(distinct, ["chrom", "pos0", "ref", "alt"])
    every = same if samples is None else same.withColumn("sample", F.explode(F.array(*map(F.lit, samples))))
    joined = every.join(counts, by if samples is not None else ["variant_id"], "inner" if samples is None else "left")
    numbers = [c for c in counts.columns if c not in by]
    return joined.select(F.col("id").alias("variant_id"), "sample", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers])


def pileup_counts(pileup: DataFrame, mutations: DataFrame) -> DataFrame:
    """(chrom, pos, ref, alt, total, ref_forward, ref_reverse, alt_forward, alt_reverse, vf) from a table of mpileup lines.

    pileup: chrom, pos, ref_base, depth, bases. An insertion's or deletion's reads also show the
    reference base before it, which is taken off.
    """
    keyed = mutations.select("chrom", "pos", "ref", "alt").distinct()
    lines = pileup.select("chrom", "pos", "depth", X.pileup_bases(F.col("bases"), F.col("ref_base")).alias("alleles"))
    allele = F.when(F.length("alt") > F.length("ref"), F.concat(F.lit("+"), F.expr("substring(alt, length(ref) + 1)"))).when(F.length("ref") > F.length("alt"), F.concat(F.lit("-"), F.expr("substring(ref, length(alt) + 1)"))).otherwise(F.col("alt"))
    met = keyed.withColumn("allele", F.upper(allele)).join(lines, ["chrom", "pos"], "left")
    n = lambda a, s: F.size(F.filter("alleles", lambda x: (x["allele"] == a) & (x["strand"] == s)))
    base = F.upper(F.substring("ref", 1, 1))
    indel = F.length("ref") != F.length("alt")
    out = met.select("chrom", "pos", "ref", "alt", F.coalesce("depth", F.lit(0)).alias("total"), *[F.greatest(F.lit(0), F.coalesce(n(a, s), F.lit(0))).alias(name) for name, a, s in (("_rf", base, "+"), ("_rr", base, "-"), ("alt_forward", F.col("allele"), "+"), ("alt_reverse", F.col("allele"), "-"))], indel.alias("_indel"))
    take = lambda r, a: F.when(F.col("_indel"), F.greatest(F.lit(0), F.col(r) - F.col(a))).otherwise(F.col(r))
    out = out.withColumn("ref_forward", take("_rf", "alt_forward")).withColumn("ref_reverse", take("_rr", "alt_reverse")).drop("_rf", "_rr", "_indel")
    return out.withColumn("vf", F.format_string("%.5f", F.when(F.col("total") > 0, (F.col("alt_forward") + F.col("alt_reverse")) / F.col("total")).otherwise(0.0)))


def count_text(c: str = "") -> Column:
    """'DP=..;RD=..;AD=..;VF=..' of the columns dp, rd, ad and vf."""
    return F.concat(F.lit("DP="), F.col("dp").cast("string"), F.lit(";RD="), F.col("rd").cast("string"), F.lit(";AD="), F.col("ad").cast("string"), F.lit(";VF="), X.four_digits(F.col("vf")))


def parsed_counts(c: Column) -> Column:
    return F.str_to_map(c, F.lit(";"), F.lit("="))
