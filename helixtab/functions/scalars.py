"""Column functions over alleles, genotypes, chromosomes, numbers and labels."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

# ---------------------------------------------------------------- numbers and text


def as_int(c: Column) -> Column:
    """A number, null where the text isn't one; '' and '.' and 'NA' are missing."""
    return c.try_cast("long")


def as_double(c: Column) -> Column:
    return c.try_cast("double")


def leading_int(c: Column) -> Column:
    """The number that a text starts with, 0 if none (as C's atoi)."""
    return F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("long"), F.lit(0))


def missing(c: Column, *marks: str) -> Column:
    """null for the empty text and the marks given."""
    return F.when(~c.isin("", *marks), c)


def local_number(c: Column) -> Column:
    """'1,234' as a number."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def four_digits(c: Column) -> Column:
    """A double with four significant digits, without trailing zeros ('%.4g' as C prints it).

    Where the shortest decimal form is a tie, the last digit is rounded to even.
    """
    scale = F.pow(F.lit(10.0), F.lit(3) - F.floor(F.log10(F.abs(c))))
    rounded = F.bround(c * scale, 0) / scale
    text = F.format_string("%.12f", rounded)
    trimmed = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    large = F.regexp_replace(F.regexp_replace(F.format_string("%.3e", rounded), r"(\.\d*?)0+e", "$1e"), r"\.e", "e")
    return F.when(c == 0, "0").when((F.abs(c) >= 1e4) | (F.abs(c) < 1e-4), large).otherwise(trimmed)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def two_decimals(c: Column) -> Column:
    """'%.2f'."""
    return F.format_string("%.2f", F.bround(c, 2))


def clean_name(c: Column) -> Column:
    """A column name: other than letters and digits become one underscore, lower case."""
    return F.lower(F.regexp_replace(c, "[^0-9a-zA-Z]+", "_"))


def metric_value(c: Column) -> Column:
    """A metric's number: '?' is null, '' is 0."""
    return F.when(c == "?", None).when(c == "", 0.0).otherwise(c.try_cast("double"))


def fold_change(log_ratio: Column) -> Column:
    """2**x above zero, otherwise -2**-x."""
    return F.when(log_ratio > 0, F.pow(F.lit(2.0), log_ratio)).otherwise(-F.pow(F.lit(2.0), -log_ratio))


@F.pandas_udf(DoubleType())
def normal_p_value(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a standard normal score; Spark has no error function."""
    return z.map(lambda x: None if pd.isna(x) else math.erfc(abs(x) / math.sqrt(2)))


def midpoint(start: Column, end: Column) -> Column:
    """Middle of a closed interval, up where it is a half."""
    return start + F.ceil((end - start) / 2)


# ---------------------------------------------------------------- chromosomes

# Complements of the IUPAC letters.
_BASES, _OTHERS = "ACGTUacgtuNn", "TGCAAtgcaaNn"


def complement(seq: Column) -> Column:
    return F.translate(seq, _BASES, _OTHERS)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def without_chr(c: Column) -> Column:
    return F.regexp_replace(c, "^chr", "")


def with_chr(c: Column) -> Column:
    return F.when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c))


def sex_to_number(c: Column) -> Column:
    """X and Y as 23 and 24."""
    return F.when(c == "X", "23").when(c == "Y", "24").otherwise(c)


def number_to_sex(c: Column) -> Column:
    return F.when(c == "23", "X").when(c == "24", "Y").otherwise(c)


def karyotype_key(chrom: Column) -> Column:
    """Sorts chromosomes: numbers first, by value, then the others by name."""
    plain = without_chr(chrom)
    number = plain.try_cast("int")
    return F.struct(number.isNull().alias("named"), F.coalesce(number, F.lit(0)).alias("number"), plain.alias("name"))


def same_chromosome(a: Column, b: Column) -> Column:
    """Of cytogenetic positions such as 7q31.2."""
    arm = r"^(?:chr)?(\d+|X|Y|MT|M)"
    return (F.regexp_extract(a, arm, 1) == F.regexp_extract(b, arm, 1)) & (F.regexp_extract(a, arm, 1) != "")


def same_major_band(a: Column, b: Column) -> Column:
    """Whether two cytogenetic positions are on one chromosome arm, at most one major band apart.

    A terminal or centromeric position, or one without an arm, agrees with any band of its
    chromosome (and arm, if it has one).
    """
    pattern = r"^(?:chr)?(\d+|X|Y)([pq])?(ter|cen|\d+)?"
    part = lambda c, i: F.regexp_extract(c, pattern, i)
    band = lambda c: part(c, 3).try_cast("int")
    arms = (part(a, 2) == "") | (part(b, 2) == "") | (part(a, 2) == part(b, 2))
    near = band(a).isNull() | band(b).isNull() | (F.abs(band(a) - band(b)) <= 1)
    return same_chromosome(a, b) & arms & near


def overlaps_strictly(a_start: Column, a_end: Column, b_start: Column, b_end: Column, tolerance: int = 0) -> Column:
    """Overlap by strict inequality, each side widened by tolerance."""
    return (a_start < b_end + tolerance) & (b_start < a_end + tolerance)


# ---------------------------------------------------------------- alleles and genotypes


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP, DNP, TNP, ONP, INS or DEL of alleles in which an empty one is '-'."""
    return F.when((ref != "-") & (alt != "-"), _by_length(ref)).when(alt == "-", "DEL").otherwise("INS")


def variant_type_unstripped(ref: Column, alt: Column) -> Column:
    """The same of alleles that keep their common first base."""
    return F.when((F.length(ref) == F.length(alt)) & (ref != ""), _by_length(ref)).when(F.length(ref) > F.length(alt), "DEL").otherwise("INS")


def _by_length(ref: Column) -> Column:
    return F.when(F.length(ref) == 1, "SNP").when(F.length(ref) == 2, "DNP").when(F.length(ref) == 3, "TNP").otherwise("ONP")


def genotype(gt: Column) -> Column:
    """A lone '0' is '0/0'."""
    return F.when(gt == "0", "0/0").otherwise(gt)


def chosen_allele(ref: Column, alts: Column, gt: Column) -> Column:
    """The alternative allele (of an array) that a genotype names second; the reference where it names none."""
    index = F.get(F.split(gt, "/"), F.lit(1)).try_cast("int")
    return F.when(F.size(alts) <= 1, F.get(alts, F.lit(0))).when(gt.isin("0/0", "./."), ref).otherwise(F.get(alts, index - 1))


def biallelic_genotype(gt: Column, n_alts: Column) -> Column:
    """A multi-allelic genotype by its chosen allele: 1/1 if it has no reference allele or one allele twice, otherwise 0/1."""
    a, b = F.get(F.split(gt, "/"), F.lit(0)), F.get(F.split(gt, "/"), F.lit(1))
    return F.when((n_alts <= 1) | gt.isin("0/0", "./."), gt).when((a == b) | (a != "0"), "1/1").otherwise("0/1")


def stripped_event(pos: Column, ref: Column, alt: Column) -> Column:
    """struct(pos, ref, alt) in which the common start of an insertion or deletion is left out and an empty allele is '-'."""
    n_ref, n_alt = F.length(ref), F.length(alt)
    return (
        F.when(n_ref > n_alt, F.struct((pos + n_alt).alias("pos"), ref.substr(n_alt + 1, n_ref).alias("ref"), F.lit("-").alias("alt")))
        .when(n_alt > n_ref, F.struct((pos + n_ref - 1).alias("pos"), F.lit("-").alias("ref"), alt.substr(n_ref + 1, n_alt).alias("alt")))
        .otherwise(F.struct(pos.alias("pos"), ref.alias("ref"), alt.alias("alt")))
    )


def padded_event(pos: Column, ref: Column, alt: Column) -> Column:
    """struct(start, end, ref, alt) by the rule that strips one base."""
    n_ref, n_alt = F.length(ref), F.length(alt)
    tail = lambda c: c.substr(F.lit(2), F.length(c))
    kinds = lambda s, e, r, a: F.struct(s.cast("long").alias("start"), e.cast("long").alias("end"), r.alias("ref"), a.alias("alt"))
    return (
        F.when(n_ref == n_alt, kinds(pos, pos, ref, alt))
        .when(n_ref > n_alt, kinds(pos + 1, pos + n_ref - 1, tail(ref), F.when(n_alt == 1, F.lit("-")).otherwise(tail(alt))))
        .otherwise(kinds(pos, pos + 1, F.lit("-"), tail(alt)))
    )


def tabled_event(pos: Column, ref: Column, alt: Column, gt: Column) -> Column:
    """struct(start, end, ref, allele1, allele2): an event as a mutation table has it, one shared base left out of insertions and deletions and '-' for nothing.

    The end is that of the reference allele as it was called; an insertion after one base ends on the next. allele1 is the reference unless the genotype's first allele isn't.
    """
    rest = lambda c: F.when(F.length(c) > 1, c.substr(F.lit(2), F.length(c))).otherwise("-")
    deletion, insertion = F.length(ref) > F.length(alt), F.length(ref) < F.length(alt)
    own, other = (F.when(deletion | insertion, rest(c)).otherwise(c) for c in (ref, alt))
    end = pos + F.length(ref) - 1 + F.when(insertion & (F.length(ref) == 1), 1).otherwise(0)
    first = F.when(F.get(F.split(gt, "/"), F.lit(0)) == "0", own).otherwise(other)
    start = pos + F.when(deletion, 1).otherwise(0)
    return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), own.alias("ref"), first.alias("allele1"), other.alias("allele2"))


def anchored_event(pos: Column, ref: Column, alt: Column, base_before: Column) -> Column:
    """struct(pos, ref, alt) with the base before put back where an allele is '-'; pos as in a mutation table."""
    insertion, deletion = ref == "-", alt == "-"
    return F.struct(
        F.when(deletion, pos - 1).otherwise(pos).alias("pos"),
        F.when(insertion, base_before).when(deletion, F.concat(base_before, ref)).otherwise(ref).alias("ref"),
        F.when(insertion, F.concat(base_before, alt)).when(deletion, base_before).otherwise(alt).alias("alt"),
    )


def changed_allele(ref: Column, allele1: Column, allele2: Column) -> Column:
    """The first of two alleles that isn't the reference; null if neither."""
    return F.when(ref != allele1, allele1).when(ref != allele2, allele2)


def allele_depths(ad: Column, rd: Column, dp4: Column) -> Column:
    """Depths, reference first: [rd, ad], the list ad, or pairs of dp4 summed; all given as text."""
    numbers = lambda c: F.transform(F.split(c, ","), lambda x: x.try_cast("int"))
    four = numbers(dp4)
    return (
        F.when(ad.isNotNull() & rd.isNotNull(), F.array(rd.try_cast("int"), ad.try_cast("int")))
        .when(ad.isNotNull(), numbers(ad))
        .when(dp4.isNotNull(), F.array(F.get(four, F.lit(0)) + F.get(four, F.lit(1)), F.get(four, F.lit(2)) + F.get(four, F.lit(3))))
    )


def alternative_depth(depths: Column, gt: Column) -> Column:
    """Depth of the allele that the genotype's last letter names; of all alternatives if that is 0."""
    last = F.substring(gt, -1, 1)
    every = F.aggregate(F.slice(depths, F.lit(2), F.greatest(F.size(depths) - 1, F.lit(0))), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(last == "0", every).otherwise(F.get(depths, last.try_cast("int")))


def likelihoods(values: Column, gt: Column) -> Column:
    """Of a ';'-joined list of more than five: those of the genotypes 0/0, 0/k and k/k, k named second by gt."""
    parts = F.split(values, ";")
    k = F.get(F.split(gt, "/"), F.lit(1)).try_cast("int")
    base = (k * (k + 1) / 2).cast("int")
    return F.when(F.size(parts) > 5, F.concat_ws(";", F.get(parts, F.lit(0)), F.get(parts, base), F.get(parts, base + k))).otherwise(values)


def two_allele_genotype(depth_a: Column, depth_b: Column, a: Column, b: Column, least: float = 0.10, none: str = "--") -> Column:
    """Two letters: the major one twice if the minor fraction is under least; none without coverage."""
    depth = depth_a + depth_b
    minor = F.least(depth_a, depth_b) / depth
    major = F.when(depth_a >= depth_b, a).otherwise(b)
    return F.when(depth == 0, F.lit(none)).when(minor < least, F.concat(major, major)).otherwise(F.concat(a, b))


def event_tag(chrom: Column, start: Column, end: Column, *more: Column) -> Column:
    """'chrom:start-end', then ':' and each of more."""
    return F.concat_ws(":", chrom, F.concat_ws("-", start.cast("string"), end.cast("string")), *more)


def coding_change(cds: Column) -> Column:
    """struct(ref, alt) of a coding change such as c.194A>G; '?' for the side that an insertion or deletion lacks."""
    change = F.regexp_replace(cds, r"c\.\d+((_\d+)*((\+|-)\d+)*)*", "")
    two = lambda sep: F.split(change, sep)
    pair = lambda r, a: F.struct(r.alias("ref"), a.alias("alt"))
    return (
        F.when(F.size(two(">")) == 2, pair(F.get(two(">"), F.lit(0)), F.get(two(">"), F.lit(1))))
        .when(F.size(two("del")) == 2, pair(F.get(two("del"), F.lit(1)), F.lit("?")))
        .when(F.size(two("ins")) == 2, pair(F.lit("?"), F.get(two("ins"), F.lit(1))))
    )


def strands(connection: Column) -> Column:
    """struct(first, second) of 0 (3') and 1 (5') of a junction such as 3to5."""
    parts = F.split(connection, "to")
    side = lambda i: F.when(F.get(parts, F.lit(i)) == "3", 0).when(F.get(parts, F.lit(i)) == "5", 1)
    return F.struct(side(0).alias("first"), side(1).alias("second"))


def info_map(info: Column) -> Column:
    """'k=v;flag' as a map; a flag's value is ''."""
    parts = F.split(info, ";")
    key = lambda x: F.split_part(x, F.lit("="), F.lit(1))
    last = F.filter(parts, lambda x, i: ~F.exists(F.slice(parts, i + 2, F.greatest(F.size(parts) - i - 1, F.lit(0))), lambda o: key(o) == key(x)))
    return F.map_from_arrays(F.transform(last, key), F.transform(last, lambda x: F.regexp_replace(x, "^[^=]*=?", "")))


def sample_map(format_: Column, sample: Column) -> Column:
    """Values of a sample by the keys of its format; keys without a value are null."""
    keys, values = F.split(format_, ":"), F.split(sample, ":")
    return F.map_from_entries(F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.get(values, i).alias("v"))))


def precision(info: Column) -> Column:
    return F.when(F.map_contains_key(info, "PRECISE"), "PRECISE").otherwise("IMPRECISE")


def sex(c: Column) -> Column:
    """'Male' or 'Female' of the ways it is written; null for others."""
    low = F.lower(F.trim(c))
    return F.when(low.isin("m", "male"), "Male").when(low.isin("f", "female"), "Female")


def sample_of_path(path: Column, pattern: str = r"([^/]+)$", drop: tuple[str, ...] = ()) -> Column:
    """A sample's name from a path: the pattern's first group, without the endings given."""
    name = F.regexp_extract(path, pattern, 1)
    for end in drop:
        name = F.regexp_replace(name, end, "")
    return name


def gene_labels(labels: Column) -> Column:
    """array of struct(gene, transcript, exon, bounds) of 'gene:tx:exon:bounds,...'."""
    part = lambda x, i: F.get(F.split(x, ":"), F.lit(i))
    return F.transform(F.split(labels, ","), lambda x: F.struct(part(x, 0).alias("gene"), part(x, 1).alias("transcript"), part(x, 2).alias("exon"), part(x, 3).alias("bounds")))


def clamped(position: Column, by: int, length: Column) -> Column:
    """A 1-based position moved, kept within a chromosome."""
    return F.greatest(F.lit(1), F.least(position + by, length))


def cigar_operations(cigar: Column) -> Column:
    """array of struct(n, op): the operations of a text such as 5S90M2D5M."""
    return F.transform(
        F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)),
        lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("n"), F.substring(x, -1, 1).alias("op")),
    )


def read_offset(ops: Column, start: Column, position: Column) -> Column:
    """struct(offset, state): where a reference position lies in an alignment's read.

    ops: see cigar_operations(); start: first reference position aligned. state is 'base',
    'deletion' (offset of the base before) or null if not covered. One pass over the operations,
    none where a read is aligned by a single one, as most are.
    """
    first, inside = F.get(ops, F.lit(0)), position - start
    single = (F.size(ops) == 1) & first["op"].isin("M", "=", "X") & (inside >= 0) & (inside < first["n"])
    zero = F.struct(start.cast("long").alias("ref"), F.lit(0).alias("read"), F.lit(None).cast("int").alias("offset"), F.lit(None).cast("string").alias("state"))

    def step(acc, o):
        on_ref, on_read = o["op"].isin("M", "=", "X", "D", "N"), o["op"].isin("M", "=", "X", "I", "S")
        within = on_ref & (position >= acc["ref"]) & (position < acc["ref"] + o["n"]) & acc["state"].isNull()
        offset = F.when(within & on_read, (acc["read"] + position - acc["ref"]).cast("int")).when(within & (o["op"] == "D"), acc["read"] - 1).otherwise(acc["offset"])
        state = F.when(within & on_read, "base").when(within & (o["op"] == "D"), "deletion").otherwise(acc["state"])
        return F.struct(
            (acc["ref"] + F.when(on_ref, o["n"]).otherwise(0)).alias("ref"), (acc["read"] + F.when(on_read, o["n"]).otherwise(0)).alias("read"), offset.alias("offset"), state.alias("state")
        )

    walked = F.aggregate(ops, zero, step, lambda acc: F.struct(acc["offset"].alias("offset"), acc["state"].alias("state")))
    return F.when(single, F.struct(inside.cast("int").alias("offset"), F.lit("base").alias("state"))).otherwise(walked)


@F.pandas_udf(ArrayType(StructType().add("allele", StringType()).add("strand", StringType())))
def pileup_bases(bases: pd.Series, ref: pd.Series) -> pd.Series:
    """Alleles of an mpileup base string: ref's letter for . and ,; +SEQ and -SEQ for indels; '-' on the forward strand for a gap (*).

    Reading stops at a character that a base string can't have.
    """
    import re

    token = re.compile(r"\^.|\$|[+-](\d+)|[.,ACGTNacgtn*]")

    def alleles(text, own):
        out, at = [], 0
        while text and at < len(text):
            m = token.match(text, at)
            if m is None:
                break
            at = m.end()
            if m[1]:
                seq = text[at : at + int(m[1])]
                at += int(m[1])
                out.append({"allele": m[0][0] + seq.upper(), "strand": "+" if seq[:1].isupper() else "-"})
            elif m[0][0] not in "^$":
                c = m[0]
                out.append({"allele": own.upper() if c in ".," else "-" if c == "*" else c.upper(), "strand": "-" if c == "," or c.islower() else "+"})
        return out

    return pd.Series([alleles(t, r or "N") for t, r in zip(bases, ref, strict=True)])


# ---------------------------------------------------------------- records, dates, files


def identity_score(pairs: list[tuple[Column, Column]]) -> Column:
    """struct(same, different): in how many of several id systems two records agree and differ; missing ids count for neither."""
    known = [(a.isNotNull() & b.isNotNull() & (a != "") & (b != ""), a == b) for a, b in pairs]
    add = lambda cs: sum((F.coalesce(c, F.lit(False)).cast("int") for c in cs), F.lit(0))
    return F.struct(add(k & e for k, e in known).alias("same"), add(k & ~e for k, e in known).alias("different"))


def same_record(pairs: list[tuple[Column, Column]], most_different: int = 0, least_same: int = 1) -> Column:
    s = identity_score(pairs)
    return (s["different"] <= most_different) & (s["same"] >= least_same)


def caller_columns(caller: str, fields: list[str], format_fields: list[str] = ()) -> dict[str, str]:
    """New names: CALLER_FIELD, and NORM_FIELD for a normal's format fields."""
    return {f: f"{caller}_{f}" for f in fields} | {f"n_{f}": f"NORM_{f}" for f in format_fields}


def day(c: Column, form: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(c, F.lit(form)).cast("date")


def day_text(c: Column, form: str = "yyyy-MM-dd") -> Column:
    return F.date_format(c, form)


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a)
