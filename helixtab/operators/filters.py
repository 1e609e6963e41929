"""Row filters; columns and limits are parameters. Counts are text in the sources and are cast here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab import schema as S
from helixtab.functions import scalars as X


def called(df: DataFrame, tumor: str, normal: str, somatic: bool, format_: str = "FORMAT") -> DataFrame:
    """Wide genotype rows (a column per sample) in which the tumor has a call and depths; somatic: and the normal is 0/0 with depths."""
    keys = F.split(format_, ":")
    t, n = X.sample_map(F.col(format_), F.col(f"`{tumor}`")), X.sample_map(F.col(format_), F.col(f"`{normal}`"))
    ok = F.array_contains(keys, "GT") & F.array_contains(keys, "AD") & ~t["GT"].isin("0/0", "./.") & (t["AD"] != ".")
    if somatic:
        ok = ok & (n["GT"] == "0/0") & (n["AD"] != ".")
    return df.where(ok)


@dataclass(frozen=True)
class Limits:
    """Limits of depth_frequency; all but the depths are exclusive; -1 never holds anything back."""

    tumor_depth: int = -1
    normal_depth: int = -1
    times_normal: float = -1
    alt_count: int = 4
    alt_frequency: float = -1


SOMATIC = Limits(20, 8, 5, 5, 0.01)


@dataclass(frozen=True)
class Counts:
    """Columns of counts, and of the label whose LowQual rows go."""

    t_alt: str = "t_alt_count"
    t_ref: str = "t_ref_count"
    n_alt: str = "n_alt_count"
    n_ref: str = "n_ref_count"
    label: str | None = "FILTER"


def depth_frequency(df: DataFrame, limits: Limits = Limits(), counts: Counts = Counts(), compat: bool = True) -> DataFrame:
    """Rows with enough depth and alternative alleles, and far more of them in the tumor than in the normal.

    compat: the normal's frequency is taken over the tumor's depth, as it always was; otherwise
    over its own. A missing normal count leaves the normal out. Rows without numbers go.
    """
    number = lambda c: F.col(c).cast("string").try_cast("double")
    t_alt, n_alt, n_ref = number(counts.t_alt), number(counts.n_alt), number(counts.n_ref)
    depth = t_alt + number(counts.t_ref)
    n_depth = F.coalesce(n_alt + n_ref, F.lit(0.0))
    n_frequency = F.when(n_depth > 0, n_alt / (depth if compat else n_depth)).otherwise(0.0)
    frequency = t_alt / depth
    good = (depth > 0) & (depth >= limits.tumor_depth) & (n_depth >= limits.normal_depth) & (frequency > limits.times_normal * n_frequency) & (t_alt > limits.alt_count) & (frequency > limits.alt_frequency)
    if counts.label:
        good = good & ~F.coalesce(F.col(counts.label).contains("LowQual"), F.lit(False))
    return df.where(F.when(depth > 0, good))


def somatic_by_columns(df: DataFrame, limits: Limits = SOMATIC) -> DataFrame:
    """The same over a flat table that has frequencies and genotypes of both samples."""
    number = lambda c: F.col(c).try_cast("double")
    return df.where(
        ~F.coalesce(F.col("FILTER").contains("LowQual"), F.lit(False)) & ~F.col("GT").isin("0/0", "./.") & (F.col("NORM_GT") == "0/0")
        & (number("AD_ALT") + number("AD_REF") >= limits.tumor_depth) & (number("NORM_AD_REF") + number("NORM_AD_ALT") >= limits.normal_depth)
        & (number("ALT_FREQ") > limits.times_normal * number("NORM_ALT_FREQ")) & (number("AD_ALT") > limits.alt_count) & (number("ALT_FREQ") > limits.alt_frequency)
    )


def covered(df: DataFrame, least: int = 4) -> DataFrame:
    """Rows not of low quality with a genotype and more than least alternative reads."""
    return df.where(~F.coalesce(F.col("FILTER").contains("LowQual"), F.lit(False)) & F.col("GT").isNotNull() & ~F.col("GT").isin("0/0", "./.") & (F.col("AD_ALT").try_cast("int") > least))


def with_value(df: DataFrame, column: str, *empty: str) -> DataFrame:
    """Rows whose column isn't empty (nor one of the marks given)."""
    return df.where(~F.coalesce(F.col(column), F.lit("")).isin("", *empty))


def in_list(df: DataFrame, column: str, values: tuple[str, ...] = S.FUNCTIONAL_CLASSES) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def indels(df: DataFrame, column: str = "Variant_Type") -> DataFrame:
    return in_list(df, column, ("INS", "DEL"))


def label_passed(df: DataFrame, column: str = "FILTER", name: str = "Caller") -> DataFrame:
    """Rows not rejected, labelled by how they passed; others have no label."""
    c = F.col(column)
    label = F.when(c.contains("RESCUE"), "mutect.Rescue").when(c.contains("PASS") | (c == "common_variant"), "mutect")
    return df.where(~c.contains("REJECT")).withColumn(name, label)


def rescue(
    df: DataFrame, t_alt: Column, t_ref: Column, n_alt: Column, n_ref: Column, label: str = "FILTER", covered: str = "covered", reasons: str = "failure_reasons",
    allowed: tuple[str, ...] = S.RESCUABLE, ratio: float = 5, frequency: float = 0.01, depth: int = 3, compat: bool = True,
) -> DataFrame:
    """Rejected rows that are covered and failed for allowed reasons only become RESCUE if their frequency is high enough.

    compat: the limit of alternative reads never holds a row back; otherwise it does.
    """
    excusable = F.size(F.array_except(F.split(reasons, ","), F.array(*map(F.lit, allowed)))) == 0
    t_frequency, n_frequency = F.try_divide(t_alt, t_alt + t_ref), F.try_divide(n_alt, n_alt + n_ref)
    enough = (t_frequency >= frequency) & (t_frequency >= ratio * n_frequency)
    if not compat:
        enough = enough & (t_alt >= depth)
    return df.withColumn(label, F.when((F.col(label) == "REJECT") & (F.col(covered) == "COVERED") & excusable & enough, "RESCUE").otherwise(F.col(label)))


def standard_alleles(df: DataFrame, ref: str = "REF", qual: str = "QUAL") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows with other letters than ACGT in ref, or an infinite quality, are rejected, with a reason."""
    reason = F.when(F.col(ref).rlike("(?i)[^acgt]"), "non-standard reference allele").when(F.lower(F.col(qual)) == "inf", "infinite quality")
    marked = df.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def usable_reads(df: DataFrame, mapq: int = 20, duplicate: bool = True, improper: bool = False, indel: bool = False, qc_fail: bool = False, secondary: bool = False) -> DataFrame:
    """Alignments that pass the tests switched on, by flag, mapping quality and cigar."""
    bit = lambda n: F.col("flag").bitwiseAND(n) != 0
    good = F.col("mapq") >= mapq
    for on, bad in ((duplicate, bit(S.FLAG_DUPLICATE)), (improper, ~bit(S.FLAG_PROPER)), (indel, F.col("cigar").rlike("[ID]")), (qc_fail, bit(S.FLAG_QC_FAIL)), (secondary, bit(S.FLAG_SECONDARY))):
        if on:
            good = good & ~bad
    return df.where(good)


def hard_filters(df: DataFrame, rules: Mapping[str, Column], name: str = "FILTER") -> DataFrame:
    """Rows annotated with the names of the rules they break, joined by ';', or PASS; none is dropped."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.withColumn(name, F.when(F.size(broken) == 0, "PASS").otherwise(F.array_join(broken, ";")))


# Hard filters of SNPs and indels over annotation columns.
SNP_RULES = {"QD": "QD < 2", "MQ": "MQ < 40", "FS": "FS > 60", "HaplotypeScore": "HaplotypeScore > 13", "MQRankSum": "MQRankSum < -12.5", "ReadPosRankSum": "ReadPosRankSum < -8"}
INDEL_RULES = {"QD": "QD < 2", "ReadPosRankSum": "ReadPosRankSum < -20", "InbreedingCoeff": "InbreedingCoeff < -0.8", "FS": "FS > 200"}


def pipeline(df: DataFrame, *predicates: Column) -> DataFrame:
    """Predicates one after the other: low confidence, blacklist, artefacts."""
    for p in predicates:
        df = df.where(p)
    return df


@dataclass(frozen=True)
class SvLimits:
    """Support that a structural variant needs; a normal's supporting reads are a limit from above."""

    pairs: int = 5
    split_reads: int = 0
    mapq: int = 10
    tumor_reads: int = 2
    normal_reads: int = 2
    length: int = 500


SV_HOTSPOT = SvLimits(3, 0, 5, 1, 3)


def structural_variants(df: DataFrame, kind: str, limits: SvLimits = SvLimits(), hot: SvLimits = SV_HOTSPOT, compat: bool = True) -> DataFrame:
    """Rows of one kind (DEL, DUP, INV, BND or TRA) with enough support, and svlen.

    df: chrom, chrom2 (null: the same), pos, end, mapq, pairs, split_reads, t_reads, n_reads, label, n_label, hotspot. Contigs
    other than numbers, X and Y go. At a hotspot the limits hot hold, or the call passed while the normal's genotype
    is of low quality. Translocations (BND) have no length. compat: nothing of kind TRA passes, otherwise it means BND.
    """
    number = lambda c: X.sex_to_number(X.without_chr(c)).try_cast("int")
    rows = df.where(number(F.col("chrom")).isNotNull() & number(F.coalesce("chrom2", "chrom")).isNotNull()).withColumn("svlen", F.col("end") - F.col("pos"))
    if kind == "TRA" and compat:
        return rows.where(F.lit(False))
    limit = lambda name: F.when(F.col("hotspot"), getattr(hot, name)).otherwise(getattr(limits, name))
    supported = (F.col("mapq") >= limit("mapq")) & (F.col("pairs") >= limit("pairs")) & (F.col("split_reads") >= limit("split_reads")) & (F.col("t_reads") >= limit("tumor_reads")) & (F.col("n_reads") <= limit("normal_reads"))
    passed = F.col("hotspot") & F.col("label").contains("PASS") & F.col("n_label").contains("LowQual")
    long_enough = F.lit(True) if kind in ("BND", "TRA") else F.col("svlen") >= limit("length")
    return rows.where(long_enough & (supported | F.coalesce(passed, F.lit(False))))


def excluded(df: DataFrame, pattern: str, column: str, classes: DataFrame | None = None, key: str = "Sample") -> DataFrame:
    """Rows whose name doesn't match, and whose sample isn't of an excluded class."""
    rows = df.where(~F.col(column).rlike(pattern))
    return rows.join(classes, key, "left_anti") if classes is not None else rows


def outliers(df: DataFrame, value: str, sds: float = 2, group: list[str] | None = None) -> DataFrame:
    """Rows more than sds standard deviations from their group's mean."""
    stats = df.groupBy(*(group or [])).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    joined = df.join(stats, group) if group else df.crossJoin(F.broadcast(stats))  # one row
    return joined.where(F.abs(F.col(value) - F.col("mean")) > sds * F.col("sd"))


def routed(df: DataFrame, kind: str, start: str, end: str, padded: tuple[str, ...], pad: int, length: Column) -> DataFrame:
    """Rows of a panel design; the kinds given are widened by pad, within the chromosome."""
    wide = F.col(kind).isin(*padded)
    return df.withColumn(start, F.when(wide, X.clamped(F.col(start), -pad, length)).otherwise(F.col(start))).withColumn(end, F.when(wide, X.clamped(F.col(end), pad, length)).otherwise(F.col(end)))


# ---------------------------------------------------------------- a small rule language


def property_filter(df: DataFrame, conditions: Mapping[str, Mapping[str, str]], rule: str | None = None) -> DataFrame:
    """Rows that satisfy a rule over named conditions.

    A condition maps columns to tests, all of which must hold: '>=20', '!foo', '*part*', 'start*',
    '*end' or an exact value. rule is a boolean expression over the conditions' names with &, |, !
    and parentheses, which becomes one SQL expression; without it any of the conditions will do.
    """
    names = {n: _all_of([_test(df, c, t) for c, t in tests.items()]) for n, tests in conditions.items()}
    if rule is None:
        out = F.lit(False)
        for c in names.values():
            out = out | c
        return df.where(out)
    marked = df.select("*", *[c.alias(f"_rule_{n}") for n, c in names.items()])
    text = F.expr(_rule_sql(rule, set(names)))
    return marked.where(text).drop(*[f"_rule_{n}" for n in names])


def _rule_sql(rule: str, names: set[str]) -> str:
    import re

    out = []
    for t in re.findall(r"\w+|[&|!()]", rule):
        if t in ("(", ")"):
            out.append(t)
        elif t in "&|!":
            out.append({"&": "AND", "|": "OR", "!": "NOT"}[t])
        elif t in names:
            out.append(f"_rule_{t}")
        else:
            raise ValueError(f"no condition {t!r}")
    return " ".join(out)


def _all_of(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def _test(df: DataFrame, column: str, test: str) -> Column:
    c = F.col(column)
    if test.startswith("!"):
        return ~_test(df, column, test[1:])
    for op, f in ((">=", c.__ge__), ("<=", c.__le__), (">", c.__gt__), ("<", c.__lt__)):
        if test.startswith(op):
            return f(F.lit(float(test[len(op) :])))
    text = c.cast("string")
    if len(test) > 1 and test.startswith("*") and test.endswith("*"):
        return text.contains(test[1:-1])
    if test.startswith("*"):
        return text.endswith(test[1:])
    if test.endswith("*"):
        return text.startswith(test[:-1])
    return c == F.lit(test).cast(df.schema[column].dataType)
