"""Sinks. Results are written by Spark in parallel; single() makes one file of a report, which is small by nature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv(df: DataFrame, path: str, separator: str = "\t") -> None:
    df.write.mode("overwrite").option("sep", separator).option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def _line(columns: list[str]) -> Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])


def single(df: DataFrame, path: str, comments: list[str] = (), order: list[Column | str] = (), header: bool = True, header_mark: str = "") -> None:
    """One text file: comments, the header, then rows in order."""
    spark = df.sparkSession
    head = [*comments, *([header_mark + "\t".join(df.columns)] if header else [])]
    rows = (df.orderBy(*order) if order else df).select(_line(df.columns).alias("value"))
    top = spark.createDataFrame([(i, h) for i, h in enumerate(head)], "n int, value string").orderBy("n").select("value").coalesce(1) if head else None
    (top.unionAll(rows) if top is not None else rows).coalesce(1).write.mode("overwrite").text(path)


def vcf(df: DataFrame, path: str, header: list[str]) -> None:
    """Rows below the header lines of the file they came from."""
    single(df, path, header, header_mark="#")


def with_rejects(kept: DataFrame, rejected: DataFrame, path: str, log: str) -> None:
    tsv(kept, path)
    tsv(rejected, log)


def bed(df: DataFrame, path: str, chrom: str, start1: str, end1: str, *more: str) -> None:
    """1-based closed intervals as 0-based half-open lines."""
    df.select(F.col(chrom), (F.col(start1) - 1).alias("start0"), F.col(end1), *more).write.mode("overwrite").option("sep", "\t").csv(path)


def interval_list(df: DataFrame, path: str, chrom: str, start1: str, end1: str, strand: Column, name: Column, sequences: list[tuple[str, int]] = ()) -> None:
    rows = df.select(F.col(chrom).alias("c"), F.col(start1).alias("s"), F.col(end1).alias("e"), strand.alias("t"), name.alias("n"))
    single(rows, path, ["@HD\tVN:1.0", *[f"@SQ\tSN:{n}\tLN:{k}" for n, k in sequences]], header=False)


def segments(df: DataFrame, path: str) -> None:
    tsv(df.select(*[F.regexp_replace(F.col(f"`{c}`").cast("string"), r"\s+", "\t").alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]), path)


def report(df: DataFrame, path: str) -> None:
    """A table both as TSV and as JSON lines."""
    tsv(df, f"{path}/tsv")
    df.write.mode("overwrite").json(f"{path}/json")


def alignments(df: DataFrame, path: str, kind: str) -> None:
    """Alignments as bed, fasta, fastq, json or sam text."""
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    forms = {
        "bed": F.concat_ws("\t", "chrom", F.col("pos0").cast("string"), (F.col("pos0") + F.length("query")).cast("string"), "read_name", F.col("mapq").cast("string"), strand),
        "fasta": F.concat(F.lit(">"), "read_name", F.lit("\n"), "query"),
        "fastq": F.concat(F.lit("@"), "read_name", F.lit("\n"), "query", F.lit("\n+\n"), "quals"),
        "json": F.to_json(F.struct(*df.columns)),
        "sam": F.concat_ws("\t", "read_name", F.col("flag").cast("string"), "chrom", (F.col("pos0") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "query", "quals"),
    }
    df.select(forms[kind].alias("value")).write.mode("overwrite").text(path)
