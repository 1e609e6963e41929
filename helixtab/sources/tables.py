"""Tab-separated sources: all columns are text until cast. Headers are read by Spark, so any storage it reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class BadHeader(ValueError):
    """A file lacks the columns it must have."""


def comments(spark: SparkSession, path: str, mark: str = "#", most: int = 100_000) -> list[str]:
    """The lines at a file's start that begin with mark; a header of more than most lines is an error."""
    first = 1000
    while True:
        lines = [r.value for r in spark.read.text(path).limit(first).collect()]
        n = next((i for i, v in enumerate(lines) if not v.startswith(mark)), None)
        if n is not None or len(lines) < first:
            return lines[:n]
        if first >= most:
            raise BadHeader(f"{path}: more than {most} lines of comments")
        first *= 10


def header_of(spark: SparkSession, path: str, mark: str = "#", header_mark: str = "") -> list[str]:
    """Names in the first line that isn't a comment (or, with header_mark, that begins with it and not with mark)."""
    rows = spark.read.text(path).where(~F.col("value").startswith(mark)).limit(1).collect()
    line = rows[0].value if rows else ""
    return line.removeprefix(header_mark).split("\t") if line else []


def tsv(spark: SparkSession, path: str, mark: str = "#", names: list[str] | None = None, required: tuple[str, ...] = (), separator: str = "\t", header_mark: str = "") -> DataFrame:
    """A table with comment lines; names are taken from its header unless given (then it has none).

    Short lines are padded with null, cells beyond the header dropped.
    """
    own = names or header_of(spark, path, mark, header_mark)
    missing = [r for r in required if r not in own]
    if missing:
        raise BadHeader(f"{path}: no column {', '.join(missing)}")
    lines = spark.read.text(path).where(~F.col("value").startswith(mark) & (F.col("value") != ""))
    if not names:
        lines = lines.where(F.col("value") != F.lit(header_mark + separator.join(own)))
    cells = F.split("value", separator, -1)
    return lines.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(own)])


def preamble_tsv(spark: SparkSession, path: str, skip: int = 1) -> DataFrame:
    """A table whose header follows skip lines of preamble, such as call statistics."""
    first = [r.value for r in spark.read.text(path).limit(skip + 1).collect()]
    own = first[skip].split("\t") if len(first) > skip else []
    cells = F.split("value", "\t", -1)
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.col("value").isin(*first))
    return lines.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(own)])


def pairing(spark: SparkSession, path: str, tumor_first: bool = False) -> DataFrame:
    """(tumor, normal) of a list of pairs without header; pairs with NA for a sample are left out."""
    parts = F.split(F.trim("value"), r"\s+")
    pairs = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("p")).where(F.size("p") == 2)
    a, b = F.col("p")[0], F.col("p")[1]
    named = pairs.select((a if tumor_first else b).alias("tumor"), (b if tumor_first else a).alias("normal"))
    return named.where((F.upper("tumor") != "NA") & (F.upper("normal") != "NA"))


def grouping(spark: SparkSession, path: str) -> DataFrame:
    """(sample, group)."""
    return tsv(spark, path, names=["sample", "group"])


def mapping(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, names=["library", "sample", "run", "path", "end_type"])


def patients(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, required=("Sample_ID", "Patient_ID", "Class", "Bait_version"))


def config(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Settings by section ('' before the first '>Section'), of lines 'k v', 'k = v' or 'k: v'; a settings file is small."""
    out: dict[str, dict[str, str]] = {"": {}}
    section = ""
    for row in spark.read.text(path).collect():
        line = row.value.strip()
        if not line or line.startswith("#"):
            continue
        if line.startswith(">"):
            section = line[1:].strip()
            out.setdefault(section, {})
            continue
        for sep in ("=", ": ", None):
            k, found, v = line.partition(sep) if sep else (line.split(None, 1)[0], " ", (line.split(None, 1) + [""])[1])
            if found and k.strip() and " " not in k.strip():
                out[section][k.strip().rstrip(":")] = v.strip()
                break
    return out


def files(spark: SparkSession, pattern: str, name: str = r"([^/]+)$") -> DataFrame:
    """(value, path, sample) of all lines of files that match a glob."""
    return spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("path"), F.regexp_extract("_metadata.file_path", name, 1).alias("sample"))


def path_part(path: Column, i: int) -> Column:
    """The i-th component of a path, from the end if negative."""
    return F.try_element_at(F.split(path, "/"), F.lit(i if i < 0 else i + 1))


def newer(listing: DataFrame, date: str, than: str, form: str = "yyyy-MM-dd") -> DataFrame:
    """Rows of a listing whose date is later."""
    return listing.where(F.to_date(F.col(date), form) > F.to_date(F.lit(than), form))


def fingerprints(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, md5, modified, length) of files, read by Spark."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.md5("content").alias("md5"), F.col("modificationTime").alias("modified"), "length")
