"""A training-data pipeline over documents: five stages, each by an operator of helixtab.llm.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm import mixing, packing, quality_rules, secret_scan, simhash_dedup
from helixtab.llm._util import read, renamed, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    crf = quality_rules.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    own = renamed(docs)
    return quality_rules.assess(own, crf).where("kept").select(*own.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays (of rows that share it, one)."""
    return simhash_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    model = secret_scan.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    own = renamed(docs)
    found = secret_scan.scan(own, model)
    n_chars = own.columns[docs.columns.index("n_chars")]
    changed = {"text": F.col("redacted"), n_chars: F.length("redacted").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in own.columns]).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the one at the budget is cut to the words taken."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("simhash_dedup", near_dedup), ("secret_scan", secrets), ("mixing", mix), ("packing", pack)]

#: Trained models, tokenizers and fingerprints are beyond SQL; tests/llm/test_pipeline.py compares each stage with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
