"""What the operators of this subpackage share: storage, ranks, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Stands for a null doc_id where ids are compared: after all others.
NO_ID = (1 << 63) - 1
#: Bytes that a Python task gets at a time (but for a row that is longer); each batch is in the memory of the JVM and of Python.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or the session's checkpoint folder.

    Where neither is set, a local master gets a temporary one; on a cluster that would not be shared, so it is an error.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="helixtab-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def stored(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, survives lost executors. rows: at most so many in a file (where rows are large)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/helixtab/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.helixtab_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that stored() gave, once nothing reads them any more."""
    for df in tables:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.helixtab_path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Spark deletes what a query has shuffled when the query ends; for jobs of many queries, each stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def words(text: Column) -> Column:
    """The words of a text, unchanged; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_running(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add the sum of value over all rows before, in the order given, and the range they lie in.

    Rows are range-partitioned and written; only a row per range meets in one window, so
    the work is spread however large df is. Columns: {name} (exclusive sum), {name}_range.
    """
    part = f"{name}_range"
    keyed = df.select("*", value.alias(f"{name}_value"))
    ranged = stored(keyed.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), name)
    sums = ranged.groupBy(part).agg(F.sum(f"{name}_value").alias("_sum"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(starts, part)
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(f"{name}_value").over(own), F.lit(0)))
        .drop("_start", f"{name}_value")
    )


def with_variant(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc, variant, text): doc_id with NO_ID for null, and a number for each text of one id.

    Ids are normally unique: a count over ids alone tells, and every variant is 0. Where ids
    repeat, equal rows become one, and the texts of an id are numbered in order.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    repeated = bool(rows.groupBy("doc").count().where("count > 1").head(1))
    if not repeated:
        return rows.select("doc", F.lit(0).alias("variant"), "text"), False
    rows = rows.distinct()
    number = F.row_number().over(Window.partitionBy("doc").orderBy("text")) - 1
    return rows.select("doc", number.alias("variant"), "text"), True


def to_rows(docs: DataFrame, found: DataFrame, repeated: bool) -> DataFrame:
    """What was found per (doc, text), for each row of docs: every column of found but doc and text, and doc_id."""
    out = [c for c in found.columns if c not in ("doc", "variant", "text")]
    if not repeated:
        return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), *out)
    keys = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return keys.join(found, ["doc", "text"]).select("doc_id", *out)


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow(run, schema) in batches of few bytes, as texts may be long: this lowers the session's bytes a batch to BATCH_BYTES."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) != f"{BATCH_BYTES}b":
        spark.conf.set(key, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)


def with_found(docs: DataFrame, schema: str, found: Callable[[str | None], tuple], rows: int = 256) -> DataFrame:
    """docs with the columns of schema, which found gives for each text; columns of those names are replaced.

    Texts are taken from Arrow a few rows at a time, so that a task holds few of them as Python strings.
    """
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    new = [tuple(c.split()) for c in schema.split(", ")]
    rest = [c for c in docs.columns if c not in {n for n, _ in new}]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                got = list(zip(*map(found, b["text"].to_pylist()), strict=True))
                columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(got, new, strict=True)]
                yield pa.RecordBatch.from_arrays([*(b[c] for c in rest), *columns], names=[*rest, *(n for n, _ in new)])

    out = docs.select(*rest).schema
    for n, k in new:
        out = out.add(n, k)
    return in_arrow(docs.select(*rest), run, out)


def renamed(docs: DataFrame) -> DataFrame:
    """docs with names that clash with no operator's; the text keeps its own."""
    return docs.toDF(*[c if c == "text" else f"_{i}_{c}" for i, c in enumerate(docs.columns)])


def dealt(items: DataFrame, most: int, cut: Callable | None = None):
    """The rows of items (item, text) in lists of (item, bytes of text), each of most bytes or so: what a pass over documents may be given whole.

    cut: gives pieces (memoryviews) of a long text; without it a text of more bytes is a list of its own. Null texts are left out.
    """

    def run(batches):
        ids, texts, cost = [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(kind)), pa.array([texts], pa.list_(pa.binary()))], names=["items", "texts"])

        for b in batches:
            kind = b.schema.field("item").type
            for item, text in zip(b["item"].to_pylist(), b["text"], strict=True):
                view = memoryview(text.as_buffer())
                for piece in cut(view) if cut else (view,):
                    if ids and cost + len(piece) > most:
                        yield out()
                        ids, texts, cost = [], [], 0
                    ids.append(item), texts.append(bytes(piece))
                    cost += len(piece) + 1
        if ids:
            yield out()

    rows = items.select("item", "text").where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    kind = items.schema["item"].dataType.simpleString()
    blocks = stored(in_arrow(rows.repartition(1 + 2 * size // most), run, f"items array<{kind}>, texts array<binary>").withColumn("block", F.monotonically_increasing_id()), "items", 4)
    for (block,) in sorted(blocks.select("block").collect()):
        b = blocks.where(F.col("block") == block).first()
        yield list(zip(b["items"], map(bytes, b.texts), strict=True))
    dropped(blocks)
