"""Mixing sources to target weights by weighted fair queueing.

The documents of each source, shuffled by a hash, get virtual finish times: the words of the
source so far divided by its weight. A global range sort by that time, cut off at the total
budget, takes from every source in proportion to its weight until it runs out, which is at
its second pass over its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.llm._util import WORD, read, renamed, with_running, words

#: Weights of the sources in order, over and over; share of all words; passes over a source at most.
WEIGHTS, SHARE_HALVES, PASSES = (5, 2, 1), 3, 2


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target, source_start, budget) of (source, size) rows.

    The budget is SHARE_HALVES / 2 of all words, shared by weight; a target stops at PASSES
    times its source's size and the excess is shared anew. A row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    upto = Window.orderBy("level", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    nth = (F.row_number().over(order) - 1) % len(weights) + 1
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = (
        rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth))
        .withColumn("source_start", F.sum("source_size").over(order) - F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("most", F.col("source_size") * PASSES)
        .withColumn("level", F.col("most") / F.col("weight"))
    )
    # in order of the level at which a source is full: full if its share of what is left is above its size
    rows = rows.withColumn("left2", F.col("total") * SHARE_HALVES - 2 * (F.sum("most").over(upto) - F.col("most"))).withColumn(
        "weights", F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight")
    )
    full = F.col("left2") * F.col("weight") > 2 * F.col("most") * F.col("weights")
    rows = rows.withColumn("full", full)
    level = (F.col("total") * SHARE_HALVES - 2 * F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(every)).cast("double") / (
        2 * F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every)
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * level)
    return rows.select("source", "source_size", "weight", target.alias("target"), "source_start", F.expr(f"total * {SHARE_HALVES} div 2").alias("budget"))


def shuffled(doc_id: Column, seed: str = "mix") -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix", carry: Column | None = None) -> DataFrame:
    """Each row's doc_id, source, size (words), source_size, target (of its source), taken (words), and its hash.

    docs: doc_id, source, text; other columns are ignored. A null text has no words; a null
    source is a source, ordered last; a null doc_id is shuffled like any other. Each row is a
    document: rows that repeat one are taken like any others. Whole documents are taken but for the one at the
    budget. taken is at most PASSES times size. An empty table gives none. carry: a value of each
    row that goes along, as the column carried.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), shuffled(F.col("doc_id"), seed).alias("hash"), (F.lit(None).cast("long") if carry is None else carry).alias("carried"))
    order = [F.col("source").asc_nulls_last(), F.col("hash"), F.col("doc_id"), F.col("size"), F.col("carried")]
    queued = with_running(rows, order, F.col("size"), "before").drop("before_range")
    targets = source_targets(queued.select("source", "size"), weights)
    named = queued.join(targets, queued["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    passes = named.withColumn("pass", F.explode(F.array(*[F.lit(i) for i in range(PASSES)])))
    words = F.col("pass") * F.col("source_size") + F.col("before") - F.col("source_start") + F.col("size")
    timed = passes.withColumn("finish", words.cast("double") / F.col("weight")).drop("source_start", "weight")
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("hash"), F.col("doc_id"), F.col("size"), F.col("carried"), F.col("pass"), F.col("before")]
    ranged = with_running(timed, order, F.col("size"), "ahead")
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("ahead")))
    # only rows without words can be alike in all of these; they are counted and given back
    key = ["doc_id", "source", "size", "source_size", "target", "hash", "before", "carried"]
    rows = ranged.groupBy(*key).agg(F.sum(taken).alias("taken"), F.expr(f"count(*) div {PASSES}").cast("int").alias("alike"))
    return rows.withColumn("alike", F.explode(F.array_repeat(F.lit(0), F.col("alike")))).drop("before", "alike")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """docs as the mix has them, same columns: a row for each time a document is taken.

    The document at the budget is cut to the words taken, joined by one space; n_chars, if there, follows. Rows
    that share doc_id, source and text are taken together and given by one of them. A null text has no words and isn't taken;
    a null doc_id or source is one like others. Columns of any name stay. An empty table gives none.
    """
    own = renamed(docs)
    name = dict(zip(docs.columns, own.columns, strict=True))
    doc_id, source, key = F.col(name["doc_id"]), F.col(name["source"]), F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = own.withColumn("key", key)
    # without nulls, and the same for the join and the rows that repeat: texts are shuffled once
    of = lambda d, s, k: [F.coalesce(d.cast("long"), F.lit(0)), d.isNull(), F.coalesce(s.cast("string"), F.lit("")), s.isNull(), k]
    same = [f"same{i}" for i in range(5)]
    takes = mix(keyed.select(doc_id.alias("doc_id"), source.alias("source"), "text", "key"), weights, seed, carry=F.col("key"))
    takes = takes.groupBy("doc_id", "source", "carried").agg(F.sum("taken").alias("taken"), F.any_value("size").alias("size")).where("taken > 0")
    taken = takes.select(*(c.alias(k) for c, k in zip(of(F.col("doc_id"), F.col("source"), F.col("carried")), same, strict=True)), "taken", "size")
    parts = F.filter(F.array_append(F.array_repeat(F.col("size"), F.expr("int(taken div size)")), F.expr("taken % size")), lambda n: n > 0)
    rows = keyed.select("*", *(c.alias(k) for c, k in zip(of(doc_id, source, F.col("key")), same, strict=True))).join(taken, same).dropDuplicates(same).withColumn("part", F.explode(parts))
    text = F.when(F.col("part") == F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("part").cast("int")), " "))
    out = rows.withColumn("text", text)
    if "n_chars" in name:
        out = out.withColumn(name["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*own.columns).toDF(*docs.columns)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
t AS (SELECT *, 2 * source_size AS most, sum(source_size) OVER ()::BIGINT AS total, (2 * source_size)::DOUBLE / w AS level FROM s),
u AS (
  SELECT *, (3 * total - 2 * (sum(most) OVER (ORDER BY level, source NULLS LAST) - most)) * w
            > 2 * most * (sum(w) OVER () - sum(w) OVER (ORDER BY level, source NULLS LAST) + w) AS is_full
  FROM t),
v AS (
  SELECT source, source_size, w, (3 * total) // 2 AS budget,
         CASE WHEN is_full THEN most::DOUBLE
              ELSE w * ((3 * total - 2 * sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())::DOUBLE
                        / (2 * sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())) END AS target
  FROM u),
q AS (
  SELECT d.*, source_size, w, budget, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source),
p AS (SELECT *, (pass * source_size + upto)::DOUBLE / w AS finish FROM q, (VALUES (0), (1)) AS x(pass)),
r AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, h, doc_id, size, pass ROWS UNBOUNDED PRECEDING) - size AS ahead FROM p)
SELECT doc_id, size, source_size, target, sum(greatest(0, least(size, budget - ahead)))::BIGINT AS taken
FROM r GROUP BY doc_id, size, source_size, target
"""
