"""I-Match fingerprints of documents.

Terms whose inverse document frequency lies in a band are kept; the distinct terms of a
document are sorted (by their 64-bit hashes, which stand for them) and hashed within each of many random subsets of that lexicon. Subsets
come at several rates, so that short and long documents both have some with a few terms:
an edit changes those that hold a changed term and leaves the others. The first level deals out
the whole lexicon, so every kept term counts. Texts with few terms, of which the band may keep none,
have subsets of all their terms besides.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm._util import read, stored, to_rows, with_running, with_variant

#: Share of documents that a term of the lexicon is in, at least and at most.
RAREST, COMMONEST = 1 / 2000, 1 / 20
#: (parts that a level deals the lexicon into, parts of it that are subsets).
LEVELS = ((16, 16), (64, 12), (256, 24), (1024, 24), (4096, 24))
SLOTS = sum(n for _, n in LEVELS)
#: Subsets that deal out all terms of a text of so many different terms at most, or of one without a kept term.
OWN, SHORT = 16, 64
#: Rows of the lexicon up to which it is broadcast; a larger one is joined by shuffle.
MOST_BROADCAST = 1_000_000
#: Hexadecimal digits of a subset's hash; an empty subset has dashes.
DIGITS = 4


#: What parts terms, in lower case: ASCII but letters and digits.
BETWEEN = r"[\x00-/:-`{-\x7f]+"


def terms(text: Column) -> Column:
    """Distinct terms, in lower case; '' where the text begins or ends with none."""
    return F.array_distinct(repeated_terms(text))


def repeated_terms(text: Column) -> Column:
    return F.split(F.lower(text), BETWEEN)


def lexicon(texts: DataFrame, n: int) -> DataFrame:
    """(term, slots): terms in the band, as 64-bit hashes, and the subsets that each is in.

    It has at most mean-distinct-terms / RAREST rows, however many documents there are: each
    of its terms is in n * RAREST documents, and all documents have n * mean terms.
    """
    # outer: Spark would first look whether there are any, by taking the text apart twice
    each = texts.select(F.explode_outer(terms(F.col("text"))).alias("word")).where("word != ''")
    df = each.select(F.xxhash64("word").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    kept = df.where((F.col("df") >= n * RAREST) & (F.col("df") <= max(1.0, n * COMMONEST)))
    slots, first = [], 0
    for seed, (parts, subsets) in enumerate(LEVELS):
        part = F.pmod(F.xxhash64("term", F.lit(seed)), F.lit(parts)).cast("int")
        slots.append(F.when(part < subsets, part + first))
        first += subsets
    # no condition on slots, of which the first level gives each term one: Spark would ask it of every term of every text
    return kept.select("term", F.array_compact(F.array(*slots)).alias("slots"))


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets with equal hashes, among those that are not empty in both, of the
    coarsest level whose subsets mostly hold a term or none, and all finer ones, and those of all terms; 1 for equal fingerprints.
    """
    counts, first = [], 0
    for _, subsets in (*LEVELS, (OWN, OWN)):
        pairs = F.arrays_zip(F.slice(a["hashes"], first + 1, subsets).alias("x"), F.slice(b["hashes"], first + 1, subsets).alias("y"))
        some = F.filter(pairs, lambda p: (p["x"] >= 0) | (p["y"] >= 0))
        same = F.size(F.filter(some, lambda p: p["x"] == p["y"]))
        fits = F.size(some) <= 0.75 * subsets if first < SLOTS else F.size(some) > 0
        counts.append(F.struct(F.size(some).alias("some"), same.alias("same"), fits.alias("fits")))
        first += subsets
    every = F.aggregate(
        F.array(*counts), F.struct(F.lit(0).alias("some"), F.lit(0).alias("same"), F.lit(False).alias("fits")),
        lambda t, c: F.struct(
            F.when(t["fits"] | c["fits"], t["some"] + c["some"]).otherwise(0).alias("some"), F.when(t["fits"] | c["fits"], t["same"] + c["same"]).otherwise(0).alias("same"), (t["fits"] | c["fits"]).alias("fits"),
        ),
        lambda t: F.when(t["some"] > 0, t["same"] / t["some"]).otherwise(0.0),
    )
    return F.when((a["whole"] == b["whole"]) & (a["hashes"] == b["hashes"]), 1.0).otherwise(every)


def _shown(f: Column) -> Column:
    digits = F.transform(f["hashes"], lambda h: F.when(h < 0, F.lit("-" * DIGITS)).otherwise(F.lpad(F.lower(F.hex(h)), DIGITS, "0")))
    return F.concat(F.lpad(F.lower(F.hex(f["whole"])), 16, "0"), F.array_join(digits, ""))


def fingerprints(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(doc, variant, few, kept_text, kept_edited) for texts (doc, variant, text, edited): for each of both the hashes of the lexicon's
    subsets, -1 where one is empty; null if all are. A document without a kept term has no row. few: 1 if the text has at most SHORT terms, and 2 if the edited one has.

    Terms that both have are looked up once. words: the lexicon; it is broadcast if it is small.
    """
    a, b = repeated_terms(F.col("text")), repeated_terms(F.col("edited"))
    parted = texts.select("doc", "variant", F.array(*(f(a, b) for f in (F.array_intersect, F.array_except)), F.array_except(b, a)).alias("sides"))
    both, *own = (F.size(F.col("sides")[i]) - F.array_contains(F.col("sides")[i], "").cast("int") for i in range(3))
    few = ((both + own[0]) <= SHORT).cast("int") + F.lit(2) * ((both + own[1]) <= SHORT).cast("int")
    each = parted.select("doc", "variant", few.alias("few"), F.posexplode_outer("sides").alias("side", "words"))
    found = each.select("doc", "variant", "few", "side", F.explode("words").alias("word")).select("doc", "variant", "few", "side", F.xxhash64("word").alias("term"))
    small = words.count() <= MOST_BROADCAST
    found = found.join(F.broadcast(words) if small else words.hint("merge"), "term").select("doc", "variant", "few", "term", F.explode("slots").alias("slot"), "side")

    def hashed(other: int) -> Column:
        own = F.sort_array(F.collect_list(F.when(F.col("side") != other, F.col("term"))))
        return F.when(F.size(own) > 0, F.pmod(F.xxhash64(own), F.lit(1 << 4 * DIGITS)).cast("int"))

    slots = found.groupBy("doc", "variant", "few", "slot").agg(hashed(2).alias("text"), hashed(1).alias("edited"))
    sides = ("text", "edited")
    got = slots.groupBy("doc", "variant", "few").agg(F.sort_array(F.collect_list(F.struct("slot", *sides))).alias("by"), *(F.max(c).alias(f"most_{c}") for c in sides))

    def of(side: str) -> Column:
        """The hashes in the order of slots, with -1 for slots between them and after the last."""
        by, none = F.col("by"), F.lit(-1)
        before = lambda i: F.coalesce(F.get(by, i - 1)["slot"], none)
        filled = F.flatten(F.transform(by, lambda x, i: F.concat(F.array_repeat(none, x["slot"] - before(i) - 1), F.array(F.coalesce(x[side], none)))))
        every = F.concat(filled, F.array_repeat(none, F.lit(SLOTS - 1) - F.element_at(by, -1)["slot"]))
        return F.when(F.col(f"most_{side}").isNotNull(), every)

    return got.select("doc", "variant", "few", *[of(c).alias(f"kept_{c}") for c in sides])


def _print(kept: Column, text: Column, few: Column) -> Column:
    """(whole, hashes) of a text, from the hashes of its kept terms' subsets (null: no kept term); few: whether it has at most SHORT terms.

    Only of a text with few terms, or no kept one, are the terms looked at again.
    """
    every = F.sort_array(F.transform(F.filter(terms(text), lambda w: w != ""), lambda w: F.xxhash64(w)))

    def dealt(own: Column) -> Column:
        subsets = F.transform(F.sequence(F.lit(0), F.lit(OWN - 1)), lambda i: F.filter(own, lambda t: F.pmod(t, F.lit(OWN)) == i))
        return F.transform(subsets, lambda s: F.when(F.size(s) > 0, F.pmod(F.xxhash64(s), F.lit(1 << 4 * DIGITS)).cast("int")).otherwise(-1))

    own = F.get(F.transform(F.array(every), lambda own: F.struct(F.xxhash64(own).alias("all"), dealt(own).alias("hashes"))), F.lit(0))
    short = F.when(kept.isNull() | F.coalesce(few, F.lit(True)), own)
    none = F.array_repeat(F.lit(-1), OWN)
    of = F.get(F.transform(F.array(short), lambda s: F.struct(F.coalesce(s["all"], F.lit(0)).alias("all"), F.concat(F.coalesce(kept, F.array_repeat(F.lit(-1), SLOTS)), F.coalesce(s["hashes"], none)).alias("hashes"))), F.lit(0))
    return F.get(F.transform(F.array(of), lambda x: F.struct(F.xxhash64(x["all"], x["hashes"]).alias("whole"), x["hashes"].alias("hashes"))), F.lit(0))


@contextmanager
def _sorted(spark: SparkSession) -> Iterator[None]:
    """While it lasts, lists are collected in order: a document's rows are together, and hashing its many groups would end in sorting them twice."""
    key = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of edited ones, and how alike they are.

    docs: doc_id, text; other columns are ignored. The last third of each text is replaced by
    as much of the next document's start, in descending doc_id (a null doc_id is the largest);
    rows that repeat a doc_id and text are one document in that order, and get a row each;
    different texts under a doc_id follow each other in their order. A null text is empty. A
    text without terms in the band, or with few terms, is fingerprinted by all its terms too; a text without terms is like another.
    A very long text has a row for each kept term and subset. An empty table gives none.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows, repeated = with_variant(docs)
    ids = rows.select("doc", "variant", F.length("text").alias("n"))
    ranked = with_running(ids, [F.col("doc").desc(), F.col("variant")], F.lit(1), "rank").drop("rank_range")
    n = ranked.count()
    if not n:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    # the document before each in the order is the one whose edit takes its start
    before = ranked.select(F.col("doc").alias("to_doc"), F.col("variant").alias("to_variant"), F.floor(F.col("n") / 3).cast("int").alias("need"), ((F.col("rank") + 1) % n).alias("rank"))
    order = ranked.select("doc", "variant", "rank").join(before, "rank").drop("rank")
    starts = rows.join(order, ["doc", "variant"]).select(F.col("to_doc").alias("doc"), F.col("to_variant").alias("variant"), "need", F.expr("left(text, need)").alias("start"))
    both = rows.join(starts, ["doc", "variant"]).withColumn("edited", F.concat(F.expr("left(text, length(text) - need)"), F.col("start")))
    prints = fingerprints(both, stored(lexicon(rows, n), "lexicon"))
    facts = both.select("doc", "variant", "text", "edited")
    found = facts.join(prints, ["doc", "variant"], "left").select(
        "doc", "variant", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        _print(F.col("kept_text"), F.col("text"), F.col("few").isin(1, 3)).alias("p"), _print(F.col("kept_edited"), F.col("edited"), F.col("few").isin(2, 3)).alias("e"),
    )
    with _sorted(docs.sparkSession):
        out = stored(found, "prints")
    following = out.select("doc", "variant", F.col("p").alias("q")).join(order, ["doc", "variant"]).select(F.col("to_doc").alias("doc"), F.col("to_variant").alias("variant"), "q")
    named = out.join(following, ["doc", "variant"]).select(
        "doc", "variant", "n_chars", "edited_sha256", _shown(F.col("p")).alias("fingerprint"), _shown(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("p"), F.col("e")).alias("near_edited"), likeness(F.col("p"), F.col("q")).alias("near_next"),
    )
    if repeated:
        named = named.join(rows, ["doc", "variant"])
    return to_rows(docs, named, repeated)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(read(spark, sf_dir, "documents"))
