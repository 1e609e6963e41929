"""Ranked lexical search by a hierarchical max tree over document ranges.

Documents lie in shards. In each a term has a tree: its documents with what the term adds to their scores, and over ranges of
16, 256 and 4096 documents the largest such value. A range's bound for a query is the sum of its terms' values, weighted; the
range of the highest bound is opened first, and a search ends when no range left can reach the score that is wanted. Shards are
ranges too: those of the highest bounds are searched first, and what the best documents there score is what all others must reach.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.llm import _words as W
from helixtab.llm._util import dealt, dropped, in_arrow, read, stored

#: Documents of a shard: 16**3; a range holds 16 of the level below.
FAN, DEPTH = 4, 3
DOCS = 1 << FAN * DEPTH
#: Bytes of text in a shard (but for a document that is longer), and that are numbered at a time; bytes of items searched at a time.
SHARD, CHUNK, ITEMS = 16 << 20, 4 << 20, 1 << 20
#: Shards a query is searched in first.
SEEDS = 4


def cuts(text: memoryview, most: int):
    """Pieces of most bytes or so of a text that end between terms."""
    at = 0
    while True:
        end = min(len(text), at + most)
        while end < len(text) and W.IN_TERM[text[end]]:
            stop = np.flatnonzero(~W.IN_TERM[np.frombuffer(text[end : end + most], np.uint8)])
            end = end + int(stop[0]) if len(stop) else min(len(text), end + most)
        yield text[at:end]
        if end == len(text):
            return
        at = end


class Postings:
    """Terms of a shard's documents and how often each has them, gathered chunk by chunk."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.texts: list[bytes] = []
        self.docs: list[int] = []
        self.cost = self.bytes = 0

    def add(self, doc: int, text: bytes) -> None:
        self.texts.append(text), self.docs.append(doc)
        self.cost += len(text) + 1
        if self.cost >= CHUNK:
            self.number()

    def number(self) -> None:
        """Number the terms of the texts held."""
        if not self.texts:
            return
        data = W.lowered(b" ".join(self.texts))
        start, end = W.bounds(data)
        known = W.Dictionary(data, start, end)
        doc = np.array(self.docs)[np.searchsorted(np.cumsum([len(t) + 1 for t in self.texts]), start, "right")] if len(start) else np.zeros(0, np.int64)
        key, tf = np.unique(known.ids * DOCS + doc, return_counts=True)
        packed = known.packed()
        self.parts.append((packed["words"], packed["word_end"].astype(np.int64), key // DOCS, key % DOCS, tf))
        self.bytes += self.cost
        self.texts, self.docs, self.cost = [], [], 0

    def whole(self) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """(terms, term, doc, tf), by term and document."""
        self.number()
        shift = np.cumsum([0, *(len(p[0]) for p in self.parts)])
        data = np.concatenate([p[0] for p in self.parts])
        end = np.concatenate([p[1] + s for p, s in zip(self.parts, shift, strict=False)])
        start = np.concatenate([np.append(0, p[1][:-1])[: len(p[1])] + s for p, s in zip(self.parts, shift, strict=False)])
        known = W.Dictionary(data, start, end)
        first = np.cumsum([0, *(len(p[1]) for p in self.parts)])
        term = known.ids[np.concatenate([p[2] + f for p, f in zip(self.parts, first, strict=False)])]
        doc, tf = np.concatenate([p[3] for p in self.parts]), np.concatenate([p[4] for p in self.parts])
        key, nth = np.unique(term * DOCS + doc, return_inverse=True)  # a document's pieces come together
        return known.packed(), key // DOCS, key % DOCS, np.bincount(nth, tf, minlength=len(key)).astype(np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def tree(terms: int, term: np.ndarray, doc: np.ndarray, value: np.ndarray) -> dict[str, np.ndarray]:
    """Levels from the documents (0) to the whole shard: range, largest value, number of ranges below, by term; the last has a node per term."""
    out = {"range0": doc.astype(np.uint16), "top0": value.astype(np.int32)}
    for level in range(1, DEPTH + 1):
        doc = doc >> FAN
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))) if len(term) else np.zeros(0, np.int64)
        value = np.maximum.reduceat(value, first) if len(first) else value
        out |= {f"range{level}": doc[first].astype(np.uint16), f"top{level}": value.astype(np.int32), f"many{level}": np.diff(np.append(first, len(term))).astype(np.uint8)}
        term, doc = term[first], doc[first]
    return out


class Shard:
    """The trees of a shard, opened."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.range = [parts[f"range{i}"] for i in range(DEPTH + 1)]
        self.top = [parts[f"top{i}"] for i in range(DEPTH + 1)]
        self.below = [None, *(np.concatenate(([0], np.cumsum(parts[f"many{i}"], dtype=np.int64))) for i in range(1, DEPTH + 1))]
        self.ids = [None if none else d for d, none in zip(parts["doc_id"].tolist(), parts["none"].tolist(), strict=True)]

    def bound(self, terms: np.ndarray, weight: np.ndarray) -> int:
        return int((self.top[DEPTH][terms] * weight).sum())

    def search(self, terms: np.ndarray, weight: np.ndarray, best: list, most: int, least: int) -> None:
        """Put the documents of this shard that score least or more, and are among the best, into the heap best of (score, -doc_id)."""
        first = self.bound(terms, weight)
        if first <= 0:
            return
        waiting = [(-first, DEPTH, 0, terms, weight)]
        while waiting:
            bound, level, _, nodes, weights = heapq.heappop(waiting)
            floor = max(least, best[0][0] if len(best) == most else 1)
            if -bound < floor:  # of an equal bound a range may hold a document of equal score and lower id
                return
            at, many = self.below[level][nodes], self.below[level][nodes + 1] - self.below[level][nodes]
            child = np.repeat(at - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            level -= 1
            weights = np.repeat(weights, many)
            slot = self.range[level][child].astype(np.int64)
            base = int(slot[0]) >> FAN << FAN
            slot -= base
            score = np.zeros(1 << FAN, np.int64)
            np.add.at(score, slot, self.top[level][child] * weights)
            for k in np.flatnonzero(score >= floor).tolist():
                if level:
                    on = slot == k
                    heapq.heappush(waiting, (-int(score[k]), level, base + k, child[on], weights[on]))
                else:
                    doc_id = self.ids[base + k]
                    entry = (int(score[k]), -math.inf if doc_id is None else -doc_id)
                    if len(best) < most:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(N, L): documents with a term, and all their terms."""

    def run(batches):
        for b in batches:
            texts = b["text"]
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
            inside = W.IN_TERM[data]
            begins = inside & ~np.append(False, inside[:-1]) if len(inside) else inside
            edges = offsets[:-1][np.diff(offsets) > 0] - offsets[0]
            begins[edges] = inside[edges]
            per = np.add.reduceat(begins, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int((per > 0).sum())]), pa.array([int(per.sum())])], names=["docs", "terms"])

    n = in_arrow(docs.select(F.coalesce("text", F.lit("")).alias("text")), run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return n[0] or 0, n[1] or 0


class Index:
    """shards: (shard, terms, tree), a table; N and L of all documents."""

    def __init__(self, shards: DataFrame, documents: int, terms: int):
        self.shards, self.N, self.L = shards, documents, terms


def build(docs: DataFrame, shard: int = SHARD, most_docs: int = DOCS) -> Index:
    """Index every row of docs (doc_id, text); other columns are ignored. See ranked()."""
    docs_n, terms_n = corpus_size(docs)

    def run(batches):
        nth, ids, held = TaskContext.get().partitionId() << 24, [], Postings()

        def out():
            terms, term, doc, tf = held.whole()
            n = np.bincount(doc, tf, minlength=len(ids)).astype(np.int64).tolist()
            m = np.array([50 + 50 * x * docs_n // max(1, terms_n) for x in n], np.int64)  # of any size in between
            parts = tree(len(terms["hash"]), term, doc, impact(tf, m[doc])) | {"doc_id": np.array([i or 0 for i in ids], np.int64), "none": np.array([i is None for i in ids])}
            df = np.bincount(term, minlength=len(terms["hash"])).astype(np.int32)
            press = zstandard.ZstdCompressor(level=1).compress
            blobs = [press(W.to_bytes(**terms, df=df, top=parts[f"top{DEPTH}"])), press(W.to_bytes(**parts))]
            return pa.RecordBatch.from_arrays([pa.array([nth]), *(pa.array([x], pa.binary()) for x in blobs)], names=["shard", "terms", "tree"])

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                size = len(text.as_buffer())
                if ids and (len(ids) == most_docs or held.bytes + held.cost + size > shard):
                    yield out()
                    nth, ids, held = nth + 1, [], Postings()
                for piece in cuts(memoryview(text.as_buffer()), CHUNK):
                    held.add(len(ids), bytes(piece))
                ids.append(doc_id)
        if ids:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return Index(stored(in_arrow(rows, run, "shard long, terms binary, tree binary"), "ranked", 4), docs_n, terms_n)


class Queries:
    """The terms of a few items, once each, and which each item has."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        data = W.lowered(b" ".join(t for _, t in items))
        start, end = W.bounds(data)
        known = W.Dictionary(data, start, end)
        item = np.searchsorted(np.cumsum([len(t) + 1 for _, t in items]), start, "right")
        pair = np.unique(item * max(1, len(known)) + known.ids)
        self.words, self.term = known.packed(), pair % max(1, len(known))
        self.first = np.searchsorted(pair // max(1, len(known)), np.arange(len(items) + 1))

    def find(self, terms: dict[str, np.ndarray]) -> np.ndarray:
        """The shard's number of each term, or -1."""
        last = self.words["word_end"].astype(np.int64)
        return W.find(terms, self.words["words"], np.append(0, last[:-1])[: len(last)], last)

    def split(self, number: np.ndarray, weight: np.ndarray):
        """(item, the shard's terms that it has, their weights)."""
        for i in range(len(self.ids)):
            term = self.term[self.first[i] : self.first[i + 1]]
            at = number[term]
            yield i, at[at >= 0], weight[term[at >= 0]]


def _opened(blob) -> dict[str, np.ndarray]:
    return W.from_bytes(zstandard.ZstdDecompressor().decompress(blob.as_buffer()))


def weights(index: Index, queries: Queries) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term, df over all shards."""

    def run(batches):
        for b in batches:
            for blob in b["terms"]:
                terms = _opened(blob)
                number = queries.find(terms)
                on = np.flatnonzero(number >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(terms["df"][number[on]].astype(np.int64))], names=["term", "df"])

    df = np.zeros(len(queries.words["hash"]), np.int64)
    for r in in_arrow(index.shards.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term of the block of items
        df[r.term] = r.df
    return np.array([math.floor(1000 * math.log((2 * index.N + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def _bounds(index: Index, queries: Queries, weight: np.ndarray) -> DataFrame:
    """(item, shard, bound) of shards that hold a term of the item."""

    def run(batches):
        for b in batches:
            for shard, blob in zip(b["shard"].to_pylist(), b["terms"], strict=True):
                terms = _opened(blob)
                rows = [(i, int((terms["top"][at] * w).sum())) for i, at, w in queries.split(queries.find(terms), weight) if len(at)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.int64())], names=["item", "shard", "bound"])

    return in_arrow(index.shards.select("shard", "terms"), run, "item long, shard long, bound long")


def _searched(shards: DataFrame, queries: Queries, weight: np.ndarray, most: int, least: list[int]) -> DataFrame:
    """(item, doc_id, score): of each task the best documents; shards: shard, terms, tree and items (whose, null: all)."""

    def run(batches):
        best: dict[int, list] = {}
        for b in batches:
            for terms, blob, items in zip(b["terms"], b["tree"], b["items"].to_pylist(), strict=True):
                only, shard = None if items is None else set(items), None
                known = _opened(terms)
                for i, at, w in queries.split(queries.find(known), weight):
                    if len(at) and (only is None or i in only) and int((known["top"][at] * w).sum()) >= least[i]:
                        shard = Shard(_opened(blob)) if shard is None else shard
                        shard.search(at, w, best.setdefault(i, []), most, least[i])
        rows = [(i, None if d == -math.inf else -d, s) for i, found in best.items() for s, d in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["item", "doc_id", "score"])

    return in_arrow(shards.select("terms", "tree", "items"), run, "item long, doc_id long, score long")


def search(index: Index, items: DataFrame, most: int = 50, block: int = ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score of the most best documents of each row of items; see ranked()."""
    spark = items.sparkSession
    every, nth = None, 0
    for part in dealt(items.select(F.col("item_id").cast("long").alias("item"), "text"), block):
        queries = Queries(part)
        weight = weights(index, queries)
        order = Window.partitionBy("item").orderBy(F.desc("bound"), "shard")
        seeds = _bounds(index, queries, weight).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SEEDS)
        seeds = seeds.groupBy("shard").agg(F.collect_list("item").alias("items"))  # SEEDS rows for an item of the block at most
        first = _searched(index.shards.join(F.broadcast(seeds), "shard"), queries, weight, most, [1] * len(part))
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        least = [1] * len(part)
        for r in first.withColumn("nth", rank).where(F.col("nth") == most).collect():  # a row per item of the block
            least[r.item] = r.score
        found = _searched(index.shards.withColumn("items", F.lit(None).cast("array<long>")), queries, weight, most, least)
        names = F.broadcast(spark.createDataFrame(list(enumerate(queries.ids)), "item long, item_id long"))  # of the block
        found = stored(found.join(names, "item").withColumn("block", F.lit(nth)), "ranks")
        every, nth = found if every is None else every.unionAll(found), nth + 1
    if every is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return every.withColumn("rank", rank).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, most: int = 50) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score (long) of the most documents that score highest for each row of items.

    docs: doc_id, text; items: item_id, text; other columns are ignored. Terms are runs of letters, digits and whatever isn't ASCII
    (A-Z lower-cased). A document's score sums w * ((10**9 tf) div (1000 tf + 20 m)) over the item's terms, once each;
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 50 + (50 n N) div L; documents that score 0 aren't returned. Equal
    scores go by doc_id, null last. Exact: no document is passed over that could be among the best. A null or empty text has no terms,
    as document or item. Each row of docs is a document and each row of items a query, those that repeat an id too. A very long
    text is numbered in pieces; its different terms lie in one shard. Empty tables give none.
    """
    index = build(docs)
    found = search(index, items, most)
    dropped(index.shards)
    return found


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS c, CAST(sum(n) AS BIGINT) AS l FROM n),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * c + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, c),
d AS (SELECT doc_id, 100 - 50 + ((50 * n * c) // l) AS m FROM n, s),
r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 50
"""
