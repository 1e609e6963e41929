"""Phrase mining by hierarchical pair naming.

Frequent words get ids. Two neighbouring ids of (k-1)-grams make a pair, which is a k-gram; pairs are counted over all blocks of
text, the frequent ones are given ids in a table, and the table is joined back to the blocks that ask, which replace their ids by
it. A k-gram's pair is its parents too: the first k - 1 words and the last k - 1, so counts of the parts of every cut come down the pointers,
and a phrase is held by a longer one as often if it is so by a child.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.llm import _words as W
from helixtab.llm._util import dropped, in_arrow, read, stored

#: Words in a phrase at most; occurrences at least; share (in hundredths) of a phrase's occurrences that a longer one may hold; phrases of a language.
LONGEST, LEAST, HELD, TOP = 5, 100, 100, 2000
#: Bytes of text in a block. Names up to which all go with every task (12 MB of pairs), counted before; more are joined by shuffle.
BLOCK, MOST_BROADCAST = 6 << 20, 500_000
CUT = np.zeros(256, bool)
CUT[list(b".,;:!?\n\v\f\r")] = True
IN_WORD = ~CUT
IN_WORD[list(b" \t")] = False


def cuts(text: memoryview, most: int, context: int):
    """(piece, bytes of it that are its own) of a text: pieces of most bytes or so that end with a word, each with the next context words after it."""
    at = 0
    while True:
        end = min(len(text), at + most)
        while end < len(text) and IN_WORD[text[end]]:
            stop = np.flatnonzero(~IN_WORD[np.frombuffer(text[end : end + most], np.uint8)])
            end = end + int(stop[0]) if len(stop) else min(len(text), end + most)
        if end == len(text):
            yield text[at:], end - at
            return
        size = 64
        while True:
            _, ends = W.bounds(np.frombuffer(text[end : end + size], np.uint8), IN_WORD)
            if len(ends) > context or end + size >= len(text):
                break
            size *= 2
        yield text[at : end + int(ends[min(context, len(ends)) - 1]) if len(ends) else end], end - at
        at = end


class Level:
    """Where in a block k-grams with an id start: place, number of the id (from 0), whether the place is the block's own; ids, sorted."""

    def __init__(self, place: np.ndarray, number: np.ndarray, own: np.ndarray, ids: np.ndarray):
        self.place, self.number, self.own, self.ids = place, number, own, ids

    def packed(self, **more: np.ndarray) -> bytes:
        step = np.diff(self.place, prepend=0).astype(np.int32)
        return zstandard.ZstdCompressor(level=1).compress(W.to_bytes(step=step, number=self.number.astype(np.int32), own=self.own, ids=self.ids, **more))

    @staticmethod
    def unpacked(blob) -> tuple[Level, dict[str, np.ndarray]]:
        """The level, and what else was packed with it."""
        parts = W.from_bytes(zstandard.ZstdDecompressor().decompress(blob))
        return Level(np.cumsum(parts["step"], dtype=np.int64), parts["number"].astype(np.int64), parts["own"], parts["ids"]), parts

    def of_words(self, word: np.ndarray, ids: np.ndarray) -> Level:
        """The first level: words by number (as this has them) have ids, others none."""
        order = np.argsort(ids)
        number = np.full(int(self.number.max(initial=0)) + 1, -1)
        number[word[order]] = np.arange(len(ids))
        number = number[self.number]
        on = number >= 0
        return Level(self.place[on], number[on], self.own[on], ids[order])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Which starts have a neighbour, and the pair of each as one number."""
        at = np.flatnonzero(self.place[1:] == self.place[:-1] + 1)
        return at, self.number[at] * len(self.ids) + self.number[at + 1]

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, n): the different pairs that start at own places."""
        at, pair = self.pairs()
        pair, n = np.unique(pair[self.own[at]], return_counts=True)
        many = max(1, len(self.ids))
        return self.ids[pair // many] if len(pair) else pair, self.ids[pair % many] if len(pair) else pair, n

    def named(self, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> Level:
        """The next level: pairs (left, right) have ids, others none."""
        order = np.argsort(ids)
        left, right, ids = left[order], right[order], ids[order]
        known = np.searchsorted(self.ids, left) * len(self.ids) + np.searchsorted(self.ids, right)
        by_pair = np.argsort(known)
        at, pair = self.pairs()
        nth = np.minimum(np.searchsorted(known[by_pair], pair), len(ids) - 1)
        on = known[by_pair][nth] == pair if len(ids) else np.zeros(len(pair), bool)
        return Level(self.place[at][on], by_pair[nth[on]], self.own[at][on], ids)


def tokenised(docs: DataFrame, block: int, longest: int) -> DataFrame:
    """Per block a row with data (its words by number), and one for each of its (lang, word): number, n; stored."""

    def run(batches):
        nth, pieces, cost = TaskContext.get().partitionId() << 24, [], 0

        def out():
            data = W.lowered(b"\n".join(p for p, _, _ in pieces))
            start, end = W.bounds(data, IN_WORD)
            words = W.Dictionary(data, start, end)
            ends = np.cumsum([len(p) + 1 for p, _, _ in pieces])
            piece = np.searchsorted(ends, start, "right")
            own = start < (ends - np.array([len(p) + 1 - o for p, o, _ in pieces]))[piece]
            names = sorted({lang for _, _, lang in pieces})
            code = np.array([names.index(lang) for _, _, lang in pieces])[piece]
            pair, number = np.unique(words.ids * len(names) + code, return_inverse=True)
            n = np.bincount(number[own], minlength=len(pair))
            cut = np.searchsorted(np.flatnonzero(CUT[data]), start)
            place = np.arange(len(start)) + np.cumsum(np.diff(cut, prepend=0) > 0)  # words apart by a cut aren't neighbours
            known = words.packed()
            blob = Level(place, number, own, np.zeros(0, np.int64)).packed(word=pair // len(names), lang_of=pair % len(names), langs=np.array(names), words=known["words"], word_end=known["word_end"])
            yield pa.RecordBatch.from_arrays([pa.array([nth]), pa.array([blob], pa.binary()), *(pa.nulls(1, t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=names_of)
            lang = pa.DictionaryArray.from_arrays(pa.array(pair % len(names), pa.int32()), pa.array(names, pa.string())).cast(pa.string())
            word = pa.StringArray.from_buffers(len(words), pa.py_buffer(np.concatenate(([0], known["word_end"])).astype(np.int32)), pa.py_buffer(known["words"])).take(pa.array(pair // len(names)))
            columns = [pa.array(np.full(len(pair), nth)), pa.nulls(len(pair), pa.binary()), lang, word, pa.array(np.arange(len(pair))), pa.array(n)]
            rows = pa.RecordBatch.from_arrays(columns, names=names_of)
            for at in range(0, len(pair), 100_000):
                yield rows.slice(at, 100_000)

        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"], strict=True):
                for piece, own in cuts(memoryview(text.as_buffer()), block, longest - 1):
                    if pieces and cost + len(piece) > block:
                        yield from out()
                        nth, pieces, cost = nth + 1, [], 0
                    pieces.append((bytes(piece), own, lang))
                    cost += len(piece) + 1
        if pieces:
            yield from out()

    names_of = ["block", "data", "lang", "word", "number", "n"]
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(in_arrow(rows, run, "block long, data binary, lang string, word string, number long, n long"), "words")


class Lexicon:
    """Words with ids, few enough to be with every task."""

    def __init__(self, lang: list[str], word: list[bytes], ids: np.ndarray):
        data = np.frombuffer(b"".join(word), np.uint8)
        end = np.cumsum([len(w) for w in word], dtype=np.int64)
        known = W.Dictionary(data, end - np.array([len(w) for w in word], np.int64), end)
        self.known, self.langs = known.packed(), sorted(set(lang))
        code = {n: i for i, n in enumerate(self.langs)}
        key = known.ids * len(self.langs) + np.array([code[n] for n in lang], np.int64)
        order = np.argsort(key)
        self.key, self.ids = key[order], ids[order]

    def of(self, parts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(number, id) of the words of a block that have one."""
        end = parts["word_end"].astype(np.int64)
        word = W.find(self.known, parts["words"], np.append(0, end[:-1])[: len(end)], end)[parts["word"]]
        code = {n: i for i, n in enumerate(self.langs)}
        lang = np.array([code.get(n, -1) for n in parts["langs"].tolist()])[parts["lang_of"]]
        key = word * len(self.langs) + lang
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        on = np.flatnonzero((word >= 0) & (lang >= 0) & (self.key[at] == key))
        return on, self.ids[at[on]]


class Pairs:
    """Pairs with ids, few enough to be with every task."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ids: np.ndarray):
        self.left, self.right, self.ids = left, right, ids

    def of(self, level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those whose parts a block has."""
        if not len(level.ids):
            return self.left[:0], self.right[:0], self.ids[:0]
        has = lambda x: level.ids[np.minimum(np.searchsorted(level.ids, x), len(level.ids) - 1)] == x
        on = has(self.left) & has(self.right)
        return self.left[on], self.right[on], self.ids[on]


_KINDS = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64())])
_ROWS = "block long, data binary, left long, right long, n long"


def _counted(block: int, level: Level, last: bool):
    """A row with a block's next level, unless it is the last, and a row for each of its pairs."""
    left, right, n = level.counted()
    if not len(n):
        return
    if not last:
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([level.packed()], pa.binary()), *(pa.nulls(1, pa.int64()) for _ in range(3))], schema=_KINDS)
    for at in range(0, len(n), 200_000):
        part = slice(at, at + 200_000)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n[part]), block)), pa.nulls(len(n[part]), pa.binary()), pa.array(left[part]), pa.array(right[part]), pa.array(n[part])], schema=_KINDS)


def _renamed(rows: DataFrame, names: DataFrame, level: int, last: bool, most: int) -> DataFrame:
    """The next level of each block, and its pairs (left, right, n), stored; rows: of the level before, names: their ids.

    Up to so many names go with every task. More are joined with the blocks that ask for them.
    """
    blocks = rows.where("data is not null").select("block", "data")
    few = names.limit(most + 1).toArrow()
    if few.num_rows <= most:
        if level == 1:
            known = Lexicon(few["lang"].to_pylist(), [w.encode() for w in few["word"].to_pylist()], few["id"].to_numpy())
        else:
            known = Pairs(*(few[c].to_numpy() for c in ("left", "right", "id")))

        def run(batches):
            for b in batches if few_of else ():
                for block, blob in zip(b["block"].to_pylist(), b["data"], strict=True):
                    now, parts = Level.unpacked(blob.as_buffer())
                    yield from _counted(block, now.of_words(*known.of(parts)) if level == 1 else now.named(*known.of(now)), last)

        few_of = few.num_rows
        del few
        return stored(in_arrow(blocks, run, _ROWS), f"pairs{level + 1}")

    def cogrouped(blobs: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for blob in blobs["data"]:
            now, _ = Level.unpacked(blob.as_buffer())
            a, b, ids = (asked[c].to_numpy() for c in ("a", "b", "id"))
            out += _counted(blobs["block"][0].as_py(), now.of_words(a, ids) if level == 1 else now.named(a, b, ids), last)
        return pa.Table.from_batches(out, _KINDS)

    if level == 1:
        asked = rows.where("word is not null").join(names.hint("merge"), ["lang", "word"]).select(F.col("block").alias("asker"), F.col("number").alias("a"), F.lit(0).cast("long").alias("b"), "id")
    else:
        asked = rows.where("data is null").join(names.hint("merge"), ["left", "right"]).select(F.col("block").alias("asker"), F.col("left").alias("a"), F.col("right").alias("b"), "id")
    return stored(blocks.groupBy("block").cogroup(asked.groupBy("asker")).applyInArrow(cogrouped, _ROWS), f"pairs{level + 1}")


def named(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, block: int = BLOCK, broadcast: int = MOST_BROADCAST) -> tuple[DataFrame, list[DataFrame]]:
    """(totals, names): totals: lang, n (all words); names[0]: id, lang, word, a; names[k - 1]: id, left, right (parents: ids of names[k - 2]), a. All k-grams of least occurrences have an id."""
    rows = tokenised(docs, block, longest)
    counted = stored(rows.where("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("a")), "lexicon")
    totals = stored(counted.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    names = [stored(counted.where(F.col("a") >= least).withColumn("id", F.monotonically_increasing_id()), "names1")]
    dropped(counted)
    for level in range(1, longest):
        own = ("lang", "word") if level == 1 else ("left", "right")
        after = _renamed(rows, names[-1].select(*own, "id"), level, level == longest - 1, broadcast)
        dropped(rows)
        rows = after
        found = rows.where("data is null").groupBy("left", "right").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        names.append(stored(found.withColumn("id", F.monotonically_increasing_id()), f"names{level + 1}"))
    dropped(rows)
    return totals, names


#: floor(1000 a n / (l r)) of the cut after the first j of k words, in decimals of 38 digits, with l and r.
SCORED = """transform(sequence(1, {k} - 1), j -> named_struct(
    'score', (cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(firsts[j - 1] as decimal(19, 0)) * cast(lasts[{k} - j - 1] as decimal(19, 0))),
    'cut', j, 'l', firsts[j - 1], 'r', lasts[{k} - j - 1]))"""


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, held: int = HELD, top: int = TOP, block: int = BLOCK, broadcast: int = MOST_BROADCAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the top phrases of each language.

    docs: lang, text; other columns are ignored; a null lang is und, a null text empty. Texts (A-Z lower-cased) are parted at
    . , ; : ! ? and line ends, and then into words at spaces and tabs. A phrase of 2 to longest words that occurs a >= least times within such
    parts (overlaps included) scores floor(1000 a n / (l r)) at its lowest cut (of equal ones the first), n: all words of the
    language, l and r: occurrences of both parts; unless its words are in a longer phrase with held hundredths of a or more. Exact at any
    size. Ranked by score, a (largest first), phrase (bytes). Every row counts, repeated ones too. A very long text is dealt
    to several blocks. An empty table, or one without frequent phrases, gives none.
    """
    totals, names = named(docs, longest, least, block, broadcast)
    info = names[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", *(F.expr("array()").cast("array<long>").alias(c) for c in ("firsts", "lasts")))
    found = None
    for k in range(2, longest + 1):
        left = info.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), F.array_append("firsts", F.col("a")).alias("firsts"))
        right = info.select(F.col("id").alias("right"), "last", F.array_append("lasts", F.col("a")).alias("lasts"))
        own = names[k - 1].join(left, "left").join(right, "right")
        info = stored(own.select("id", "left", "right", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "a", "firsts", "lasts"), f"info{k}")
        phrases = info
        if k < longest:  # what a longer phrase holds so often, a child of one word more holds so often
            child = names[k].select(F.col("left").alias("id"), "a").unionAll(names[k].select(F.col("right").alias("id"), "a")).groupBy("id").agg(F.max("a").alias("most"))
            phrases = info.join(child, "id", "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * held, F.lit(True)))
        scored = phrases.join(totals, "lang").withColumn("cut", F.array_min(F.expr(SCORED.format(k=k)))).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        found = scored if found is None else found.unionAll(scored)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS p, lang, t FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
w AS (SELECT p, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w[i : i + k - 1] AS g FROM (SELECT lang, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY lang, k, g HAVING count(*) >= 100),
held AS (SELECT lang, h, max(a) AS m FROM (SELECT lang, g[1 : k - 1] AS h, a FROM f WHERE k > 2 UNION ALL SELECT lang, g[2 : k] AS h, a FROM f WHERE k > 2) GROUP BY lang, h),
c AS (SELECT f.lang, f.k, f.g, f.a, unnest(generate_series(1, f.k - 1)) AS cut FROM f LEFT JOIN held ON held.lang = f.lang AND held.h = f.g WHERE f.k > 1 AND coalesce(held.m < f.a, true)),
s AS (SELECT c.lang, array_to_string(c.g, ' ') AS phrase, c.a, x.a AS l, y.a AS r, n.n, cut, CAST((1000 * CAST(c.a AS HUGEINT) * n.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM c JOIN n ON n.lang = c.lang JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1 : c.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b QUALIFY rank <= 2000
"""
