"""Benchmark decontamination by an FM-index per training shard.

Documents are laid into shards of bounded size. A shard's words are numbered, its suffixes sorted, and of the
Burrows-Wheeler transform a wavelet tree is kept, level by level, with ranks, and the places of every 16th suffix. The
windows of the benchmark's items are searched backward through the tree, all windows of a block of items at once; what is
found is located by stepping back to a kept place, and the spans of a document are merged. The index is a table and
serves any number of item sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.llm import _words as W
from helixtab.llm._util import dealt, dropped, in_arrow, read, renamed, stored

#: Words in a window.
SIZE = 10
#: Bytes of text in a shard (with two for each text); positions then fit in 21 bits. Every how many words of a document a place is kept.
SHARD, EVERY = 3 << 20, 16
#: Bytes of items that are searched at a time: the bound of what each task is given.
ITEMS = 1 << 20


def suffixes(symbols: np.ndarray) -> np.ndarray:
    """Where each suffix starts, in order; at most 2**21 symbols, each stretch up to one that no other equals.

    Doubling: suffixes are ordered by 1, 2, 4 ... symbols, from then on those only that still have equals. A rank is the
    first place that suffixes which are still equal may take.
    """
    count = np.bincount(symbols)
    rank = (np.cumsum(count) - count)[symbols]
    out = np.empty(len(symbols), np.int64)
    alone = count[symbols] == 1
    out[rank[alone]] = np.flatnonzero(alone)
    left, step, field = np.flatnonzero(~alone), 1, np.uint64(21)
    while len(left):  # a suffix that has equals doesn't reach the last symbol within step symbols
        key = rank[left].astype(np.uint64) << (field + field) | rank[left + step].astype(np.uint64) << field | np.arange(len(left), dtype=np.uint64)
        key.sort()
        mine = left[(key & np.uint64((1 << 21) - 1)).astype(np.int64)]
        key >>= field
        group = (key >> field).astype(np.int64)
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = group + np.arange(len(group)) - np.repeat(heads, np.diff(np.append(heads, len(group))))
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        many = np.diff(np.append(heads, len(key)))
        rank[mine] = np.repeat(place[heads], many)
        out[place] = mine
        left = mine[np.repeat(many > 1, many)]
        step *= 2
    return out


class Bits:
    """Bits, 64 to a word, with the number of ones before each word."""

    def __init__(self, words: np.ndarray, before: np.ndarray):
        self.words, self.before = words, before

    @staticmethod
    def of(bits: np.ndarray) -> Bits:
        full = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        full[: len(bits)] = bits
        words = np.packbits(full, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(words).astype(np.int64)
        return Bits(words, (np.cumsum(counts) - counts).astype(np.int32))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class FmIndex:
    """Words of a few texts; 0 ends a text, word w is symbol w + 1."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.levels = [Bits(w, b) for w, b in zip(parts["bits"], parts["bits_before"], strict=True)]
        self.zeros, self.first, self.begin = parts["zeros"], parts["first"].astype(np.int64), parts["begin"].astype(np.int64)
        self.marks = Bits(parts["marks"], parts["marks_before"])

    @staticmethod
    def of(ids: np.ndarray, lengths: np.ndarray, known: W.Dictionary) -> FmIndex:
        """ids: of the words of all texts, end to end; lengths: each text's number of words; known: their dictionary."""
        texts = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        word = np.ones(len(ids) + texts, bool)
        word[ends] = False
        text = np.zeros(len(word), np.int64)
        text[word] = ids + 1
        order = text + texts - 1  # below all words, the ends by their place: no comparison goes on past an end
        order[ends] = np.arange(texts)
        sa = suffixes(order)
        starts = ends - lengths
        kept = np.zeros(len(text), bool)
        kept[starts] = True
        since = np.arange(len(text)) - np.repeat(starts, lengths + 1)
        kept |= since % EVERY == 0
        bwt = text[sa - 1]
        depth = max(1, int(len(known)).bit_length())
        bits, before, zeros = [], [], []
        begin = np.zeros(len(known) + 1, np.int64)  # where a symbol's stretch begins on the last level
        symbol = np.arange(len(known) + 1)
        for level in range(depth - 1, -1, -1):
            one = (bwt >> level & 1).astype(bool)
            b = Bits.of(one)
            bits.append(b.words), before.append(b.before), zeros.append(len(one) - int(one.sum()))
            r = b.rank(begin)
            begin = np.where(symbol >> level & 1, zeros[-1] + r, begin - r)
            bwt = np.concatenate((bwt[~one], bwt[one]))
        first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(known) + 1))))
        marks = Bits.of(kept[sa])
        parts = {"bits": np.array(bits), "bits_before": np.array(before), "zeros": np.array(zeros), "begin": begin.astype(np.int32), "first": first.astype(np.int32), "marks": marks.words, "marks_before": marks.before, "places": sa[kept[sa]].astype(np.int32), "ends": ends}
        return FmIndex(parts | known.packed())

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place i of the transform."""
        last = len(self.levels) - 1
        for nth, level in enumerate(self.levels):
            r = level.rank(i)
            i = np.where(symbol >> (last - nth) & 1, self.zeros[nth] + r, i - r)
        return i - self.begin[symbol]

    def back(self, i: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one word earlier (rows whose earlier word isn't an end)."""
        symbol = np.zeros(len(i), np.int64)
        for nth, level in enumerate(self.levels):
            one = level.get(i)
            r = level.rank(i)
            i = np.where(one, self.zeros[nth] + r, i - r)
            symbol = symbol * 2 + one
        return self.first[symbol] + i - self.begin[symbol]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) rows whose suffixes begin with each window; windows: symbols, one window a row, 0 for a word that isn't here."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.first[-1])
        high[lengths == 0] = 0
        for k in range(windows.shape[1] - 1, -1, -1):
            on = np.flatnonzero((k < lengths) & (low < high))
            symbol = windows[on, k]
            some = on[symbol > 0]
            low[on[symbol == 0]] = high[on[symbol == 0]] = 0
            symbol = symbol[symbol > 0]
            both = self.rank(np.concatenate((symbol, symbol)), np.concatenate((low[some], high[some])))
            low[some], high[some] = self.first[symbol] + both[: len(some)], self.first[symbol] + both[len(some) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of rows begin."""
        out = np.zeros(len(rows), np.int64)
        on, steps = np.arange(len(rows)), 0
        while len(on):
            here = self.marks.get(rows)
            out[on[here]] = self.parts["places"][self.marks.rank(rows[here])] + steps
            on, rows = on[~here], self.back(rows[~here])
            steps += 1
        return out


def cuts(text: memoryview, size: int, most: int):
    """(first byte, end, words before, words seen before) of the pieces of a text, each of most bytes or so that no piece had.

    A piece ends between words; the next one begins size - 1 words before that, so each window is whole in one.
    """
    at, end, before, again = 0, 0, 0, 0
    while True:
        end = min(len(text), end + most)
        while end < len(text) and W.IN_TERM[text[end]]:  # to the end of a word
            stop = np.flatnonzero(~W.IN_TERM[np.frombuffer(text[end : end + most], np.uint8)])
            end = end + int(stop[0]) if len(stop) else min(len(text), end + most)
        yield at, end, before, again
        if end == len(text):
            return
        start, _ = W.bounds(np.frombuffer(text[at:end], np.uint8))
        again = min(size - 1, len(start))
        before += len(start) - again
        at = at + int(start[-again]) if again else end


DOCS = "row long, doc_id long, start long, again long, words long"


def build(docs: DataFrame, size: int = SIZE, shard: int = SHARD) -> DataFrame:
    """(docs, index): a row per shard, stored; docs: an entry per text or piece of one: row (the document), doc_id, start (words before), again (of those, words that the piece before has too), words.

    docs: doc_id, text; other columns are ignored. A null text is empty. Each row is a document of its own, whatever its doc_id.
    A text of more than shard bytes goes to several shards, in pieces that overlap by size - 1 words. An empty table gives no shards.
    """
    kind = pa.list_(pa.struct([(c.split()[0], pa.int64()) for c in DOCS.split(", ")]))

    def run(batches):
        row, held, pieces, cost = TaskContext.get().partitionId() << 40, [], [], 0

        def out():
            data = W.lowered(b" ".join(pieces))
            start, end = W.bounds(data)
            ends = np.cumsum([len(p) + 1 for p in pieces])
            words = np.diff(np.searchsorted(start, ends), prepend=0)
            known = W.Dictionary(data, start, end)
            entries = [dict(h, words=n) for h, n in zip(held, words.tolist(), strict=True)]
            blob = W.to_bytes(**FmIndex.of(known.ids, words, known).parts)
            held.clear(), pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array([entries], kind), pa.array([blob], pa.binary())], names=["docs", "index"])

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                view = memoryview(text.as_buffer())
                for at, end, before, again in cuts(view, size, shard):
                    if held and cost + end - at + 2 > shard:
                        yield out()
                        cost = 0
                    held.append({"row": row, "doc_id": doc_id, "start": before, "again": again})
                    pieces.append(bytes(view[at:end]))
                    cost += end - at + 2
                row += 1
        if held:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(in_arrow(rows, run, f"docs array<struct<{DOCS.replace(' long', ': long')}>>, index binary"), "fm", 4)


class Windows:
    """The different windows of a few items' texts, and whose they are."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        data = W.lowered(b" ".join(t for _, t in items))
        start, end = W.bounds(data)
        known = W.Dictionary(data, start, end)
        self.words = known.packed()
        words = np.diff(np.searchsorted(start, np.cumsum([len(t) + 1 for _, t in items])), prepend=0)
        first = np.cumsum(words) - words
        many = np.where(words > 0, np.maximum(1, words - size + 1), 0)
        owner = np.repeat(np.arange(len(items)), many)
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        length = np.minimum(words[owner], size)
        table = np.full((len(at), size + 1), -1, np.int32)
        for k in range(size):
            on = k < length
            table[on, k] = known.ids[at[on] + k]
        table[:, size] = length
        table, nth = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
        self.table, self.length = table[:, :size], table[:, size].astype(np.int64)
        pairs = np.unique(np.stack((nth.ravel(), owner), axis=1), axis=0)
        self.owner = pairs[:, 1]
        self.owners = np.searchsorted(pairs[:, 0], np.arange(len(table) + 1))
        self.names = [n for n, _ in items]

    def found(self, index: FmIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
        """(text, start, end, items): merged spans of words in each text, with all that are hit; items: for each text, whose windows occur."""
        data, last = self.words["words"], self.words["word_end"]
        symbol = np.append(W.find(index.parts, data, np.concatenate(([0], last[:-1])), last) + 1, 0)
        low, high = index.search(symbol[self.table], self.length)
        hit = np.flatnonzero(high > low)
        many = (high - low)[hit]
        window = np.repeat(hit, many)
        ends = index.parts["ends"]
        place = index.locate(np.repeat(low[hit] - (np.cumsum(many) - many), many) + np.arange(len(window)))
        edge = np.zeros(int(ends[-1]) + 2, np.int64)
        np.add.at(edge, place, 1), np.add.at(edge, place + self.length[window], -1)
        on = np.diff(np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8))))
        start, end = np.flatnonzero(on == 1), np.flatnonzero(on == -1)
        text = np.searchsorted(ends, start)
        begin = np.concatenate(([0], ends[:-1] + 1))
        names: list[list[str]] = [[] for _ in ends]
        pairs = np.unique(np.stack((np.searchsorted(ends, place), window), axis=1), axis=0)
        much = self.owners[pairs[:, 1] + 1] - self.owners[pairs[:, 1]]
        owner = self.owner[np.repeat(self.owners[pairs[:, 1]] - (np.cumsum(much) - much), much) + np.arange(int(much.sum()))]
        for t, o in np.unique(np.stack((np.repeat(pairs[:, 0], much), owner), axis=1), axis=0).tolist():
            names[t].append(self.names[o])
        return text, start - begin[text], end - begin[text], names


def search(index: DataFrame, items: DataFrame, size: int = SIZE, most: int = ITEMS) -> DataFrame:
    """(row, start, end, items) of the texts of index with hits, stored: spans by place, and the item ids; a row's spans of unlike blocks or pieces may overlap.

    Each block of items is searched in all shards; only one block is with a task at a time.
    """
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
    names = ["row", "start", "end", "items"]

    def pass_of(windows: Windows):
        def run(batches):
            for b in batches:
                for docs, blob in zip(b["docs"].to_pylist(), b["index"], strict=True):
                    text, start, end, items_of = windows.found(FmIndex(W.from_bytes(blob.as_buffer())))
                    first = np.searchsorted(text, np.arange(len(docs) + 1))
                    rows = [(d["row"], start[i:j] + d["start"], end[i:j] + d["start"], items_of[n]) for n, (d, i, j) in enumerate(zip(docs, first, first[1:], strict=False)) if j > i]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        return run

    found = None
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    for block in dealt(rows, most, lambda text: (text[at:end] for at, end, _, _ in cuts(text, size, most))):
        windows = Windows(block, size)
        part = stored(in_arrow(index, pass_of(windows), "row long, start array<long>, end array<long>, items array<string>"), "hits")
        found = part if found is None else found.unionAll(part)
    return found if found is not None else index.sparkSession.createDataFrame([], "row long, start array<long>, end array<long>, items array<string>")


def merged(found: DataFrame) -> DataFrame:
    """(row, start, end): spans of search() of which none touches another of its row."""
    spans = found.select("row", F.explode(F.arrays_zip("start", "end")).alias("s")).select("row", "s.*")
    own = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("long"))
    return spans.withColumn("run", F.sum("new").over(own)).groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, shard: int = SHARD, most: int = ITEMS) -> DataFrame:
    """doc_id, n_words, spans (start, end: the words to remove, by their number from 0), items (ids as strings, sorted) of each row of docs.

    docs: doc_id, text; items: item_id, text; other columns are ignored. Words are runs of a-z, 0-9 and whatever isn't ASCII,
    after A-Z are lower-cased. A window is size words in a row of an item; of an item with fewer words, all of them; an item
    without words or of null text has none. All windows that occur anywhere in a document count, however often items or documents
    repeat; items of one id are one, a null item_id is called null. A null or empty text has no words and no
    spans, a very long one is indexed in pieces. Each row of docs has a row, those that repeat a doc_id or have none too. An empty table of docs gives none.
    """
    index = build(docs, size, shard)
    found = search(index, items, size, most)
    rows = stored(index.select(F.explode("docs").alias("d")).groupBy("d.row").agg(F.max("d.doc_id").alias("doc_id"), F.sum(F.col("d.words") - F.col("d.again")).alias("n_words")), "rows")
    dropped(index)
    spans = merged(found).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    names = found.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = spans.join(names, "row")
    return rows.join(hits, "row", "left").select("doc_id", "n_words", F.coalesce("spans", F.expr("array()").cast("array<struct<start: long, end: long>>")).alias("spans"), F.coalesce("items", F.expr("array()").cast("array<string>")).alias("items"))


def cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs (of unlike doc_ids) with the spans that contamination() found taken out of the text, from a span's first word to its last; same columns."""

    def cut(text: str, spans: list[dict]) -> str:
        data = text.encode()
        start, end = W.bounds(np.frombuffer(data, np.uint8))
        at, out = 0, []
        for s in spans:
            out.append(data[at : start[s["start"]]])
            at = end[s["end"] - 1]
        return b"".join((*out, data[at:])).decode()

    def run(batches):
        for b in batches:
            texts = [cut(t, s) if s else t for t, s in zip(b["text"].to_pylist(), b["_spans"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b[c] for c in names], names=names)

    own = renamed(docs)
    names = own.columns
    doc_id = own.columns[docs.columns.index("doc_id")]
    spans = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_doc"), F.col("spans").alias("_spans"))
    rows = own.join(spans, F.col(doc_id) == F.col("_doc"), "left").drop("_doc")
    return in_arrow(rows, run, own.schema).toDF(*docs.columns)


def op11_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS k, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS t FROM bw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS t FROM (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM win))),
hit AS (SELECT doc_id, item_id, p, win.k FROM dw JOIN win USING (k, t)),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)
"""
