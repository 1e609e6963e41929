"""Where windows of documents recur: the candidate search of both substring operators.

Hashes only route. A window's key (see _hashes.regions) says where it can meet its like;
neighbouring windows under one key form a region. A region that seems to repeat another one
whole, and a window of a key with very many regions that seems to repeat another, become claims:
the text of the region that they name is brought to the document and each operator's own method
locates it there (confirm). Other regions that share a key are settled by that method where they meet
(settle). A claim that fails, as hashes may collide, sends all regions of its key to be
compared by their text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixtab.llm import _hashes as H
from helixtab.llm._util import in_arrow, shared_dir, stored

#: Longest region, in windows; place = variant << 42 | first window << 10 | windows.
LONGEST = 1000
PIECE = 1 << 20
#: The windows of a key with more different regions than this are dealt out again one by one, as claims.
HOT = 2000
#: Tokens in a block of text that is brought to a claim: words, bytes.
BLOCK = {True: 64, False: 512}
ALL_BITS = (1 << 64) - 1


def place(variant, first, size):
    return (variant << 42) | (first << 10) | size


def first_of(where):
    return (where >> 10) & 0xFFFFFFFF


def size_of(where):
    return where & 1023


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def scan(window: int, k: int, by_words: bool, bits: int = ALL_BITS, collapse: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc, variant, text) to (key, whole, doc, place, rep, known).

    Of regions in a batch of documents with one hash only the first goes on (unless collapse is off);
    the others claim to repeat it (known = 1: whole is the document of the first, rep its place)
    and go to a key of their own document. So a group of copies reaches a key as one row a
    batch. known = 2: windows of the region may equal each other. bits: those of a hash that are kept.
    """
    mask = np.uint64(bits)

    def regions_of(docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
        got: list[tuple[np.ndarray, ...]] = []
        held: list[np.ndarray] = []
        whose: list[tuple[int, int, int]] = []
        n = 0

        def flush():
            nonlocal held, whose, n
            if held:
                values = np.concatenate(held)
                ends = np.cumsum([len(x) for x in held])
                first, size, key, whole, inner = H.regions(values, ends, window, k, LONGEST)
                own = np.searchsorted(ends, first, "right")
                base = ends - [len(x) for x in held]
                doc, variant, at = (np.array([w[j] for w in whose], np.int64) for j in range(3))
                got.append((key & mask, whole & mask, doc[own], place(variant[own], first - base[own] + at[own], size), inner))
            held, whose, n = [], [], 0

        for doc, variant, text in docs:
            for at, values in H.pieces(text, PIECE, window - 1, by_words):
                if len(values) >= window:
                    held.append(values)
                    whose.append((doc, variant, at))
                    n += len(values)
                    if n >= PIECE:
                        flush()
        flush()
        if not got:
            return None
        key, whole, doc, where, inner = (np.concatenate(x) for x in zip(*got, strict=True))
        rep, known = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        if collapse:
            size = size_of(where)
            order = np.lexsort((where, doc, size, whole, key))
            key, whole, doc, where, inner, size = key[order], whole[order], doc[order], where[order], inner[order], size[order]
            same = (key[1:] == key[:-1]) & (whole[1:] == whole[:-1]) & (size[1:] == size[:-1])
            head = np.flatnonzero(np.concatenate(([True], ~same)))
            head = np.repeat(head, np.diff(np.concatenate((head, [len(key)]))))
            if by_words:  # a repeat within one document does not count
                known = doc > doc[head]
            else:
                known[1:] = same
            rep = np.where(known, where[head], 0)
            whole = np.where(known, doc[head].view(np.uint64), whole)
            key = np.where(known, H.mix(doc.view(np.uint64)), key)
        return pa.RecordBatch.from_arrays(
            [pa.array(_signed(key)), pa.array(_signed(whole)), pa.array(doc), pa.array(where), pa.array(rep), pa.array(np.where(known, 1, 2 * inner).astype(np.int8))],
            names=["key", "whole", "doc", "place", "rep", "known"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int, int, bytes]] = []
        size = 0
        for b in batches:
            for doc, variant, text in zip(b["doc"].to_pylist(), b["variant"].to_pylist(), b["text"], strict=True):
                data = text.as_buffer().to_pybytes()
                docs.append((doc, variant, data))
                size += len(data)
                if size >= 16 * PIECE:
                    if (out := regions_of(docs)) is not None:
                        yield out
                    docs, size = [], 0
        if docs and (out := regions_of(docs)) is not None:
            yield out

    return run


SCANNED = "key long, whole long, doc long, place long, rep long, known byte"


def candidates(docs: DataFrame, window: int, k: int, by_words: bool, bits: int) -> DataFrame:
    """(key, doc, place, rep_doc, rep, repeat): regions that seem to repeat an earlier one whole (repeat = 1: region rep
    of rep_doc), and those that are the first of their kind under a key with others, or may repeat themselves (repeat = 0).
    """
    scanned = in_arrow(docs, scan(window, k, by_words, bits), SCANNED)
    length = F.expr("place & 1023")
    alike, under = Window.partitionBy("key", "whole", length), Window.partitionBy("key")
    least = F.min(F.struct("doc", "place")).over(alike)
    kind = F.when(F.col("known") != 1, F.struct("whole", length))
    rows = scanned.repartition("key").select("*", least.alias("least"), (F.min(kind).over(under) != F.max(kind).over(under)).alias("others"))
    known = F.col("known") == 1
    later = (F.col("doc") > F.col("least.doc")) if by_words else (F.struct("doc", "place") > F.col("least"))
    first = ~known & ~later & (F.col("others") | (F.col("known") == 2)) & (F.struct("doc", "place") == F.col("least"))
    if by_words:  # other places in the first document may cover other words
        first = ~known & ~later & F.col("others")
    claimed = rows.where(known | later | first).select(
        "key", "doc", "place", F.when(known, F.col("whole")).otherwise(F.col("least.doc")).alias("rep_doc"), F.when(known, F.col("rep")).otherwise(F.col("least.place")).alias("rep"), (known | later).cast("byte").alias("repeat"),
    )
    return stored(claimed, "regions")


class Texts:
    """Texts by (doc, variant), compressed, in a table dealt out by both, so that joins with it move the other side only."""

    def __init__(self, docs: DataFrame):
        def run(batches):
            press = zstandard.ZstdCompressor(level=1)
            for b in batches:
                data = pa.array([press.compress(t.as_buffer()) for t in b["text"]], pa.binary())
                yield pa.RecordBatch.from_arrays([b["doc"], b["variant"], data], names=["doc", "variant", "data"])

        self.spark = docs.sparkSession
        self.name = f"helixtab_texts_{uuid.uuid4().hex}"
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = in_arrow(docs, run, "doc long, variant int, data binary").repartition(n, "doc", "variant")
        path = f"{shared_dir(self.spark)}/helixtab/{self.name}"
        rows.write.format("parquet").option("compression", "none").option("path", path).bucketBy(n, "doc", "variant").saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)


def unpack(data: bytes) -> bytes:
    return zstandard.decompress(data) if data else b""


class Tokens:
    """A text's tokens as stretches of bytes: words, or the bytes themselves."""

    def __init__(self, text: bytes, by_words: bool):
        self.text, self.by_words = text, by_words
        if by_words:
            self.start, self.end = H.word_bounds(np.frombuffer(text, np.uint8))
        self.n = len(self.start) if by_words else len(text)

    def stretch(self, a: int, b: int) -> bytes:
        if not self.by_words:
            return self.text[a:b]
        return self.text[int(self.start[a]) : int(self.end[min(b, self.n) - 1])] if a < min(b, self.n) else b""


def _cuts(window: int, by_words: bool):
    """(data, regions, blocks) of a document to rows: contexts of its regions (kind 0), hashes of the windows of regions of hot keys
    (kind 1, keyed by the hash), and the blocks wanted of it (kind 2, place: the number of the block).
    """

    def run(batches):
        for b in batches:
            key, doc, where, context, kind = [], [], [], [], []

            def put(k, d, w, c, of):
                key.append(k), doc.append(d), where.append(w), context.append(c), kind.append(of)

            for d, v, data, regions, blocks in zip(*(b[c].to_pylist() for c in ("doc", "variant", "data", "regions", "blocks")), strict=True):
                t = Tokens(unpack(data), by_words)
                for r in regions or []:
                    at, size = first_of(r["place"]), size_of(r["place"])
                    part = t.stretch(at, at + size + window - 1)
                    if not r["hot"]:
                        put(r["key"], d, r["place"], part, 0)
                        continue
                    raw = np.frombuffer(part, np.uint8)
                    p = H.prefix(H.word_values(raw) if by_words else H.byte_values(raw))
                    for i, h in enumerate(_signed(H.mix(H.every(p, window))).tolist()):
                        put(h, d, int(place(v, at + i, 1)), None, 1)
                for n in blocks or []:
                    put(v, d, n, t.stretch(n * BLOCK[by_words], (n + 1) * BLOCK[by_words]), 2)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(where, pa.int64()), pa.array(context, pa.binary()), pa.array(kind, pa.int8())], names=["key", "doc", "place", "context", "kind"])

    return run


CUTS = "key long, doc long, place long, context binary, kind byte"


def by_key(settle: Callable[[list[int], list[int], list[int], list[bytes]], list[tuple[int, int]]], size: int):
    """Call settle(key, doc, place, context) on whole keys, about size bytes at a time; rows must come sorted by key."""

    def run(batches):
        held: list[list] = [[], [], [], []]
        n = 0
        out = lambda found: pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["doc", "place"])
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("key", "doc", "place", "context")), strict=True):
                if n >= size and row[0] != held[0][-1]:
                    yield out(settle(*held))
                    held, n = [[], [], [], []], 0
                for h, x in zip(held, row, strict=True):
                    h.append(x)
                n += len(row[3])
        if n:
            yield out(settle(*held))

    return run


def _variant(c: str):
    return F.shiftright(c, 42).cast("int")


def _wanted(claims: DataFrame, window: int, by_words: bool) -> DataFrame:
    """(doc, variant, rep_doc, rep_variant, block): the blocks of text that claims name, each once a document."""
    n = BLOCK[by_words]
    first = F.expr("(rep >> 10) & 4294967295")
    last = first + F.expr("rep & 1023") + (window - 2)
    block = F.explode(F.sequence(F.expr(f"((rep >> 10) & 4294967295) div {n}"), F.floor(last / n).cast("long"))).alias("block")
    return claims.select("doc", _variant("place").alias("variant"), "rep_doc", _variant("rep").alias("rep_variant"), block).distinct()


def _placed(rows: DataFrame, *columns: str) -> DataFrame:
    """rows collected per document: its claims or places, which its own length bounds."""
    value = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    return rows.groupBy("doc", _variant("place").alias("variant")).agg(F.collect_list(value).alias("found"))


def _joined(texts: Texts, *parts: tuple[DataFrame, str], how: str = "left") -> DataFrame:
    rows = texts.rows()
    for df, name in parts:
        rows = rows.join(df.withColumnRenamed("found", name), ["doc", "variant"], how)
    return rows


def _blocks(cuts: DataFrame) -> DataFrame:
    return cuts.where("kind = 2").select(F.col("doc").alias("rep_doc"), F.col("key").cast("int").alias("rep_variant"), F.col("place").alias("block"), "context")


def _extracted(texts: Texts, regions: DataFrame | None, wanted: DataFrame, window: int, by_words: bool) -> DataFrame:
    """Rows of _cuts for the documents that regions (doc, variant, found) or wanted name."""
    need = wanted.select(F.col("rep_doc").alias("doc"), F.col("rep_variant").alias("variant"), "block").distinct().groupBy("doc", "variant").agg(F.collect_list("block").alias("blocks"))
    if regions is None:
        both = need.withColumn("regions", F.lit(None).cast("array<struct<key:bigint,place:bigint,hot:boolean>>"))
    else:
        both = need.join(regions.withColumnRenamed("found", "regions"), ["doc", "variant"], "full")
    rows = texts.rows().join(both, ["doc", "variant"]).select("doc", "variant", "data", "regions", "blocks")
    return stored(in_arrow(rows, _cuts(window, by_words), CUTS), "cuts")


def cut(docs: DataFrame, window: int, k: int, by_words: bool, settle, size: int, confirm, finish, schema: str, bits: int = ALL_BITS) -> DataFrame:
    """(doc, variant, schema): finish(text, gone) of each document, gone: which of its tokens lie in windows that also start earlier
    (by words: in a document with a smaller doc).

    settle and size: see by_key. confirm(documents) gives, for each (doc, tokens, claims), the claims that
    hold and the places that they cover; a claim is (place, rep_doc, rep, text of rep).
    """
    texts = Texts(docs)
    found = candidates(docs, window, k, by_words, bits)
    claims = found.where("repeat = 1").select("doc", "place", "rep_doc", "rep")
    open_ = found.where("repeat = 0")
    # tables of their own, so that a join with them can split what a common key has
    hot = stored(open_.groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot")), "hot")
    regions = _placed(open_.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False))), "key", "place", "hot")
    wanted = stored(_wanted(claims, window, by_words), "wanted")
    cuts = _extracted(texts, regions, wanted, window, by_words)
    blocks = _blocks(cuts)
    cold = cuts.where("kind = 0").select("key", "doc", "place", "context").repartition("key").sortWithinPartitions("key", "doc", "place")
    places = in_arrow(cold, by_key(settle, size), "doc long, place long")
    single = cuts.where("kind = 1").select(F.col("key").alias("hash"), "doc", "place")
    if not single.isEmpty():
        least = stored(single.groupBy("hash").agg(F.min(F.struct("doc", "place")).alias("least"), F.count("*").alias("n")).where("n > 1"), "least")
        later = F.col("doc") > F.col("least.doc") if by_words else F.struct("doc", "place") > F.col("least")
        more = stored(single.join(least, "hash").where(later).select("doc", "place", F.col("least.doc").alias("rep_doc"), F.col("least.place").alias("rep")), "claims")
        also = _wanted(more, window, by_words)
        blocks = blocks.unionAll(_blocks(_extracted(texts, None, also, window, by_words))).dropDuplicates(["rep_doc", "rep_variant", "block"])
        wanted = wanted.unionAll(also).distinct()
        claims = claims.unionAll(more)
    brought = wanted.join(blocks, ["rep_doc", "rep_variant", "block"]).groupBy("doc", "variant").agg(F.collect_list(F.struct("rep_doc", "rep_variant", "block", "context")).alias("found"))
    claimed = _placed(claims, "place", "rep_doc", "rep")
    names = [c.split()[0] for c in schema.split(", ")]
    mask = np.uint64(bits)

    def run(batches):
        n = BLOCK[by_words]

        def whole(rows):
            """One row of results for each of rows (doc, variant, data, claims, blocks, places)."""
            asked, read = [], []
            for doc, _, data, claims, blocks, _ in rows:
                t = Tokens(unpack(data), by_words)
                held = {(x["rep_doc"], x["rep_variant"], x["block"]): x["context"] for x in blocks or []}
                named = []
                for c in sorted(claims or [], key=lambda c: c["place"]):
                    at, tokens = first_of(c["rep"]), size_of(c["rep"]) + window - 1
                    parts = [held[c["rep_doc"], c["rep"] >> 42, i] for i in range(at // n, (at + tokens - 1) // n + 1)]
                    named.append((c["place"], c["rep_doc"], c["rep"], parts))
                asked.append((doc, t, named))
                read.append(t)
            for (doc, variant, _, claims, _, places), t, (held, covered_) in zip(rows, read, confirm(asked), strict=True):
                failed = []
                for c in claims or []:
                    if c["place"] not in held:  # a collision: the key of its windows
                        part = np.frombuffer(t.stretch(first_of(c["place"]), first_of(c["place"]) + window), np.uint8)
                        p = H.prefix(H.word_values(part) if by_words else H.byte_values(part))
                        failed.append(int(_signed(H.mix(H.every(p, k)).min(keepdims=True) & mask)[0]))
                gone = covered([*covered_, *(places or [])], window, t.n)
                yield doc, variant, *finish(t, gone), failed

        for b in batches:
            rows = list(zip(*(b[c].to_pylist() for c in ("doc", "variant", "data", "claims", "blocks", "places")), strict=True))
            got = list(zip(*whole(rows), strict=True))
            kinds = [pa.int64(), pa.int32(), *(pa.string() if s.endswith("string") else pa.int64() for s in schema.split(", ")), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(got, kinds, strict=True)], names=["doc", "variant", *names, "failed"])

    def results(places: DataFrame) -> DataFrame:
        rows = _joined(texts, (claimed, "claims"), (brought, "blocks"), (_placed(places, "place"), "places"))
        return stored(in_arrow(rows.select("doc", "variant", "data", "claims", "blocks", "places"), run, f"doc long, variant int, {schema}, failed array<long>"), "cut")

    out = results(places)
    failed = out.select(F.explode("failed").alias("key"))
    if not failed.isEmpty():
        by_text = _by_text(docs, texts, failed.distinct(), window, k, by_words, bits)
        out = results(places.unionAll(by_text))
    return out.drop("failed")


def _by_text(docs: DataFrame, texts: Texts, keys: DataFrame, window: int, k: int, by_words: bool, bits: int) -> DataFrame:
    """(doc, place): windows of all regions of keys that also start earlier, by their text itself."""
    regions = in_arrow(docs, scan(window, k, by_words, bits, collapse=False), SCANNED).join(keys, "key", "left_semi")

    def run(batches):
        for b in batches:
            doc, where, text = [], [], []
            for d, v, data, regions in zip(*(b[c].to_pylist() for c in ("doc", "variant", "data", "regions")), strict=True):
                t = Tokens(unpack(data), by_words)
                for r in regions:
                    for at in range(first_of(r), first_of(r) + size_of(r)):
                        doc.append(d), where.append(int(place(v, at, 1)))
                        text.append(b" ".join(t.stretch(at, at + window).split()) if by_words else t.stretch(at, at + window))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(where, pa.int64()), pa.array(text, pa.binary())], names=["doc", "place", "text"])

    rows = texts.rows().join(_placed(regions, "place").withColumnRenamed("found", "regions"), ["doc", "variant"])
    every = stored(in_arrow(rows, run, "doc long, place long, text binary"), "windows")
    least = every.groupBy("text").agg(F.min(F.struct("doc", "place")).alias("least"))
    later = F.col("doc") > F.col("least.doc") if by_words else F.struct("doc", "place") > F.col("least")
    return stored(every.join(least, "text").where(later).select("doc", "place"), "places")


def covered(places: list[int], window: int, n: int) -> np.ndarray:
    """Which of n tokens lie in the windows at these places."""
    where = np.array(places, np.int64)
    first, size = first_of(where), size_of(where)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0
