"""LM scoring by cross-entropy difference.

A target model (documents labelled good) and a background model (all documents) of the same
order over one vocabulary, the bytes of UTF-8, matched in size: the background's counts are
scaled to the target's number of tokens. Each document is scored by its mean loss per token
under the target model less that under the background model: low is like the target.

Every n-gram is counted as it is, in tables. Texts are kept in blocks of bounded size; a block's own
n-grams, each once, are joined with the totals, and the block is scored with what came back. So a
task holds the n-grams of one block only, and the driver none.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm import _hashes as H
from helixtab.llm._repeats import unpack
from helixtab.llm._util import in_arrow, read, shared_dir, stored

#: Tokens in an n-gram (7 at most); weight of the shorter n-gram's estimate, in counts.
ORDER, WEIGHT = 5, 2.0
#: Bytes of text in a block, at least (but for a task's last one); bytes that are counted at once, and that are scored at once.
BLOCK, COUNTED, CHUNK = 32 << 20, 1 << 22, 1 << 17


def tokens_of(text: bytes, order: int = ORDER) -> np.ndarray:
    """The tokens, after order - 1 that stand for the start (byte 0)."""
    return np.concatenate((np.zeros(order - 1, np.uint64), np.frombuffer(text, np.uint8).astype(np.uint64)))


def grams(tokens: np.ndarray, order: int):
    """For n from 1 to order, the code of the n tokens that end at each place (n in the top byte)."""
    code = np.zeros(len(tokens), np.uint64)
    for n in range(1, order + 1):
        code[n - 1 :] |= tokens[: len(tokens) - n + 1] << np.uint64(8 * (n - 1))
        yield n, code | np.uint64(n << 56)


def blocked(docs: DataFrame, good: DataFrame | None = None) -> DataFrame:
    """(block, doc_id, good, data): texts, compressed, in a table dealt out by block; good: _id of the target's documents."""
    spark = docs.sparkSession

    def press(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([z.compress(t.as_buffer()) for t in b["text"]], pa.binary()), pa.array([len(t.as_buffer()) for t in b["text"]], pa.int64())], names=["doc_id", "data", "size"])

    def number(batches):
        first, size = TaskContext.get().partitionId() << 24, 0
        for b in batches:
            ends = size + np.cumsum(b["size"].to_numpy() + 1)
            yield pa.RecordBatch.from_arrays([pa.array(first + ends // BLOCK), b["doc_id"], b["good"], b["data"]], names=["block", "doc_id", "good", "data"])
            size = int(ends[-1]) if len(ends) else size

    rows = in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), press, "doc_id long, data binary, size long")
    if good is None:
        rows = rows.withColumn("good", F.lit(False))
    else:  # both sides are shuffled at every size: labels grow with documents
        rows = rows.join(good.withColumn("_good", F.lit(True)).hint("merge"), F.col("doc_id") == F.col("_id"), "left").withColumn("good", F.coalesce("_good", F.lit(False)))
    rows = in_arrow(rows.select("doc_id", "good", "data", "size"), number, "block long, doc_id long, good boolean, data binary")
    name = f"helixtab_blocks_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("compression", "none").option("path", f"{shared_dir(spark)}/helixtab/{name}")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name)
    return spark.table(name)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    code, target, background = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code, kind="stable")
    code = code[order]
    head = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    return code[head], np.add.reduceat(target[order], head), np.add.reduceat(background[order], head)


def _counted(texts: list[np.ndarray], good: list[bool], order: int) -> tuple[np.ndarray, ...]:
    """(code, target, background) of the n-grams that end in texts, given as tokens_of()."""
    lead = order - 1
    lengths = np.array([len(t) for t in texts])
    own = np.ones(lengths.sum(), bool)
    starts = np.cumsum(lengths) - lengths
    for i in range(lead):
        own[starts + i] = False
    mine = np.repeat(np.array(good, np.uint64), lengths)[own]
    parts = []
    for _, code in grams(np.concatenate(texts), order):
        marked = np.sort(code[own] << np.uint64(1) | mine)  # the order of n in the top byte keeps a bit free
        head = np.flatnonzero(np.concatenate(([True], marked[1:] != marked[:-1])))
        many = np.diff(np.concatenate((head, [len(marked)])))
        marked = marked[head]
        parts.append((marked >> np.uint64(1), np.where(marked & np.uint64(1), many, 0), many))
    return _merged(parts)


def counts(blocks: DataFrame, order: int = ORDER) -> DataFrame:
    """(block, gram, target, background): each block's n-grams and how often it has them; a block read by several tasks has a row of each."""

    def run(batches):
        parts, texts, good, size, now = [], [], [], 0, None

        def count():
            nonlocal texts, good, size
            if texts:
                parts.append(_counted(texts, good, order))
            texts, good, size = [], [], 0

        def out():
            count()
            if parts:
                code, target, background = _merged(parts)
                parts.clear()
                for i in range(0, len(code), 100_000):
                    s = slice(i, i + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code[s]), now, np.int64)), pa.array(code[s].view(np.int64)), pa.array(target[s].astype(np.int64)), pa.array(background[s].astype(np.int64))], names=["block", "gram", "target", "background"])

        for b in batches:
            for block, data, g in zip(b["block"].to_pylist(), b["data"], b["good"].to_pylist(), strict=True):
                if block != now:
                    yield from out()
                    now = block
                text = unpack(data.as_buffer())
                for at in range(0, len(text), COUNTED):  # a long text in pieces, each after the tokens before it
                    piece = tokens_of(text[:COUNTED], order) if not at else np.frombuffer(text[at - order + 1 : at + COUNTED], np.uint8).astype(np.uint64)
                    texts.append(piece), good.append(g)
                    size += len(piece)
                    if size >= COUNTED:
                        count()
        yield from out()

    rows = in_arrow(blocks.select("block", "data", "good"), run, "block long, gram long, target long, background long")
    return stored(rows, "grams")


class Models:
    """Both models: totals (gram, target, background), a table, and how many tokens each has."""

    def __init__(self, grams: DataFrame, order: int = ORDER):
        self.order = order
        self.totals = stored(grams.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background")), "totals")
        n = self.totals.where(F.shiftright("gram", 56) == 1).agg(F.sum("target"), F.sum("background")).first()
        self.target, self.background = n[0] or 0, n[1] or 0


class Index:
    """The place of each of codes, found through tables by hash; unlike codes of one slot move on to a further table."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.append(codes, np.uint64((1 << 64) - 1))  # what is not there has the last place
        self.levels = []
        rest = np.arange(len(codes), dtype=np.int32)
        while len(rest):
            shift = np.uint64(64 - max(8, int(4 * len(rest)).bit_length()))
            slot = (H.mix(codes[rest] + np.uint64(len(self.levels))) >> shift).astype(np.int64)
            table = np.full(1 << (64 - int(shift)), len(codes), np.int32)
            table[slot] = rest
            self.levels.append((shift, table))
            rest = rest[table[slot] != rest]

    def find(self, code: np.ndarray) -> np.ndarray:
        out = np.full(len(code), len(self.codes) - 1, np.int32)
        left = np.arange(len(code))
        for i, (shift, table) in enumerate(self.levels):
            asked = code[left]
            at = table[(H.mix(asked + np.uint64(i)) >> shift).astype(np.int64)]
            right = self.codes[at] == asked
            out[left[right]] = at[right]
            left = left[~right]
            if not len(left):
                break
        return out


class Block:
    """Both models for the texts of one block: its n-grams (sorted or not, repeats allowed) and their totals."""

    def __init__(self, codes: np.ndarray, target: np.ndarray, background: np.ndarray, totals: tuple[int, int], order: int):
        codes, first = np.unique(codes, return_index=True)
        self.order, self.index = order, Index(codes)
        scale = max(1, totals[0]) / max(1, totals[1])  # matched: as many tokens as the target has
        self.counts = [np.append(c[first].astype(float) * x, 0.0) for c, x in ((target, 1.0), (background, scale))]
        self.totals = totals[0], totals[1] * scale

    def losses(self, tokens: np.ndarray) -> list[np.ndarray]:
        """Loss in nats of each token from the order-th on: target's, background's."""
        lead = self.order - 1
        ps = [np.full(len(tokens) - lead, 1 / 256) for _ in range(2)]
        before: list[np.ndarray] = []
        for n, code in grams(tokens, self.order):
            at = self.index.find(code)
            seen = [c[at] for c in self.counts]
            for i in range(2):
                context = self.totals[i] if n == 1 else before[i][lead - 1 : -1]
                ps[i] = (np.minimum(seen[i][lead:], context) + WEIGHT * ps[i]) / (context + WEIGHT)
            before = seen
        return [-np.log(p) for p in ps]

    def sums(self, texts: list[bytes]) -> np.ndarray:
        """Each text's summed losses (target, background); about CHUNK bytes are scored at a time.

        A long text is scored in pieces, each after the tokens before it.
        """
        lead = self.order - 1
        got = np.zeros((2, len(texts)))
        held, whose, size = [], [], 0

        def flush():
            if held:
                lengths = np.array([len(h) for h in held])
                starts = np.cumsum(lengths) - lengths
                for row, loss in zip(got, self.losses(np.concatenate(held)), strict=True):
                    loss = np.concatenate((np.zeros(lead), loss))
                    for i in range(lead):
                        loss[starts + i] = 0
                    np.add.at(row, whose, np.add.reduceat(loss, starts))

        for i, text in enumerate(texts):
            tokens = tokens_of(text, self.order)
            for at in range(0, len(text), CHUNK):
                held.append(tokens[at : at + CHUNK + lead]), whose.append(i)
                size += len(held[-1])
                if size >= CHUNK:
                    flush()
                    held, whose, size = [], [], 0
        flush()
        return got


SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def score_blocks(blocks: DataFrame, grams: DataFrame, models: Models) -> DataFrame:
    """Scores of the documents of blocks, whose n-grams are grams."""
    # as often as a block asks, so a common n-gram has a row for each block: the join may split it
    asked = grams.select("block", "gram").join(models.totals.hint("merge"), "gram", "left").select("block", "gram", F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("background", F.lit(0)).alias("background"))
    totals, order = (models.target, models.background), models.order

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        code, target, background = (known[c].to_numpy() for c in ("gram", "target", "background"))
        model = Block(code.view(np.uint64), target, background, totals, order)
        out = []
        for b in docs.select(["doc_id", "data"]).to_batches(max_chunksize=256):
            texts = [unpack(d.as_buffer()) for d in b["data"]]
            n = np.array([len(t) for t in texts], np.int64)
            a, z = model.sums(texts) / np.maximum(1, n)
            out.append(pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n), pa.array(a), pa.array(z), pa.array(a - z)], names=[c.split()[0] for c in SCORES.split(", ")]))
        kinds = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_batches(out, kinds)

    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, SCORES)


def _good(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> Models:
    """Counts over all of docs; the target is every document that labels calls good (quality 1)."""
    return Models(counts(blocked(docs, _good(labels)), order), order)


def score(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score (their difference), means per token.

    docs: doc_id, text; other columns are ignored. A null or empty text has no tokens and
    scores 0. Each row counts, those that repeat a doc_id too. An empty table gives none. A very long
    text is counted and scored in pieces; it is a block of its own at most.
    """
    blocks = blocked(docs)
    return score_blocks(blocks, counts(blocks, models.order), models)


def scored(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on docs and score them, with one pass over the texts to count."""
    blocks = blocked(docs, _good(labels))
    grams = counts(blocks, order)
    return score_blocks(blocks, grams, Models(grams, order))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
