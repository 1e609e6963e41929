"""Secret scans: patterns, and character Markov models of random strings and identifiers.

Two first-order character models, one of random strings and one of ordinary identifiers, are
trained from labelled samples; a long token whose log-likelihood ratio per character passes
the threshold that the samples give is a secret too. Samples are the strings of labelled documents:
what the base patterns find there is random, the words and identifiers of good ones are ordinary. As few
documents hold secrets, strings drawn as generators of keys draw them are random samples too.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm._util import in_arrow, read, stored, with_found

#: The base patterns, their least lengths and the group that is measured.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs of hex that are long enough
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = {"assign": 0, "access": 1, "hex": 2, "markov": 3}

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    out = []
    for kind, pattern, group, least in BASE:
        for m in (_HEX if kind == "hex" else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS[s[2]]))


CODE = {c: i + 1 for i, c in enumerate(ALPHABET)}
SIZE = len(ALPHABET) + 1
#: Width of a bin of scores, and how many there are on each side of zero.
BIN, BINS = 0.01, 1000


def pairs(s: str) -> tuple[list[int], list[int]]:
    """The characters of s that are in ALPHABET, each after the one before it (0: the start)."""
    codes = [0, *(CODE[c] for c in s if c in CODE)]
    return codes[:-1], codes[1:]


class Markov:
    """Log ratio of each pair of characters, random against ordinary, and the threshold per character."""

    def __init__(self, random_pairs: np.ndarray, ordinary_pairs: np.ndarray, threshold: float = float("inf")):
        logs = [np.log((c + 0.5) / (c + 0.5).sum(axis=1, keepdims=True)) for c in (random_pairs, ordinary_pairs)]
        self.ratio, self.threshold = logs[0] - logs[1], threshold

    def score(self, s: str) -> float:
        a, b = pairs(s)
        return float(self.ratio[a, b].sum()) / max(1, len(a))

    def spans(self, text: str, taken: list[Span]) -> list[Span]:
        """Tokens above the threshold that touch no span of taken, which is in order of start."""
        out, reach, i = [], 0, 0
        for m in TOKEN.finditer(text):
            while i < len(taken) and taken[i][0] < m.end():
                reach = max(reach, taken[i][1])
                i += 1
            if reach <= m.start() and self.score(m.group()) > self.threshold:
                out.append((m.start(), m.end(), "markov"))
        return out


def generated(n: int = 3000, seed: int = 11) -> list[str]:
    """Strings as generators of keys make them: hex, base 32, base 62 and base 64."""
    r = random.Random(seed)
    kinds = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:62], ALPHABET[:64])
    return ["".join(r.choice(kinds[i % 4]) for _ in range(r.randint(20, 48))) for i in range(n)]


def samples(text: str, good: bool) -> list[tuple[int, str]]:
    """(1, random string) for what the base patterns find; of a good document (0, ordinary string) too:
    its long words, and each three words in a row joined as identifiers are.
    """
    base = base_spans(text)
    out = []
    for start, end, kind in base:
        value = text[start:end]
        m = BASE[0][1].fullmatch(value) if kind == "assign" else None
        out.append((1, m[2] if m else value))
    if good:
        for start, end, _ in base:
            text = text[:start] + " " * (end - start) + text[end:]
        words = re.findall("[A-Za-z]+", text)
        out += [(0, w) for w in words if len(w) >= 8]
        for i in range(0, len(words) - 2, 3):
            part = words[i : i + 3]
            out.append((0, ("_".join(part).lower(), "-".join(part), "".join(x.title() for x in part), "_".join(part).upper() + str(i))[i // 3 % 4]))
    return out


def train(docs: DataFrame, labels: DataFrame, most_docs: int = 3000) -> Markov:
    """The models of labelled documents, whole.

    A classifier's sample: at most most_docs labelled doc_ids, the first by a hash. Pairs are counted and scores put into bins where the
    texts are, so the driver gets tables of fixed size. Where ordinary samples lack, no token passes.
    """
    chosen = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_good")).orderBy(F.xxhash64("_id"), "_id").limit(most_docs)
    rows = docs.select(F.col("doc_id").alias("_doc"), "text").join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).where("text is not null").select("text", (F.col("_good") == 1).alias("good"))
    rows = stored(rows, "samples")

    def count(batches):
        total = np.zeros((2, SIZE, SIZE), np.int64)
        for b in batches:
            for text, good in zip(b["text"].to_pylist(), b["good"].to_pylist(), strict=True):
                for kind, s in samples(text, good):
                    np.add.at(total[kind], pairs(s), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    def table(run, size: int) -> np.ndarray:
        out = np.zeros(size)
        for r in in_arrow(rows, run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            out[r["at"]] = r["n"]
        return out

    counted, drawn = table(count, 2 * SIZE * SIZE).reshape(2, SIZE, SIZE), generated()
    for x in drawn:
        np.add.at(counted[1], pairs(x), 1)
    model = Markov(counted[1], counted[0])

    def binned(batches):
        total = np.zeros((2, 2 * BINS + 1), np.int64)
        for b in batches:
            for text, good in zip(b["text"].to_pylist(), b["good"].to_pylist(), strict=True):
                for kind, s in samples(text, good):
                    total[kind, min(max(round(model.score(s) / BIN), -BINS), BINS) + BINS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    ordinary, random_ = table(binned, 2 * (2 * BINS + 1)).reshape(2, 2 * BINS + 1)
    for x in drawn:
        random_[min(max(round(model.score(x) / BIN), -BINS), BINS) + BINS] += 1
    if ordinary.sum():
        quantile = lambda n, q: (int(np.searchsorted(np.cumsum(n), q * n.sum())) - BINS) * BIN
        # between the classes: all but a thousandth of the ordinary strings stay below
        model.threshold = max(quantile(ordinary, 0.999), quantile(random_, 0.01) / 2)
    return model


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[Span], mask: str = "[REDACTED]") -> str:
    out, at = [], 0
    for s, e, _ in spans:
        if e > at:
            if s >= at:
                out += [text[at:s], mask]
            at = e
    return "".join(out) + text[at:]


def scan(docs: DataFrame, model: Markov, with_text: bool = True) -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256, spans and redacted (its text with spans masked).

    docs: text and any other columns, which stay (a column with one of these names is replaced).
    A null text is empty and stays null in redacted. Spans are code points, end exclusive. Each row is scanned by itself, whole,
    however long and whether or not another is like it. An empty table gives none.
    """

    def found(text: str | None) -> tuple:
        own = text or ""
        base = base_spans(own)
        every = sorted(base + model.spans(own, base), key=lambda s: (s[0], KINDS[s[2]]))
        n = [sum(1 for s in base if s[2] == k) for k in ("assign", "access", "hex")]
        return (*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), redact(own, every) if with_text and text is not None else None)

    return with_found(docs, SCHEMA, found)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return scan(docs.select("doc_id", "text"), model, with_text=False).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
