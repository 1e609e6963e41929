"""Quality rules: Viterbi decoding of a linear-chain conditional random field over lines.

Each line of a text is content or boilerplate. Line features give emission scores, the chain
gives transition scores; the likeliest sequence of labels marks the lines, and the share of
words in content lines decides whether the document stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm import _hashes as H
from helixtab.llm import _words as W
from helixtab.llm._util import in_arrow, read, with_found

FEATURES = ("bias", "few words", "many words", "upper share", "symbol share", "marks a word", "bars", "digit share", "shouts", "sentence end", "repeated", "stutter")
#: Where training starts, and what it is drawn to a little: the scores (content minus boilerplate) of a plain reading of FEATURES.
PRIOR = np.array([1.5, -0.3, 0.3, -3.0, -6.0, -1.0, -4.0, -1.5, -3.0, 0.5, -2.0, -5.0])
PRIOR_STAY = 0.7

UPPER, LETTER, DIGIT, SYMBOL, MARK, BAR, SHOUT, SPACE, HEAD = (1 << i for i in range(9))
CLASS = np.zeros(256, np.int16)
for _c in range(256):
    _ch = chr(_c)
    CLASS[_c] = (
        UPPER * ("A" <= _ch <= "Z") | LETTER * (_ch.isascii() and _ch.isalpha() or _c >= 0xC0) | DIGIT * ("0" <= _ch <= "9") | SYMBOL * (_ch in "#*$%&|<>")
        | MARK * (_c < 128 and not _ch.isalnum() and not H.IS_SPACE[_c]) | BAR * (_ch == "|") | SHOUT * (_ch == "!") | SPACE * bool(H.IS_SPACE[_c]) | HEAD * ((_c & 0xC0) != 0x80)
    )


def line_features(data: np.ndarray, repeated: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines of UTF-8 data that ends with a line end; values: of its words."""
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    kind = CLASS[data]
    count = lambda bit: np.add.reduceat((kind & bit) != 0, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    upper, letter, digit, symbol, mark, bar, shout, space, head = (count(1 << i) for i in range(9))
    first, last = H.word_bounds(data)
    words = np.bincount(np.searchsorted(ends, first, "right"), minlength=len(ends))
    values = H.word_values(data) if values is None else values
    chars = np.maximum(1, head - space)
    line_of = np.searchsorted(ends, first, "right")
    again = np.concatenate(([False], (values[1:] == values[:-1]) & (line_of[1:] == line_of[:-1]))) if len(values) else np.zeros(0, bool)
    stutter = np.bincount(line_of[again], minlength=len(ends)) / np.maximum(1, words)
    tail = np.zeros(len(ends), bool)
    if len(last):
        line = np.searchsorted(ends, last - 1, "right")
        tail[line] = np.isin(data[last - 1], np.frombuffer(b".?:;\"')", np.uint8))  # the last word of a line wins
    w = np.maximum(1, words)
    x = np.stack([
        np.ones(len(ends)), words <= 3, words >= 12, upper / np.maximum(1, letter), symbol / chars, np.minimum(1, mark / w),
        np.minimum(1, bar / w), digit / chars, np.minimum(1, shout / w), tail, repeated, stutter,
    ], axis=1).astype(float)
    return x, words


def repeated_lines(text: str) -> np.ndarray:
    """For each \\n-split line, whether it has a word and equals an earlier line."""
    seen: set[str] = set()
    out = []
    for line in text.split("\n"):
        out.append(line in seen and not (line == "" or line.isspace() and not line.strip("\t\n\v\f\r ")))
        seen.add(line)
    return np.array(out)


def viterbi(emit: np.ndarray, stay: float) -> np.ndarray:
    """Labels (1: content) of a chain; emit: score of content over boilerplate; stay: score of two like labels in a row."""
    gain, from_other = np.zeros(2), np.zeros((len(emit), 2), np.int8)
    a = b = 0.0  # best scores that end in boilerplate, content
    for i, e in enumerate(emit.tolist()):
        if i:
            from_a, from_b = b > a + stay, a > b + stay
            from_other[i] = from_a, from_b
            a, b = (b if from_a else a + stay), (a if from_b else b + stay)
        b += e
    out = np.zeros(len(emit), np.int8)
    label = int(b >= a)
    for i in range(len(emit) - 1, -1, -1):
        out[i] = label
        if from_other[i, label]:
            label = 1 - label
    return out


class Crf:
    """Two labels; theta: weights of FEATURES, then the weight of staying with a label."""

    def __init__(self, theta: np.ndarray | None = None):
        self.theta = np.append(PRIOR, PRIOR_STAY) if theta is None else theta

    def fit(self, chains: list[tuple[np.ndarray, np.ndarray]], steps: int = 150, rate: float = 0.5, pull: float = 0.001) -> Crf:
        """Maximum likelihood with a normal prior around PRIOR, by gradient ascent; chains: (features, labels)."""
        if not chains:
            return self
        n, longest = len(chains), max(len(y) for _, y in chains)
        x = np.zeros((n, longest, len(FEATURES)))
        y, on = np.zeros((n, longest)), np.zeros((n, longest))
        for i, (f, labels) in enumerate(chains):
            x[i, : len(labels)], y[i, : len(labels)], on[i, : len(labels)] = f, labels, 1
        pair = on[:, 1:] * on[:, :-1]
        like = pair * (y[:, 1:] == y[:, :-1])
        prior, total = np.append(PRIOR, PRIOR_STAY), on.sum()
        step = np.zeros_like(self.theta)
        for _ in range(steps):
            emit, stay = x @ self.theta[:-1], self.theta[-1]
            move = np.array([[stay, 0], [0, stay]])
            fore, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            fore[:, 0, 1] = emit[:, 0]
            for t in range(1, longest):
                go = np.logaddexp.reduce(fore[:, t - 1, :, None] + move, axis=1)
                go[:, 1] += emit[:, t]
                fore[:, t] = np.where(on[:, t, None] > 0, go, fore[:, t - 1])
            for t in range(longest - 2, -1, -1):
                after = back[:, t + 1].copy()
                after[:, 1] += emit[:, t + 1]
                go = np.logaddexp.reduce(move + after[:, None, :], axis=2)
                back[:, t] = np.where(on[:, t + 1, None] > 0, go, 0)
            z = np.logaddexp.reduce(fore[:, -1], axis=1)
            content = np.exp(fore[:, :, 1] + back[:, :, 1] - z[:, None]) * on
            both = sum(np.exp(fore[:, :-1, k] + stay + (emit[:, 1:] if k else 0) + back[:, 1:, k] - z[:, None]) for k in (0, 1)) * pair
            slope = np.append(np.einsum("nt,ntf->f", (y - content) * on, x), (like - both).sum()) / total - pull * (self.theta - prior)
            step = 0.8 * step + slope
            self.theta = self.theta + rate * step
        return self

    def labels(self, features: np.ndarray) -> np.ndarray:
        return viterbi(features @ self.theta[:-1], self.theta[-1])


def train(docs: DataFrame, labels: DataFrame, most_docs: int = 1200, most_chains: int = 1500, stretch: int = 50) -> Crf:
    """Fit on labelled documents: lines of a good one are content, of a bad one boilerplate.

    A classifier's sample: at most most_docs labelled doc_ids, the first by a hash (half of them bad, if
    there are so many), of whose lines with words, cut into stretches of stretch lines, most_chains are drawn by a hash.
    Lines are read where the texts are; features of those stretches reach the driver.
    """
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_good"))
    chosen = None
    for quality in (0, 1):
        part = known.where(F.col("_good") == quality).orderBy(F.xxhash64("_id"), "_id").limit(most_docs // 2)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = docs.select(F.col("doc_id").alias("_doc"), "text").join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).where("text is not null").select(F.col("_doc").cast("string").alias("doc"), "text", "_good")

    def read_lines(batches):
        for b in batches:
            out = []
            for doc, text, good in zip(*(b[c].to_pylist() for c in ("doc", "text", "_good")), strict=True):
                x, words = line_features(np.frombuffer((text + "\n").encode(), np.uint8), repeated_lines(text))
                x = x[words > 0]
                out += [(xxhash.xxh64_intdigest(f"{doc}:{at}") >> 1, good, x[at : at + stretch].tobytes()) for at in range(0, len(x), stretch)]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["draw", "good", "features"])

    drawn = in_arrow(rows, read_lines, "draw long, good long, features binary").orderBy("draw", "good", "features").limit(most_chains).collect()
    chains = []
    for r in drawn:
        x = np.frombuffer(r.features).reshape(-1, len(FEATURES))
        chains.append((x, np.full(len(x), r.good)))
    return Crf().fit(chains)


BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
SCHEMA = f"{BASE}, content_share double, kept boolean"


def repeat_words(values: np.ndarray, data: np.ndarray, window: int = 5) -> int:
    """Words in windows of words that are found twice or more, the first included; values: hashes of the words of data.

    If no hash of a window comes twice, no window does. Else words and then windows are numbered by what they are, so hashes that collide don't count.
    """
    if len(values) <= window:
        return 0
    h = np.sort(H.mix(H.every(H.prefix(values), window)))
    if not (h[1:] == h[:-1]).any():
        return 0
    number = W.Dictionary(data, *H.word_bounds(data)).ids
    n = len(values) - window + 1
    name = number[:n]
    for k in range(1, window):
        name = np.unique(name * len(number) + number[k : k + n], return_inverse=True)[1]
    twice = np.bincount(name)[name] > 1
    edge = np.zeros(len(values) + 1, np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def judge(text: str, crf: Crf, least_share: float = 0.5) -> tuple:
    data = np.frombuffer((text + "\n").encode(), np.uint8)
    kind = CLASS[data]
    values = H.word_values(data)
    again = repeated_lines(text)
    n = len(values)
    repeats = repeat_words(values, data)
    failed = n < 10 or 100 * repeats > 20 * n
    x, words = line_features(data, again, values)
    own = words > 0
    share = float(words[own][crf.labels(x[own]) == 1].sum() / n) if n else 0.0
    chars = int(((kind & (HEAD | SPACE)) == HEAD).sum())
    return n, chars, int((kind & SYMBOL != 0).sum()), int(again.sum()), repeats, failed, share, not failed and share >= least_share


def assess(docs: DataFrame, crf: Crf) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept.

    docs: text and any other columns, which stay (a column with one of these names is replaced).
    A null or empty text has no words, fails and is not kept. Each row is judged by itself, whole, however long and
    whether or not another is like it. An empty table gives none.
    """
    return with_found(docs, SCHEMA, lambda text: judge(text or "", crf))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return assess(docs.select("doc_id", "text"), train(docs, read(spark, sf_dir, "labels")))
