import itertools
import random
import re

import numpy as np

from helixtab.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"


def slow_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {x for x in wins if wins.count(x) > 1} if len(wins) < 3000 else {k for k, g in itertools.groupby(sorted(wins)) if len(list(g)) > 1}
    words = {i + j for i, x in enumerate(wins) if x in twice for j in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(words), len(w) < 10 or 100 * len(words) > 20 * len(w)


def texts():
    r = random.Random(6)
    words = ["the", "éa", "A&B", "x|", "語", "##", "WORD!!", " ", "\x1c"]
    out = [None, "", "\n\n \n \n", "a\n\na\na b\n", "\r\n\r\n", "\x85\n\x85", "a b c d e " * 4000, "a b c d e"]
    return out + [("".join(r.choice(words) + r.choice((" ", "\n", "  ", "\t")) for _ in range(r.randint(0, 200)))) for _ in range(100)]


def test_base(spark):
    kind = "doc_id long, text string, kept int, n_words string, source string"
    docs = [(i, t, 1, "x", None) for i, t in enumerate(texts())]
    rows = {r.doc_id: r for r in Q.assess(spark.createDataFrame([*docs, (None, None, None, None, None)], kind), Q.Crf()).collect()}
    for i, t in enumerate(texts()):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow_base(t), t
        assert not (r.base_failed and r.kept)
    assert rows[None].kept is False
    assert Q.assess(spark.createDataFrame([], kind), Q.Crf()).count() == 0


def test_viterbi_is_the_best_of_all():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        for _ in range(20):
            emit, stay = r.normal(size=n), float(r.normal())
            score = lambda y: sum(e for e, l in zip(emit, y) if l) + stay * sum(a == b for a, b in itertools.pairwise(y))  # noqa: B023, E731, E741
            best = max(map(score, itertools.product((0, 1), repeat=n)))
            assert abs(score(Q.viterbi(emit, stay).tolist()) - best) < 1e-9


def test_fit_raises_likelihood():
    r = np.random.default_rng(4)
    chains = []
    for _ in range(60):
        y = np.repeat(r.integers(0, 2, 4), 3)
        x = np.zeros((12, len(Q.FEATURES)))
        x[:, 0], x[:, 9] = 1, np.where(r.random(12) < 0.85, y, 1 - y)
        chains.append((x, y))

    def likelihood(theta):
        total = 0.0
        for x, y in chains:
            e, stay = x @ theta[:-1], theta[-1]
            f = np.array([0.0, e[0]])
            for t in range(1, len(y)):
                f = np.array([np.logaddexp(f[0] + stay, f[1]), np.logaddexp(f[1] + stay, f[0]) + e[t]])
            total += sum(e[y == 1]) + stay * (y[1:] == y[:-1]).sum() - np.logaddexp(*f)
        return total

    before = Q.Crf()
    after = Q.Crf().fit(chains, pull=0.001)
    assert likelihood(after.theta) > likelihood(before.theta)
    assert sum((after.labels(x) == y).mean() for x, y in chains) / 60 > 0.8


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    even, odd = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = Q.assess(docs, Q.train(docs, even)).join(odd, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in out if r.quality == 1]
    bad = [r.kept for r in out if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / max(1, len(bad)) < 0.15


def test_windows_of_equal_hashes():
    """Two unlike words of one polynomial hash: windows that differ only there aren't repeats."""
    a, b = ("".join("ab"[(i.bit_count() + f) % 2] for i in range(1024)) for f in (0, 1))
    rest = " ".join("w%d" % i for i in range(40))
    for text in (f"one two {a} three four {rest} one two {b} three four", f"one two {a} three four {rest} one two {a} three four", f"{a} " * 7 + f"{b} " * 7):
        assert Q.judge(text, Q.Crf())[:6] == slow_base(text)
