import math
from collections import Counter

import numpy as np
import pytest

from helixtab.llm import lm_scoring as M

SF = "/root/testdata/sf0.01"


def slow_losses(docs, good, text, order):
    """The same models over dictionaries."""
    counts = {True: Counter(), False: Counter()}
    for (_, t), g in zip(docs, good, strict=True):
        data = b"\0" * (order - 1) + (t or "").encode()
        for end in range(order - 1, len(data)):
            for n in range(1, order + 1):
                gram = data[end - n + 1 : end + 1]
                counts[False][n, gram] += 1
                if g:
                    counts[True][n, gram] += 1
    size = {k: sum(v for (n, _), v in c.items() if n == 1) for k, c in counts.items()}
    scale = {True: 1.0, False: size[True] / size[False]}
    out = []
    for name in (True, False):
        data = b"\0" * (order - 1) + text.encode()
        loss = 0.0
        for end in range(order - 1, len(data)):
            p = 1 / 256
            for n in range(1, order + 1):
                seen = counts[name][n, data[end - n + 1 : end + 1]] * scale[name]
                context = (size[name] if n == 1 else counts[name][n - 1, data[end - n + 1 : end]]) * scale[name]
                p = (min(seen, context) + M.WEIGHT * p) / (context + M.WEIGHT)
            loss -= math.log(p)
        out.append(loss / max(1, len(text.encode())))
    return out


DOCS = [(1, "the cat sat on the mat"), (2, "éa èb " * 30), (3, None), (4, ""), (5, "THE CAT!! " * 20), (6, "a"), (7, "the dog sat on the log"), (None, "no id")]
GOOD = [True, False, False, True, False, False, True, False]


@pytest.mark.parametrize("order,block,counted,chunk", [(2, 1 << 25, 1 << 22, 1 << 17), (3, 40, 7, 5), (5, 1 << 25, 1 << 22, 1 << 17), (5, 100, 50, 64)])
def test_against_brute_force(spark, order, block, counted, chunk, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "COUNTED", counted)
    monkeypatch.setattr(M, "CHUNK", chunk)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id long, text string, score string, good int")
    labels = spark.createDataFrame([(i, int(g)) for (i, _), g in zip(DOCS, GOOD, strict=True)], "doc_id long, quality int")
    for rows in (M.scored(df, labels, order), M.score(df, M.train(df, labels, order))):
        got = {r.doc_id: r for r in rows.collect()}
        assert len(got) == len(DOCS)
        for i, t in DOCS:
            want = slow_losses(DOCS, GOOD, t or "", order)
            assert got[i].n_tokens == len((t or "").encode())
            assert got[i].target_loss == pytest.approx(want[0], rel=1e-6) and got[i].background_loss == pytest.approx(want[1], rel=1e-6)
            assert got[i].score == pytest.approx(want[0] - want[1], abs=1e-6)


def test_texts_that_were_not_counted(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (7, 1)], "doc_id long, quality int")
    text = "a bird sat on zzz " * 9_000  # over 100 KB
    row = M.score(spark.createDataFrame([(9, text)], "doc_id long, text string"), M.train(df, labels)).first()
    want = slow_losses(DOCS, [i in (1, 7) for i, _ in DOCS], text, M.ORDER)
    assert row.score == pytest.approx(want[0] - want[1], abs=1e-6)


def test_index():
    r = np.random.default_rng(1)
    codes = np.unique(r.integers(0, 1 << 40, 50_000, dtype=np.uint64))
    index = M.Index(codes)
    asked = np.concatenate((codes, codes + np.uint64(1)))
    at = index.find(asked)
    known = np.isin(asked, codes)
    assert (index.codes[at[known]] == asked[known]).all() and (at[~known] == len(codes)).all()


def test_tells_bad_from_good(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scores = M.score(docs, M.train(docs, labels.where("doc_id % 2 = 0"))).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.score for r in scores if r.quality == q] for q in (1, 0))
    ahead = sum(g < b for g in good for b in bad) / (len(good) * len(bad))
    assert ahead > 0.9


def test_odd_tables(spark):
    kind = "doc_id long, text string"
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (9, None)], "doc_id long, quality int")
    for rows in ([], [(None, None), (1, "a"), (1, "a"), (2, "")]):
        docs = spark.createDataFrame(rows, kind)
        out = M.score(docs, M.train(docs, labels)).collect()
        assert len(out) == len(rows) and all(math.isfinite(r.score) for r in out)
