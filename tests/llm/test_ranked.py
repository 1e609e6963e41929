import math
import random
import re
from collections import Counter

import pytest

from helixtab.llm import ranked_search as R

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in t) for t in TERM.findall((text or "").encode())]


def slow(docs, items, most=50):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        rows = []
        for (doc, c), size in zip(counted, sizes, strict=True):
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    m = 50 + 50 * size * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                rows.append((-score, math.inf if doc is None else doc, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(rows, key=lambda r: r[:2])[:most])]
    return sorted(out, key=repr)


def corpus(seed, n=300):
    r = random.Random(seed)
    words = ["w%d" % int(r.paretovariate(0.8)) for _ in range(400)] + ["É", "ß"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    docs = [(i, text(r.choice((1, 5, 30, 30, 200)))) for i in range(n)]
    docs += [(None, docs[5][1]), (None, None), (n, ""), (n + 1, "?!"), *[(n + 2 + i, docs[7][1]) for i in range(80)], (7, docs[7][1])]
    r.shuffle(docs)
    items = [(1, text(8)), (2, docs[0][1]), (3, None), (4, ""), (5, "nowhere"), (6, "W1 w1 É"), (None, text(3)), (6, text(2)), (8, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("shard,docs_of,most,block", [(R.SHARD, R.DOCS, 50, R.ITEMS), (3000, R.DOCS, 10, 40), (R.SHARD, 17, 50, 100), (1, R.DOCS, 1, R.ITEMS)])
def test_against_brute_force(spark, shard, docs_of, most, block):
    docs, items = corpus(docs_of + most)
    d = spark.createDataFrame([(*x, "o", 1) for x in docs], "doc_id long, text string, shard string, item int").repartition(3)
    i = spark.createDataFrame([(*x, "o") for x in items], "item_id long, text string, rank string")
    index = R.build(d, shard, docs_of)
    got = R.search(index, i, most, block)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == slow(docs, items, most)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert R.ranked(docs.limit(0), items).collect() == []
    assert R.ranked(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in R.ranked(docs, items).collect()] == [(1, 1, 1)]


def test_long_text_in_pieces(spark):
    r = random.Random(3)
    long = " ".join("word%d" % r.randrange(30_000) for _ in range(1_000_000))  # 9 MB: three pieces
    docs, items = [(1, long), (2, "word1 word2"), (3, "word5")], [(1, "word1 word2 word5"), (2, "word7 word29999")]
    got = R.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == slow(docs, items)


def test_words_of_equal_hashes(spark):
    a, b = ("".join("ab"[(i.bit_count() + f) % 2] for i in range(1024)) for f in (0, 1))
    docs, items = [(1, a), (2, b), (3, f"{a} {b} c"), (4, "c")], [(1, a), (2, f"{b} c")]
    got = R.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == slow(docs, items)


def test_search_opens_few_ranges(monkeypatch):
    """One document has the rare term: its ranges alone are opened."""
    import numpy as np

    n = R.DOCS
    term = np.concatenate((np.zeros(n, np.int64), [1]))
    doc = np.append(np.arange(n), 777)
    value = np.append(np.full(n, 5), 1000)
    parts = R.tree(2, term, doc, value) | {"doc_id": np.arange(n), "none": np.zeros(n, bool)}
    opened, pop = [], R.heapq.heappop
    monkeypatch.setattr(R.heapq, "heappop", lambda h: (opened.append(1), pop(h))[1])
    best = []
    R.Shard(parts).search(np.array([0, 1]), np.array([1, 1]), best, 1, 1)
    assert best == [(1005, -777)] and len(opened) <= 5
