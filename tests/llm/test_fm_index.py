import random
import re

import numpy as np
import pytest

from helixtab.llm import _words as W
from helixtab.llm import fm_index as X

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def slow(docs, items, size=10):
    """(doc_id, n_words, hit words, item names) by comparing all windows."""
    windows = []
    for name, text in items:
        w = TERM.findall(lower(text))
        windows += [(tuple(w[i : i + size]), "null" if name is None else str(name)) for i in range(max(1, len(w) - size + 1)) if w]
    out = []
    for doc_id, text in docs:
        w = TERM.findall(lower(text))
        hit, names = set(), set()
        for window, name in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names.add(name)
        out.append((doc_id, len(w), tuple(sorted(hit)), tuple(sorted(names))))
    return sorted(out, key=repr)


def thue_morse(n, flip=False):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def corpus(r, n):
    words = ["w%d" % i for i in range(12)] + ["É", "ß9", "x" * 70]
    text = lambda k: r.choice((" ", ", ", "\n")).join(r.choice(words) for _ in range(k))
    docs = [(i, text(r.choice((0, 3, 12, 60)))) for i in range(n)]
    docs += [(0, docs[1][1]), (0, docs[1][1]), (None, docs[2][1]), (n, None), (n + 1, ""), (n + 2, " !! "), (n + 3, text(900))]
    items = [(1, text(4)), (2, text(11)), (2, text(10)), (3, None), (4, "..."), (None, "W1"), (5, docs[3][1]), (6, docs[-1][1][300:900]), (7, docs[-1][1][300:900].upper())]
    return docs, items


def found(rows):
    return sorted(((r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r["items"])) for r in rows), key=repr)


@pytest.mark.parametrize("size,shard,most", [(10, 1 << 20, 1 << 20), (3, 200, 300), (10, 500, 1 << 20)])
def test_against_brute_force(spark, size, shard, most):
    docs, items = corpus(random.Random(size), 40)
    d = spark.createDataFrame([(*x, "other", 7) for x in docs], "doc_id long, text string, row string, start int")
    i = spark.createDataFrame([(*x, "other") for x in items], "item_id long, text string, spans string")
    got = X.contamination(d, i, size, shard, most).collect()
    assert found(got) == slow(docs, items, size)
    for r in got:  # spans of a row don't touch
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert X.contamination(docs.limit(0), items).collect() == []
    (row,) = X.contamination(docs, items.limit(0)).collect()
    assert (row.doc_id, row.n_words, row.spans, row["items"]) == (1, 3, [], [])


def test_words_of_equal_hashes(spark):
    a, b = thue_morse(1024), thue_morse(1024, True)
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    start, end = W.bounds(data)
    assert len(set(W.hashes(data, start, end).tolist())) == 1  # the fast hash can't tell them apart
    docs = [(1, f"{a} x {b} y"), (2, f"{b} x {a} y"), (3, f"{a} x {a} y")]
    items = [(1, f"{a} x {b}"), (2, f"{b} y"), (3, b)]
    got = X.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got.collect()) == slow(docs, items)


def test_dictionary_shared_between_texts_with_collisions():
    a, b = thue_morse(1024), thue_morse(1024, True)
    data = np.frombuffer(a.encode(), np.uint8)
    known = W.Dictionary(data, *W.bounds(data)).packed()
    asked = np.frombuffer(f"{b} {a}".encode(), np.uint8)
    assert W.find(known, asked, *W.bounds(asked)).tolist() == [-1, 0]


def test_suffixes_and_index():
    r = np.random.default_rng(1)
    for _ in range(60):
        lengths = r.integers(0, 40, r.integers(1, 5))
        ids = r.integers(0, 3, lengths.sum())
        data = np.frombuffer(b" ".join(b"abc"[i : i + 1] for i in ids), np.uint8)
        known = W.Dictionary(data, *W.bounds(data))
        index = X.FmIndex(W.from_bytes(W.to_bytes(**X.FmIndex.of(known.ids, lengths, known).parts)))
        text, at = [], 0
        for n in lengths:
            text += [*(known.ids[at : at + n] + 1).tolist(), 0]
            at += n
        for pattern in ([1], [1, 2], [2, 1, 1], [3, 3]):
            if max(pattern) <= len(known):
                low, high = index.search(np.array([pattern]), np.array([len(pattern)]))
                places = sorted(index.locate(np.arange(low[0], high[0])).tolist())
                assert places == [i for i in range(len(text)) if text[i : i + len(pattern)] == pattern]


def test_long_text(spark):
    r = random.Random(5)
    words = ["word%d" % r.randrange(4000) for _ in range(300_000)]  # several shards
    item = " ".join(words[150_000:150_020])
    docs = [(1, " ".join(words)), (2, "short"), (3, item + " and more")]
    got = {x.doc_id: x for x in X.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"), shard=1 << 19).collect()}
    assert got[1].n_words == 300_000 and [(s.start, s.end) for s in got[1].spans] == [(150_000, 150_020)]
    assert [(s.start, s.end) for s in got[3].spans] == [(0, 20)] and not got[2].spans


def test_cleaned(spark):
    docs = spark.createDataFrame([(1, "Keep, one two three (four) end", "a"), (2, None, "b"), (3, "all fine", "c")], "doc_id long, text string, _spans string")
    items = spark.createDataFrame([(1, "one two THREE four")], "item_id long, text string")
    out = X.cleaned(docs, X.contamination(docs, items))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "Keep, ) end", "a"), (2, None, "b"), (3, "all fine", "c")]
