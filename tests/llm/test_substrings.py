import hashlib
import random
import re

import pytest

from helixtab.llm import _repeats, substring_dedup, suffix_dedup


def by_words(docs, window):
    split = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in docs]
    first = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def by_bytes(docs, window):
    first = {}
    data = [(i, (t or "").encode()) for i, t in sorted(docs)]
    for i, t in data:
        for s in range(len(t) - window + 1):
            first.setdefault(t[s : s + window], (i, s))
    out = {}
    for i, t in data:
        gone = set()
        for s in range(len(t) - window + 1):
            if first[t[s : s + window]] < (i, s):
                gone |= set(range(s, s + window))
        spans = sum(1 for j in gone if j - 1 not in gone)
        kept = bytes(x for j, x in enumerate(t) if j not in gone)
        out[i] = (len(t), len(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    r = random.Random(5)
    words = ["w%d" % i for i in range(400)] + ["é%d" % i for i in range(50)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    common = [prose(70) for _ in range(4)]
    docs = [(0, None), (1, ""), (2, "one"), (3, "a " * 300), (4, "a " * 400), (5, "x" * 1500), (6, " \n\t ")]
    docs += [(90 + i, prose(5) + " " + (prose(n) + "; ") * times + prose(5)) for i, (n, times) in enumerate(((1, 40), (3, 20), (4, 9), (7, 6), (9, 4), (12, 3), (16, 2)))]
    template = prose(200)
    for i in range(7, 90):
        kind = r.random()
        if kind < 0.2:
            t = template if r.random() < 0.5 else template.replace(r.choice(words), "zz", 1)
        elif kind < 0.6:
            t = prose(r.randint(0, 80)) + " " + r.choice(common) + "\n" + prose(r.randint(0, 80))
            if r.random() < 0.4:
                t += "  " + r.choice(common) + " " + r.choice(common)[:300]
        else:
            t = prose(r.randint(0, 200))
        docs.append((i, t))
    r.shuffle(docs)
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


def got(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("window,hot", [(50, 2000), (20, 2000), (20, 2)])
def test_words(spark, docs, window, hot, monkeypatch):
    monkeypatch.setattr(_repeats, "HOT", hot)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("x", "y")
    assert got(substring_dedup.dedup(df, window), "n_words", "n_removed", "kept_sha256") == by_words(docs, window)


@pytest.mark.parametrize("window,hot", [(100, 2000), (40, 2000), (40, 2)])
def test_bytes(spark, docs, window, hot, monkeypatch):
    monkeypatch.setattr(_repeats, "HOT", hot)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(suffix_dedup.dedup(df, window), "n_bytes", "n_removed", "n_spans", "kept_sha256") == by_bytes(docs, window)


@pytest.mark.parametrize("hot", [2000, 2])
def test_collisions(spark, docs, hot, monkeypatch):
    """Routing hashes of three bits: nearly all keys and regions collide, results stay."""
    monkeypatch.setattr(_repeats, "HOT", hot)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(substring_dedup.dedup(df, 20, hash_bits=7), "n_words", "n_removed", "kept_sha256") == by_words(docs, 20)
    assert got(suffix_dedup.dedup(df, 40, hash_bits=7), "n_bytes", "n_removed", "n_spans", "kept_sha256") == by_bytes(docs, 40)


def test_long_texts(spark):
    """Two texts of over 100 KB that share most, and a third as a hot word."""
    r = random.Random(3)
    body = " ".join("w%d" % r.randrange(3000) for _ in range(25_000))
    docs = [(1, body), (2, "start " + body[:60_000] + " middle " + body[60_000:]), (3, "x " * 70_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(substring_dedup.dedup(df), "n_words", "n_removed", "kept_sha256") == by_words(docs, 50)
    assert got(suffix_dedup.dedup(df), "n_bytes", "n_removed", "n_spans", "kept_sha256") == by_bytes(docs, 100)


def test_pieces(spark, docs, monkeypatch):
    """A text longer than a piece."""
    monkeypatch.setattr(_repeats, "PIECE", 300)
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = df.selectExpr("doc_id doc", "0 variant", "coalesce(text, '') text")
    for words, window, k in ((True, 20, 8), (False, 60, 20)):
        run = _repeats.scan(window, k, words)
        import pyarrow as pa

        batch = pa.RecordBatch.from_pandas(rows.toPandas(), preserve_index=False)
        seen = set()
        for b in run(iter([batch])):
            for doc, place in zip(b["doc"].to_pylist(), b["place"].to_pylist(), strict=True):
                new = {(doc, s) for s in range((place >> 10) & 0xFFFFFFFF, ((place >> 10) & 0xFFFFFFFF) + (place & 1023))}
                assert not new & seen
                seen |= new
        n = lambda t: len((t or "").split(None)) if words else len((t or "").encode())
        assert len(seen) == sum(max(0, n(t) - window + 1) for _, t in docs)


def test_odd_tables(spark, docs):
    kind = "doc_id long, text string, doc int, place string"
    text = " ".join(map(str, range(60)))
    odd = spark.createDataFrame([(None, text, 1, "a"), (3, text, 1, "a"), (3, text, 1, "b"), (3, text + " x", 2, None), (4, None, None, None)], kind)
    rows = sorted((r.doc_id or 99, r.n_words, r.n_removed) for r in substring_dedup.dedup(odd).collect())
    assert rows == [(3, 60, 0), (3, 60, 0), (3, 61, 0), (4, 0, 0), (99, 60, 60)]
    rows = sorted((r.doc_id or 99, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(odd).collect())
    n = len(text)
    assert rows == [(3, n, 0), (3, n, 0), (3, n + 2, n), (4, 0, 0), (99, n, n)]
    none = spark.createDataFrame([], kind)
    assert substring_dedup.dedup(none).count() == suffix_dedup.dedup(none).count() == 0


def test_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    for query, sql in ((substring_dedup.op4_substring_dedup, substring_dedup.OP4_SQL), (suffix_dedup.op5_suffix_array_dedup, suffix_dedup.OP5_SQL)):
        got = sorted(map(tuple, query(spark, sf).collect()))
        assert got == sorted(con.sql(sql).fetchall()) and any(r[2] for r in got)
