import random
import re

import duckdb

from helixtab.llm import license_scan as L

SF = "/root/testdata/sf0.001"


def pairs(text):
    w = re.sub("[^a-z0-9]+", " ", text.lower()).strip(" ").split(" ")
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def slow(text):
    hits = []
    own = pairs(text)
    for name, body in L.TEMPLATES:
        b = set(pairs(body))
        best = 0
        for at in range(len(own)):
            if own[at] in b:
                part = own[at : at + len(b)]
                both = len(set(part) & b)
                best = max(best, 2 * both / (sum(x not in b for x in part) + both + len(b)))
        if best >= L.LEAST:
            hits.append((-best, name))
    best = min(hits, default=(0, None))
    return best[1], -best[0] if hits else 0.0, ",".join(sorted({n for _, n in hits})), len(hits)


def texts():
    r = random.Random(2)
    prose = lambda n: " ".join("of the is hereby to any person word".split()[r.randrange(8)] for _ in range(n))
    out = [None, "", "\n\n", "of the and the", "a b " * 20000, "of the " * 20000, "word"]
    for name, body in L.TEMPLATES:
        w = body.split()
        out += [body, body.upper(), "prose before\n" + body + "\nprose after", prose(90) + "\n\n" + "\r\n \r\n".join(w[i] + " " + " ".join(w[i + 1 : i + 9]) for i in range(0, len(w), 9)) + "\n \ny " + prose(90)]
        out += ["Copyright 2020 Foo Inc. " + body + " All rights reserved.", " ".join(w[: int(0.75 * len(w))])]
        w = list(w)
        w[r.randrange(len(w))] = "other"
        out.append(" ".join(w))
    out.append(L.TEMPLATES[0][1] + "\n" + L.TEMPLATES[2][1] + "\n" + L.TEMPLATES[0][1])
    return out


def test_against_brute_force(spark):
    docs = list(enumerate(texts()))
    rows = L.scan(spark.createDataFrame([(i, t, 1, "q", 1) for i, t in docs], "doc_id long, text string, dice int, license string, k1 int")).collect()
    got = {r.doc_id: (r.license, r.dice, r.licenses, r.n_matches) for r in rows}
    assert len(rows) == len(docs)
    for i, t in docs:
        assert got[i] == slow(t or ""), t


def test_recall(spark):
    """Whole texts and notices in the midst of long documents."""
    docs = [(i, "some words before it " * 300 + "\n" + body.replace(". ", ".\n\n") + "\n" + "def f(x): return x " * 300) for i, (_, body) in enumerate(L.TEMPLATES)]
    got = {r.doc_id: r.licenses.split(",") for r in L.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(name in got[i] for i, (name, _) in enumerate(L.TEMPLATES))


def test_odd_tables(spark):
    kind = "doc_id long, text string"
    mit = "Released under the MIT License."
    third = " ".join(L.TEMPLATES[1][1].split()[:25]) + " " + "other words here " * 14
    rows = L.scan(spark.createDataFrame([(None, mit), (1, mit), (1, mit), (1, "none"), (2, third), (2, third), (2, third)], kind)).collect()
    shown = lambda t: (slow(t)[0] or "", slow(t)[1], slow(t)[3])
    want = [(0, *shown(mit)), (1, "", 0.0, 0), (1, *shown(mit)), (1, *shown(mit))] + [(2, *shown(third))] * 3
    assert sorted((r.doc_id or 0, r.license or "", r.dice, r.n_matches) for r in rows) == want
    assert L.scan(spark.createDataFrame([], kind)).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = sorted(map(tuple, L.op3_license_scan(spark, SF).collect()), key=str)
    assert got == sorted(con.sql(L.OP3_SQL).fetchall(), key=str)
    assert any(r[1] for r in got)
