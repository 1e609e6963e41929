import hashlib
import random
import re
import struct

import xxhash

from helixtab.llm import imatch as I  # noqa: E741

SF = "/root/testdata/sf0.01"


def edits(docs):
    order = sorted(docs, reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        out[d] = (len(t), hashlib.sha256((t[: len(t) - k] + following[:k]).encode()).hexdigest())
    return out


def corpus():
    r = random.Random(12)
    words = ["w%d" % i for i in range(3000)]
    text = lambda: " ".join(r.choice(words) for _ in range(r.choice((3, 40, 300, 2500))))
    docs = [(i * 7, text()) for i in range(120)]
    return docs + [(1, None), (2, ""), (3, " \n"), (4, "🙂éA"), (5, docs[0][1]), (6, docs[0][1])]


def test_fingerprints(spark):
    docs = corpus()
    rows = I.compare_edits(spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, n int")).collect()
    want = edits(docs)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want and len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    assert by[5].fingerprint == by[6].fingerprint == by[0].fingerprint and by[6].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert all(len(r.fingerprint) == 16 + (I.SLOTS + I.OWN) * I.DIGITS for r in rows)
    texts = dict(docs)
    assert len({r.fingerprint for r in rows if texts[r.doc_id] and texts[r.doc_id].strip()}) == len({t for t in texts.values() if t and t.strip()})


def xx(*values):
    """XXH64 of values one after the other, as a signed long."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q" if kind_of(v) == "long" else "<i", int(v)), h)
    return h - (1 << 64) if h >> 63 else h


def kind_of(v):
    return "long" if isinstance(v, Long) else "int"


class Long(int):
    pass


def slow_print(text, kept):
    words = {w for w in re.split(r"[\x00-/:-`{-\x7f]+", text.lower()) if w}
    every = sorted(xx(w) for w in words)
    mine = [t for t in every if t in kept]
    subset = lambda terms: xx(*map(Long, terms)) % (1 << 16) if terms else -1
    hashes = []
    for seed, (parts, subsets) in enumerate(I.LEVELS):
        dealt = {}
        for t in mine:
            dealt.setdefault(xx(Long(t), seed) % parts, []).append(t)
        hashes += [subset(dealt.get(i, [])) for i in range(subsets)]
    short = not mine or len(every) <= I.SHORT
    hashes += [subset([t for t in every if t % I.OWN == i]) if short else -1 for i in range(I.OWN)]
    whole = xx(Long(xx(*map(Long, every)) if short else 0), *hashes)
    return whole, hashes


def slow_likeness(a, b):
    if a == b:
        return 1.0
    some = same = first = 0
    fits = False
    for _, subsets in (*I.LEVELS, (I.OWN, I.OWN)):
        pairs = [(x, y) for x, y in zip(a[1][first : first + subsets], b[1][first : first + subsets], strict=True) if x >= 0 or y >= 0]
        fits = fits or (len(pairs) <= 0.75 * subsets if first < I.SLOTS else bool(pairs))
        if fits:
            some, same = some + len(pairs), same + sum(x == y for x, y in pairs)
        first += subsets
    return same / some if some else 0.0


def test_prints_against_brute_force(spark):
    r = random.Random(4)
    words = ["w%d" % i for i in range(900)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice((2, 30, 90, 400))))) for i in range(60)] + [(60, "x " * 60_000), (61, "")]
    docs = sorted(docs, reverse=True)
    texts = [t for _, t in docs]
    edited = [t[: len(t) - len(t) // 3] + texts[(i + 1) % len(texts)][: len(t) // 3] for i, t in enumerate(texts)]
    df = {}
    for t in texts:
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1
    kept = {xx(w) for w, n in df.items() if n >= len(docs) * I.RAREST and n <= max(1.0, len(docs) * I.COMMONEST)}
    prints, edits_ = [slow_print(t, kept) for t in texts], [slow_print(t, kept) for t in edited]
    shown = lambda f: f"{f[0] % (1 << 64):016x}" + "".join("----" if h < 0 else f"{h:04x}" for h in f[1])
    got = {x.doc_id: x for x in I.compare_edits(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, (d, _) in enumerate(docs):
        assert got[d].fingerprint == shown(prints[i]) and got[d].edited_fingerprint == shown(edits_[i])
        assert abs(got[d].near_edited - slow_likeness(prints[i], edits_[i])) < 1e-9
        assert abs(got[d].near_next - slow_likeness(prints[i], prints[(i + 1) % len(docs)])) < 1e-9


def test_tells_edits_from_others(spark):
    rows = I.op1_document_fingerprints(spark, SF).where("n_chars > 300").collect()
    ahead = [r for r in rows if r.near_edited > r.near_next or r.near_next == 1]
    assert len(ahead) > 0.93 * len(rows)
    assert sum(r.near_edited for r in rows) / len(rows) > 0.3
    assert sum(r.near_next for r in rows if r.near_next < 1) / len(rows) < 0.1


def test_odd_tables(spark):
    kind = "doc_id long, text string"
    text = "some words that are here to be read"
    rows = I.compare_edits(spark.createDataFrame([(None, text), (2, text), (2, text), (2, "b c d"), (1, None)], kind)).collect()
    assert sorted((r.doc_id or 9, r.n_chars) for r in rows) == [(1, 0), (2, 5), (2, len(text)), (2, len(text)), (9, len(text))]
    same = {r.fingerprint for r in rows if r.n_chars == len(text)}
    assert len(same) == 1
    assert I.compare_edits(spark.createDataFrame([], kind)).count() == 0


def test_lexicon_takes_texts_apart_once(spark):
    """Spark adds conditions on what is exploded, and asks those on a term before terms are counted: either is work for every term of every text."""
    texts = spark.range(3).selectExpr("id doc", "concat('a b ', id) text")
    plan = I.lexicon(texts, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert "lambdafunction" not in plan[plan.index("Aggregate") :]
