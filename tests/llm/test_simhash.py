import os
import random
import re
from collections import defaultdict

import pytest
import xxhash

from helixtab.llm import simhash_dedup as S


def slow_fp(text, size=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    sh = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, distance):
    label = {i: i for i in fps}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in fps}


def texts():
    r = random.Random(3)
    words = ["Word%d" % i for i in range(90)] + ["É", "ß", "ſ"]
    base = [" ".join(r.choice(words) for _ in range(r.choice((30, 150, 400)))) for _ in range(12)]
    out = [None, "", " \n", "One", "one two", "ONE TWO"]
    for _ in range(150):
        t = r.choice(base).split(" ")
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = r.choice(words)
        out.append(r.choice((" ", "\n")).join(t))
    return list(enumerate(out))


@pytest.mark.parametrize("distance,busy", [(2, 24), (2, 2), (1, 2), (3, 24)])
def test_against_brute_force(spark, monkeypatch, distance, busy):
    monkeypatch.setattr(S, "BUSY", busy)
    docs = texts()
    fps = {i: slow_fp(t) for i, t in docs}
    want = slow_components(fps, distance)
    got = S.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), distance=distance).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(got) == len(docs)


def test_long_texts(monkeypatch):
    monkeypatch.setattr(S, "LONG", 64)
    for _, t in texts():
        assert S.simhash((t or "").encode()) & (1 << 64) - 1 == slow_fp(t)


@pytest.mark.parametrize("busy", [24, 1])
def test_random_bits(spark, monkeypatch, busy):
    monkeypatch.setattr(S, "BUSY", busy)
    r = random.Random(9)
    centre = [r.getrandbits(64) for _ in range(4)]
    fps = set(centre)
    for _ in range(300):
        x = r.choice(sorted(fps))
        for _ in range(r.randint(1, 4)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    by = dict(enumerate(sorted(fps)))
    want = slow_components(by, 2)
    found = S.components(S.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    root = {r.a: r.b for r in found}
    groups = lambda name: sorted(sorted(i for i in by if name(i) == g) for g in {name(i) for i in by})
    assert groups(lambda i: want[i]) == groups(lambda i: root.get(signed[i], signed[i]))


def test_odd_tables(spark):
    kind = "doc_id long, text string, fp string, component_id int"
    rows = S.near_duplicates(spark.createDataFrame([(None, "a", "x", 1), (7, "a", "x", 1), (7, "a", "x", 1), (5, None, None, None)], kind)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows) == [(-1, 7), (5, 5), (7, 7), (7, 7)]
    assert S.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_one_row_of_each_component_stays(spark):
    r = random.Random(4)
    prose = [" ".join(r.choice("abcdefghij") * r.randint(2, 9) for _ in range(60)) for _ in range(6)]
    a, b, c, d, e, f = prose
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "x"), (7, c, "x"), (7, d, "x"), (3, c, "x"), (None, c, "x"), (5, e, "y"), (5, e, "x"), (7, None, "x"), (7, "x", None), (None, f, None), (9, f, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, S.deduplicated(docs).collect()), key=str)
    assert [t for i, t, _ in got if i is None] == sorted([a, b]) and sorted(str(t) for i, t, _ in got if i == 7) == sorted(["None", d, "x"])
    assert {(i, t) for i, t, _ in got if i in (3, 5, 9)} == {(3, c), (5, e), (9, f)} and len(got) == 8
    assert got == sorted(map(tuple, S.deduplicated(docs.repartition(5)).collect()), key=str)


def shingles(text, size=5):
    w = text.encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def grouped(fps, distance, pairs):
    """Sets of ids linked by fingerprint or in pairs."""
    ids = list(fps)
    above = {i: i for i in ids}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    near = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if ((fps[a] ^ fps[b]) & ((1 << 64) - 1)).bit_count() <= distance]
    for a, b in [*near, *pairs]:
        above[root(a)] = root(b)
    out = {}
    for i in ids:
        out.setdefault(root(i), set()).add(i)
    return list(out.values())


def test_recall_by_similarity(spark):
    """Pairs of texts by the similarity of their five-word shingles, and unlike ones with a common passage."""
    r = random.Random(8)
    words = ["w%d" % i for i in range(4000)]
    docs, share = [], {}
    for k in (2, 4, 6, 8, 9, 30, 60):
        for i in range(50):
            a = [r.choice(words) for _ in range(400)]
            b = list(a)
            for at in r.sample(range(5, 395, 6), k):
                b[at] = "zz%d" % r.randrange(10**9)
            x, y = shingles(" ".join(a)), shingles(" ".join(b))
            share[len(docs) + 1] = len(x & y) / len(x | y)
            docs += [(len(docs), " ".join(a)), (len(docs) + 1, " ".join(b))]
    kept = {x.doc_id for x in S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(i in kept for i in range(0, len(docs), 2))
    for low, high in ((0.94, 1), (0.89, 0.94), (0.84, 0.89), (0.8, 0.84), (0.75, 0.8), (0, 0.6)):
        own = [i not in kept for i, x in share.items() if low <= x < high]
        print(f"similarity {low} to {high}: {sum(own)} of {len(own)} found")
        assert sum(own) >= 0.9 * len(own) if low >= 0.8 else high > 0.6 or not any(own)


@pytest.mark.parametrize("block", [45, 60])
def test_components_at_the_similarity(spark, block):
    """300 relatives of one text, each with a twin: only what reaches 0.8 exactly is linked, though many pairs come near it in large bands."""
    r = random.Random(11)
    word = lambda: "w%d" % r.randrange(10**6)
    base = [word() for _ in range(400)]
    docs = []
    for _ in range(300):
        t = list(base)
        at = r.randrange(400 - block)
        t[at : at + block] = [word() for _ in range(block)]
        twin = list(t)
        at = r.randrange(380)
        twin[at : at + 20] = [word() for _ in range(20)]
        docs += [(len(docs), " ".join(t)), (len(docs) + 1, " ".join(twin))]
    sets = {i: shingles(t) for i, t in docs}
    pairs = [(a, b) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    want = grouped({i: slow_fp(t) for i, t in docs}, 2, pairs)
    kept = {x.doc_id for x in S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    least = {min(g) for g in want}
    assert least <= kept  # nothing goes without a chain of links
    assert len(kept - least) <= 0.02 * len(want), (len(kept), len(want))


@pytest.mark.parametrize("busy,centres", [(24, 16), (2, 2)])
def test_centres_leave_no_two_alike(spark, monkeypatch, busy, centres):
    """A hot group: many near copies of one text, and copies with other ends that share only bands."""
    monkeypatch.setattr(S, "BUSY", busy)
    monkeypatch.setattr(S, "CENTRES", centres)
    r = random.Random(9)
    base = ["w%d" % r.randrange(3000) for _ in range(300)]
    docs = []
    for i in range(120):
        t = list(base)
        t[r.randrange(300)] = "x%d" % i
        docs.append((i, " ".join(t if i % 3 else t[:150] + ["y%d_%d" % (i % 2, j) for j in range(100)])))
    kept = S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    sets = [shingles(x.text) for x in kept]
    assert all(len(a & b) / len(a | b) < 0.8 for n, a in enumerate(sets) for b in sets[n + 1 :]) and len(kept) == 3


def left(docs, similarity):
    """By brute force: the ids that stay."""
    sets = {i: shingles(t) for i, t in docs}
    enough = lambda x, y: 10 * len(x & y) >= round(10 * similarity) * len(x | y)
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and enough(sets[a], sets[b])]
    return {min(g) for g in grouped({i: slow_fp(t) for i, t in docs}, 2, pairs)}


@pytest.mark.parametrize("similarity,busy", [(0.5, 24), (0.8, 2)])
def test_no_link_is_left_out(spark, monkeypatch, similarity, busy):
    """Pairs at, near and under the similarity, of few words and many, half of them with long passages that many texts have: exactly the components stay."""
    monkeypatch.setattr(S, "BUSY", busy)
    r = random.Random(21)
    word = lambda: "w%d" % r.randrange(10**6)
    passages = [[word() for _ in range(n)] for n in (40, 60, 150)]
    docs = []
    for i in range(260):
        a = [word() for _ in range(r.choice((6, 14, 40, 120)))]
        b = list(a)
        if i % 4 == 0:
            b += [word() for _ in range(round((len(a) - 4) * (1 / similarity - 1)) + r.randint(-1, 1))]
        else:
            for at in r.sample(range(len(a)), round(len(a) * (1 - similarity) / r.choice((4, 6, 9)))):
                b[at] = word()
        if i % 2:
            common = r.choice(passages)
            a, b = [*common, *a], [*common, *b] if i % 3 else [*b, *common]
        docs += [(len(docs), " ".join(a)), (len(docs) + 1, " ".join(b)), *([(len(docs) + 2, " ".join(b).upper())] if i % 5 == 0 else [])]
    kept = {x.doc_id for x in S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), similarity=similarity).collect()}
    assert kept == left(docs, similarity)


def test_no_link_is_left_out_of_a_crowd(spark, monkeypatch):
    """Relatives of one text with a twin each: bands with one centre lose links, which are found after."""
    monkeypatch.setattr(S, "CENTRES", 1)
    monkeypatch.setattr(S, "BUSY", 4)
    r = random.Random(12)
    word = lambda: "w%d" % r.randrange(10**6)
    base = [word() for _ in range(200)]
    docs = []
    for _ in range(150):
        t = list(base)
        at = r.randrange(200 - 22)
        t[at : at + 22] = [word() for _ in range(22)]
        twin = list(t)
        at = r.randrange(190)
        twin[at : at + 10] = [word() for _ in range(10)]
        docs += [(len(docs), " ".join(t)), (len(docs) + 1, " ".join(twin))]
    kept = {x.doc_id for x in S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == left(docs, 0.8)


def test_whole_texts_are_not_stored_again(spark, monkeypatch):
    """Texts with a passage in common, so that all are looked at whole: no table of the step holds all their shingles (their hashes don't compress)."""
    r = random.Random(5)
    word = lambda: "w%d" % r.randrange(10**6)
    passage = [word() for _ in range(300)]
    docs = [(i, " ".join([*passage, *(word() for _ in range(400))])) for i in range(120)]
    sizes, stored = [], S.stored

    def weighed(df, name, rows=0):
        out = stored(df, name, rows)
        path = out.helixtab_path.removeprefix("file:")
        sizes.append((sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")), name))
        return out

    monkeypatch.setattr(S, "stored", weighed)
    kept = S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).count()
    shingle_bytes = 6 * 696 * len(docs)
    assert kept == len(docs) and max(sizes)[0] < 0.5 * shingle_bytes, sorted(sizes)[-3:]


def test_variants_are_not_broadcast(spark, monkeypatch):
    """Spark sizes tables by the files that they come from, and fingerprints are taken 64-fold: what meets under variants isn't sent to all by the driver."""
    plans, stored = {}, S.stored

    def seen(df, name, rows=0):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name, rows)

    fps = stored(spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 64) - (1 << 63),) for i in range(200)], "fp long"), "few")
    monkeypatch.setattr(S, "stored", seen)
    found = S.links(fps)
    plans["links"] = found._jdf.queryExecution().executedPlan().toString()
    assert {"variants0", "equal0", "links"} <= set(plans)
    assert not [name for name, plan in plans.items() if "BroadcastHashJoin" in plan]


def test_places_of_common_tokens(spark, monkeypatch):
    """By brute force: tokens of more than BUSY texts that have different roots; and tokens of texts of different roots, whatever the blocks and buckets."""
    monkeypatch.setattr(S, "BUSY", 3)
    monkeypatch.setattr(S, "BLOCK", 50)
    r = random.Random(4)
    texts = []
    for i in range(60):
        no = (i % 5 << S.IN_FILE) + i
        texts.append((no, texts[i - 10][1] if i > 10 and i % 7 == 0 else no, sorted(r.sample(range(1 << 47), 5) + r.sample(range(0, 1 << 47, 1 << 41), 12))))
    rows = spark.createDataFrame(texts, "no long, root_no long, tokens array<long>").repartition(3)
    holders = defaultdict(set)
    for no, root, tokens in texts:
        for t in tokens:
            holders[t].add((no, root))
    crossing = {t: x for t, x in holders.items() if len({root for _, root in x}) > 1}
    want = {no: [i for i, t in enumerate(tokens) if t in crossing and len(crossing[t]) > 3] for no, _, tokens in texts}
    for buckets in (1, 7):
        got = {x.no: sorted(x.last) for x in S._last(rows, buckets).collect()}
        assert got == {no: places for no, places in want.items() if places} and got


def test_clashing_columns_in_dedup(spark):
    kind = "doc_id long, text string, _id long, _row_a long, fp long, minima string, bands int, a int"
    docs = spark.createDataFrame([(1, "a b c", 5, 1, 1, "m", 1, 1), (2, "a b c", 6, 2, 2, "m", 2, 2), (None, None, 7, 3, 3, "m", 3, 3)], kind)
    assert sorted((x.doc_id or 0, x._id, x.a) for x in S.deduplicated(docs).collect()) == [(0, 7, 3), (1, 5, 1)]
    assert S.deduplicated(docs.where("false")).count() == 0
