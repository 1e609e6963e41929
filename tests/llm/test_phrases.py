import random
import re
from collections import Counter

import pytest

from helixtab.llm import phrases as P


def slow(docs, longest, least, held, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    rows = []
    often = {g: a for g, a in f.items() if a >= least}
    for (lang, g), a in often.items():
        k = len(g)
        if k == 1:
            continue
        inside = any(m == lang and len(x) > k and any(x[i : i + k] == g for i in range(len(x) - k + 1)) and 100 * b >= held * a for (m, x), b in often.items())
        if inside:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, g[:j]] * f[lang, g[j:]]), j, f[lang, g[:j]], f[lang, g[j:]]) for j in range(1, k))  # noqa: E741
        rows.append((lang, score, a, " ".join(g), l, r))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[1], -r[2], r[3].encode()))[:top]
        out += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (_, s, a, p, l, r) in enumerate(mine)]  # noqa: E741
    return sorted(out)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["a", "B", "cc", "É", "d-d", "ee", "x\x0bx"]
    out = [("en", None), (None, "a b cc, a b cc"), ("en", ""), ("en", " ,;\n"), ("und", "a b cc")]
    for _ in range(n):
        t = " ".join(r.choice(("a B cc ee", "É d-d", *words)) + r.choice(("", "", "", ".", "!\n", "\t")) for _ in range(r.choice((1, 5, 40))))
        out.append((r.choice(("en", "en", "fr", None)), t))
    return out + out[-3:]


@pytest.mark.parametrize("longest,least,held,top,block,broadcast", [(5, 8, 100, 2000, 1 << 20, 1000), (5, 4, 100, 7, 100, 0), (3, 5, 60, 2000, 300, 1000), (2, 3, 100, 50, 1 << 20, 0)])
def test_against_brute_force(spark, longest, least, held, top, block, broadcast):
    docs = corpus(longest * 10 + least)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, id int, word string")
    got = P.collocations(frame, longest, least, held, top, block, broadcast)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == slow(docs, longest, least, held, top)


def test_empty(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert P.collocations(none).collect() == []
    few = spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")
    assert P.collocations(few).collect() == []


def test_long_text_without_any_cut(spark):
    r = random.Random(2)
    text = " ".join(r.choice(("ab", "c", "def", "g")) for _ in range(60_000))
    got = P.collocations(spark.createDataFrame([("en", text)], "lang string, text string"), block=1 << 14)
    assert sorted(map(tuple, got.collect())) == slow([("en", text)], 5, 100, 100, 2000)


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(5 * 10**12, 4 * 10**14, [6 * 10**12], [7 * 10**12])], "a long, n long, firsts array<long>, lasts array<long>")
    (got,) = row.selectExpr(P.SCORED.format(k=2) + " as s").first()
    assert got[0].score == 1000 * 5 * 10**12 * 4 * 10**14 // (6 * 10**12 * 7 * 10**12)


def test_pieces_keep_their_words():
    r = random.Random(4)
    for _ in range(50):
        text = "".join(r.choice("ab  .é") for _ in range(r.randrange(80))).encode()
        own = b"".join(bytes(p[:n]) for p, n in P.cuts(memoryview(text), r.choice((1, 7, 30)), 2))
        assert own == text


def test_words_of_equal_hashes(spark):
    a, b = ("".join("ab"[(i.bit_count() + f) % 2] for i in range(1024)) for f in (0, 1))
    docs = [("en", f"{a} {b} x, " * 6 + f"{b} {a} y, " * 5)]
    assert sorted(map(tuple, P.collocations(spark.createDataFrame(docs, "lang string, text string"), least=3).collect())) == slow(docs, 5, 3, 100, 2000)
