import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from helixtab.llm import packing as K


def texts():
    r = random.Random(4)
    words = ["the", "Ange", "éa", "x'll", "42", "__", "\n\n", "語", "🙂", "  "]
    out = [None, "", " ", "a", "\t\n", "word " * 9000, "x" * 5000, f"a {K.SPECIAL} b"]
    return out + [" ".join(r.choice(words) for _ in range(r.randint(0, 900))) for _ in range(150)]


def check(rows, want, size):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length > 0
    assert set(docs) == set(want)
    for i, pieces in docs.items():
        at = 0
        for start, n, crc, total in sorted(pieces):
            assert start == at and total == len(want[i])
            assert crc == zlib.crc32(np.array(want[i][start : start + n], "<u4").tobytes())
            at += n
        assert at == len(want[i])
    lengths = []
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= size
        lengths.append(at)
    return lengths


def exact(text):
    return Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [1]


def test_pack(spark):
    kind = "doc_id long, text string, start int, source string"
    rows = [(i, t, 1, None) for i, t in enumerate(texts())]
    want = {i: exact(t) for i, t in enumerate(texts())}
    for block in (K.BLOCK, 9000):
        lengths = check(K.pack(spark.createDataFrame(rows, kind).repartition(3), block=block).collect(), want, 2048)
        assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)


def test_ids_round_trip(spark):
    rows = [(1, "word " * 3000), (2, "short")]
    out = K.pack(spark.createDataFrame(rows, "doc_id long, text string"), size=512, with_ids=True).collect()
    for i, t in rows:
        got = [x for r in sorted((r for r in out if r.doc_id == i), key=lambda r: r.start) for x in r.ids]
        assert got == exact(t)


def test_balance():
    r = random.Random(8)
    lengths = [r.randint(1, 3000) for _ in range(2000)]
    loads, sizes = defaultdict(float), defaultdict(int)
    for _, _, n, s, _ in K.assign(lengths, 2048):
        loads[s] += K.cost(n)
        sizes[s] += n
    full = [loads[s] for s in loads if sizes[s] == 2048]
    whole = K.cost(2048)
    shared = [x for x in full if x < whole]
    assert max(shared) / (sum(shared) / len(shared)) < 1.35
    assert sum(1 for s in sizes if sizes[s] < 2048) <= 11


def test_odd_tables(spark):
    kind = "doc_id long, text string"
    rows = K.pack(spark.createDataFrame([(None, None), (3, "a"), (3, "a")], kind)).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows) == [(0, 1), (3, 2), (3, 2)] or sum(r.length for r in rows) == 5
    assert K.pack(spark.createDataFrame([], kind)).count() == 0


def test_both_vocabulary_files_agree():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    ids = K.tokenizer()
    exact_tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.characters(exclude_categories=("Cs",)), max_size=200))
    def agree(text):
        assert ids(text) == exact_tokenizer.encode(text, add_special_tokens=False).ids

    agree()
