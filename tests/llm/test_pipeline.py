"""Each stage of the pipeline against a plain version over its own input."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as C
from helixtab.llm import packing, quality_rules, secret_scan
from helixtab.llm._util import stored
from tests.llm import test_mixing, test_packing, test_quality, test_secrets, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        out.append(stored(f(spark, out[-1], SF), f"test-{name}"))
    return docs.columns, [[r.asDict() for r in df.collect()] for df in out]


def test_names():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "simhash_dedup", "secret_scan", "mixing", "packing"] and C.ORACLE_SQL is None


def test_columns(stages):
    columns, frames = stages
    assert all(list(f[0]) == columns for f in frames[:-1])


def test_quality_stage(spark, stages):
    _, (before, after, *_) = stages
    crf = quality_rules.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = []
    for r in before:
        if not test_quality.slow_base(r["text"])[-1] and quality_rules.judge(r["text"], crf)[-1]:
            kept.append(r)
    assert sorted(map(str, kept)) == sorted(map(str, after))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in before if labels.get(r["doc_id"]) == 1 and not test_quality.slow_base(r["text"])[-1]]
    assert len([r for r in good if r in after]) >= 0.99 * len(good)


def test_dedup_stage(stages):
    """By brute force over all pairs: what is surely alike has one row left, and what goes is like something."""
    _, (_, before, after, *_) = stages
    fps = {r["doc_id"]: test_simhash.slow_fp(r["text"]) for r in before}
    sets = {r["doc_id"]: test_simhash.shingles(r["text"]) for r in before}
    kept = {r["doc_id"] for r in after}
    assert len(kept) == len(after)
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    for least, one in ((0.88, lambda n: n <= 1), (0.8, lambda n: n >= 1)):
        groups = test_simhash.grouped(fps, 2, [p for p, x in share.items() if x >= least])
        assert all(one(len(kept & g)) for g in groups)


def test_secrets_stage(spark, stages):
    _, (_, _, before, after, *_) = stages
    model = secret_scan.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r["doc_id"]: r for r in after}
    assert len(got) == len(before) == len(after)
    for r in before:
        base = secret_scan.base_spans(r["text"])
        if len(r["text"]) < 1500:
            assert base == test_secrets.slow_base(r["text"])
        mine = got[r["doc_id"]]
        hidden = [False] * len(r["text"])
        for s, e, _ in base + model.spans(r["text"], base):
            hidden[s:e] = [True] * (e - s)
        want = re.sub("\0+", lambda m: "[REDACTED]", "".join("\0" if h else c for c, h in zip(r["text"], hidden, strict=True)))
        # neighbouring spans that touch keep a mask each
        assert mine["text"] == want or mine["text"].replace("[REDACTED][REDACTED]", "[REDACTED]") == want
        assert mine["n_chars"] == len(mine["text"]) and not secret_scan.base_spans(mine["text"])


def test_mixing_stage(stages):
    _, (_, _, _, before, after, _) = stages
    size = {r["doc_id"]: len(r["text"].split()) for r in before}
    sources = defaultdict(list)
    for r in before:
        sources[r["source"]].append(r["doc_id"])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sources))}
    queue = []
    for s, ids in sources.items():
        total = sum(size[i] for i in ids)
        ids = sorted(ids, key=lambda i: hashlib.md5(f"{i}:mix".encode()).hexdigest())
        at = 0
        for turn in (0, 1):
            at = turn * total
            for i in ids:
                at += size[i]
                queue.append((at / weights[s], s, hashlib.md5(f"{i}:mix".encode()).hexdigest(), turn, i))
    budget = sum(size.values()) * 3 // 2
    taken = Counter()
    for _, _, _, _, i in sorted(queue):
        part = min(size[i], budget)
        taken[i] += part
        budget -= part
    got = Counter()
    for r in after:
        got[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert got == +taken
    targets = test_mixing.fill({s: sum(size[i] for i in ids) for s, ids in sources.items()}, weights, 1.5 * sum(size.values()))
    for s, ids in sources.items():
        assert abs(sum(got[i] for i in ids) - targets[s]) <= max(size.values())


def test_packing_stage(spark, stages):
    _, (*_, before, after) = stages
    ids = packing.tokenizer()
    assert sum(r["length"] for r in after) == sum(len(ids(r["text"])) + 1 for r in before)
    lengths = defaultdict(int)
    for r in after:
        lengths[r["sequence_id"]] += r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
    once = [i for i, n in Counter(r["doc_id"] for r in before).items() if n == 1]
    want = {r["doc_id"]: ids(r["text"]) + [1] for r in before if r["doc_id"] in once}
    from types import SimpleNamespace as S

    alone = [S(**r) for r in after if r["doc_id"] in want]
    for r in alone:  # sequences are shared with documents that are taken twice
        r.sequence_id, r.offset = id(r), 0
    test_packing.check(alone, want, 2048)


def test_run(spark, stages):
    _, (*_, last) = stages
    assert sum(r["length"] for r in last) == sum(r["length"] for r in C.run(spark, SF).collect())


def test_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    prose = "These are some plain words that a reader may well enjoy, and nothing here is out of order at all."
    rows = [(None, prose, None, None, None), (1, None, "en", "a", 0), (1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, "", "en", None, 0)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, f in C.STAGES:
            out = f(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            out.collect()
