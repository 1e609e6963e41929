import os
import random
from collections import defaultdict

import duckdb
import pytest

from helixtab.llm import mixing as M

SF = "/root/testdata/sf0.001"


def fill(sizes, weights, budget):
    """Targets by sharing the excess again and again."""
    full, target = set(), {}
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        target = {s: 2 * sizes[s] if s in full else left * weights[s] / total for s in sizes}
        new = {s for s in sizes if s not in full and target[s] > 2 * sizes[s]}
        if not new:
            return target
        full |= new


def rows(seed):
    r = random.Random(seed)
    out = []
    for i in range(400):
        source = r.choice(["a", "b", "b", "b", "ß", "z9", None, "Z"])
        out.append((i, "w " * r.choice((0, 1, 5, r.randint(0, 300))), source, "x"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    docs = rows(seed) + [(None, None, "a", "y"), (3, "w w", "b", "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size string")
    out = M.mix(df.repartition(5)).collect()
    assert len(out) == len(docs)
    sizes = defaultdict(int)
    for _, t, s, _ in docs:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    want = fill(sizes, weights, 1.5 * total)
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * total
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert sum(taken.values()) == total * 3 // 2
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 300
    again = M.mix(df.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_odd_tables(spark):
    kind = "doc_id long, text string, source string, taken int"
    assert M.mix(spark.createDataFrame([], kind)).count() == 0
    out = M.mix(spark.createDataFrame([(1, None, None, 1), (1, "", "a", 2)], kind)).collect()
    assert [(r["size"], r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{os.path.join(SF, 'documents.parquet')}'")
    want = sorted(con.sql(M.OP8_SQL).fetchall())
    got = sorted(tuple(r) for r in M.op8_mix_sources(spark, SF).collect())
    assert got == want


def test_clashing_names(spark):
    kind = "doc_id long, source string, text string, n_chars long, _key long, key string, taken int, part int, size int, carried int"
    docs = spark.createDataFrame([(i, "ab"[i % 2], "some words here " * (i + 1), 16 * i, i, "k%d" % i, i, i, i, i) for i in range(9)] + [(None, None, "no id", None, 77, None, 7, 7, 7, 7)], kind)
    rows = M.mixed(docs).collect()
    assert rows and rows[0].__fields__ == docs.columns
    for r in rows:
        assert r._key == r.taken == r.part == r.size == r.carried or r._key == 77
        assert r.doc_id is None or r._key == r.doc_id


def test_texts_move_once(spark):
    """Rows that repeat are found where texts met what is taken of them: of all shuffles one has texts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (0, "c", ""), (2, None, "x")], "doc_id long, text string, source string")
        out = M.mixed(docs)
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
        texts = next(i for i, line in enumerate(plan) if "first(text" in line)
        met = next(i for i, line in enumerate(plan) if "SortMergeJoin [same0" in line)
        assert texts < met and not any("Exchange" in line for line in plan[texts:met])
        rows = out.collect()
        assert sum(len(x.text.split()) for x in rows) == 9  # of 6 words one and a half times as many
        assert {(x.doc_id, x.source) for x in rows} == {(1, "x"), (None, None), (0, "")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
