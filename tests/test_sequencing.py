"""Reports from alignments, scans over ranges, nested bins and ingest, against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixtab.operators import copynumber as N
from helixtab.operators import intervals as I  # noqa: E741
from helixtab.operators import scans as R
from helixtab.operators import sequencing as Q
from helixtab.operators import windows as W
from helixtab.streaming import events, ingest


def test_blocks_and_unclipped_ends(spark):
    rows = [("5S10M2D3M1I4M3H", 100), ("30M", 5), ("2H3S4M5N6M", 50), ("*", 7), ("10M5S", 20), ("3=2X", 0)]
    df = spark.createDataFrame(rows, "cigar string, pos0 long")
    got = df.select(Q.aligned_blocks(F.col("cigar"), F.col("pos0")).alias("b"), Q.unclipped_end(F.col("cigar"), F.col("pos0"), F.lit(False)).alias("f"), Q.unclipped_end(F.col("cigar"), F.col("pos0"), F.lit(True)).alias("r")).collect()
    assert [[tuple(x) for x in r.b] for r in got] == [[(100, 109, 5), (112, 114, 15), (115, 118, 19)], [(5, 34, 0)], [(50, 53, 3), (59, 64, 7)], [], [(20, 29, 0)], [(0, 2, 0), (3, 4, 3)]]
    assert [(r.f, r.r) for r in got] == [(95, 121), (5, 34), (45, 64), (7, 6), (20, 34), (0, 4)]


def slow_capture(blocks, targets, baits, near, levels):
    inside = lambda spans, by: {(c, p) for c, a, b in spans for p in range(a - by, b + by + 1)}
    wanted, on, around = inside(targets, 0), inside(baits, 0), inside(baits, near)
    islands: dict = {}
    for c, p in sorted(wanted):
        islands[c, p] = islands.get((c, p - 1), (c, p))
    out = {}
    for s in {b[0] for b in blocks}:
        depth = Counter((c, p) for g, c, a, b in blocks if g == s for p in range(a, b + 1))
        d = sorted(depth[x] for x in wanted)
        seen = {islands[x] for x in wanted if depth[x]}
        low = sorted(depth[x] for x in wanted if islands[x] in seen)
        least = lambda v, q: v[max(0, math.ceil(q * len(v)) - 1)]
        p20 = least(low, 0.2) if low else 0
        every = sum(depth.values())
        bait, ring = sum(n for x, n in depth.items() if x in on), sum(n for x, n in depth.items() if x in around)
        out[s] = (len(set(islands.values())), len(d), every, bait, ring - bait, every - ring, sum(d), least(d, 0.5), round(sum(low) / len(low) / p20, 9) if p20 else None, round(1 - len(seen) / len(set(islands.values())), 9), *(round(sum(x >= k for x in d) / len(d), 9) for k in levels))
    return out


@pytest.mark.parametrize("tile", [16, 4096])
def test_capture(spark, tile):
    r = random.Random(tile)
    spans = lambda n, top, length: [(f"c{r.randrange(3)}", a, a + r.randrange(length)) for a in (r.randrange(top) for _ in range(n))]
    targets, baits = spans(25, 900, 60), spans(25, 900, 70)
    blocks = [(g, c, a, b) for g in "xy" for c, a, b in spans(400 if g == "x" else 30, 1000, 40)] + [("z", "c9", 1, 5)]
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = Q.capture_metrics(frame(blocks, "g string, chrom string, start long, end long"), frame(targets, "chrom string, start int, end int"), frame(baits, "chrom string, start int, end int"), "g", 9, (1, 3, 5), tile).collect()
    names = ("n_targets", "target_bases", "bases", "on_bait", "near_bait", "off_bait", "on_target", "median_coverage", "fold_80", "zero_targets", "share_ge_1", "share_ge_3", "share_ge_5")
    assert {x.g: tuple(round(v, 9) if isinstance(v := x[n], float) else v for n in names) for x in got} == slow_capture(blocks, targets, baits, 9, (1, 3, 5))


def test_composition_over_chunk_edges(spark):
    r = random.Random(3)
    seqs = {c: "".join(r.choice("ACGTN" if r.random() < 0.2 else "ACGT") for _ in range(n)) for c, n in (("a", 230), ("b", 100), ("c", 19), ("d", 40))}
    chunks = [(c, i // 50, s[i : i + 50]) for c, s in seqs.items() for i in range(0, len(s), 50)]
    got = {(x.chrom, x.pos0): x.gc for x in Q.composition_windows(spark.createDataFrame(chunks, "ref_chrom string, chunk_no long, seq string"), 20, 2).collect()}
    want = {(c, i): sum(b in "GC" for b in s[i : i + 20]) * 100 // 20 for c, s in seqs.items() for i in range(len(s) - 19) if s[i : i + 20].count("N") <= 2}
    assert got == want


def test_planted_oxidation(spark):
    """G>T in first reads, C>A in second ones, in one context: found there and nowhere else."""
    r = random.Random(4)
    seq = "".join(r.choice("ACGT") for _ in range(600))
    other = {"A": "T", "C": "G", "G": "C", "T": "A"}
    turn = lambda s: "".join(other[b] for b in reversed(s))
    reads = []
    for i in range(1500):
        at, reverse, first = r.randrange(1, 540), r.random() < 0.5, r.random() < 0.5
        bases = list(seq[at : at + 50])
        for k, b in enumerate(bases):
            own, context = (other[b] if reverse else b), seq[at + k - 1 : at + k + 2]
            context = context if b in "CT" else turn(context)
            if context == "CCG" and own == ("G" if first else "C") and r.random() < 0.3:
                bases[k] = {"G": "T", "C": "A"}[b]
        reads.append(("s", "1", at, 1 + 16 * reverse + (64 if first else 128), "50M", "".join(bases)))
    chunks = [("1", i // 100, seq[i : i + 100]) for i in range(0, 600, 100)]
    got = Q.strand_context_errors(spark.createDataFrame(reads, "g string, chrom string, pos0 long, flag int, cigar string, query string"), spark.createDataFrame(chunks, "ref_chrom string, chunk_no long, seq string"), "g", 100).collect()
    by = {x.context: x for x in got}
    assert len(by) == 16 and by["CCG"].rate > 0.08 and by["CCG"].alt_other == 0 and by["CCG"].quality < 11
    assert all(x.rate == 1e-10 and x.alt_marked == 0 for c, x in by.items() if c != "CCG")


def test_ambiguous_groups(spark):
    pair = lambda g, a, b, size: (g, 1 + 64 + 16 * a + 32 * b, size)
    rows = [pair("good", 0, 1, 300 + i % 5) for i in range(60)] + [pair("good", 1, 0, -300 - i % 5) for i in range(40)] + [pair("good", 0, 1, 90_000)]
    rows += [pair("mixed", i % 2, i // 2 % 2, 300) for i in range(40)] + [pair("one", 0, 1, 200) for _ in range(9)] + [("none", 0, 0), ("none", 1 + 64 + 4, 5)]
    df = spark.createDataFrame(rows, "g string, flag int, insert_size int")
    models = Q.fragment_models(df, "g")
    got = {x.g: x for x in models.collect()}
    assert {g: x.ambiguous for g, x in got.items()} == {"good": False, "mixed": True, "one": False}
    assert (got["good"].model_1, got["good"].model_2, got["good"].median) == ("F1R2", "F2R1", 302.0) and got["one"].model_2 is None
    proper = Counter((x.g, x.proper) for x in Q.resolved(df, models, "g").collect())
    assert proper == {("good", True): 100, ("good", False): 1, ("mixed", False): 40, ("one", True): 9}


def test_library_size(spark):
    cases = [(1000, 900), (10**6, 999_000), (5000, 50), (10**9, 7 * 10**8), (10, 10), (0, 0), (5, 0)]
    got = [x[0] for x in spark.createDataFrame(cases, "n long, c long").select(Q.library_size(F.col("n"), F.col("c"))).collect()]
    for (n, c), x in zip(cases, got, strict=True):
        if n == c or not c:
            assert x is None
            continue
        low, high = float(c), 1e18
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if c / mid - 1 + math.exp(-n / mid) > 0 else (low, mid)
        assert abs(x - low) <= max(2, 1e-6 * low)


def test_duplicates_by_ends(spark):
    read = lambda name, flag, pos, cigar, w=1: ("lib", name, flag, "1", pos, cigar, w)
    pair = lambda name, a, ca, b, cb, w=1: [read(name, 65, a, ca, w), read(name, 129 + 16, b, cb, w)]
    rows = pair("q:1:100:100", 10, "20M", 100, "20M", 5) + pair("q:1:150:120", 12, "2S18M", 100, "18M2S") + pair("q:1:900:900", 10, "20M", 100, "20M") + pair("q:2:100:100", 10, "20M", 100, "20M") + pair("q:1:100:101", 11, "20M", 100, "20M")
    rows += [read("s1", 0, 10, "20M"), read("s2", 0, 500, "20M", 3), read("s3", 0, 503, "3S17M"), read("s4", 4, 0, "*"), read("s2", 256, 9, "20M")]
    found = Q.fragments(spark.createDataFrame(rows, "library string, read_name string, flag int, chrom string, pos0 long, cigar string, weight int"), "library")
    marked = Q.marked_fragments(found, "library")
    assert {x.read_name: (x.duplicate, x.optical) for x in marked.collect()} == {
        "q:1:100:100": (False, False), "q:1:150:120": (True, True), "q:1:900:900": (True, False), "q:2:100:100": (True, False), "q:1:100:101": (False, False), "s1": (True, False), "s2": (False, False), "s3": (True, False),
    }
    (x,) = Q.duplicate_metrics(marked, "library").collect()
    assert (x.pairs, x.singles, x.duplicate_pairs, x.duplicate_singles, x.optical_pairs) == (5, 3, 3, 2, 1) and x.share == 8 / 13


def test_scans_over_ranges(spark):
    r = random.Random(6)
    rows = [(r.choice(("hot", "hot", "hot", "b", None)), i, r.choice((None, r.randrange(-50, 50)))) for i in range(3000)]
    r.shuffle(rows)
    ranged = R.ranged(spark.createDataFrame(rows, "g string, k int, v int"), ["g"], ["k"])
    assert ranged.where("g = 'hot'").select("_range").distinct().count() > 3
    up = R.scan(ranged, ["g"], ["k"], {"s": (R.SUM, F.col("v")), "m": (R.LEAST, F.col("v")), "l": (R.LAST, F.col("v"))})
    down = {x.k: x for x in R.scan(up, ["g"], ["k"], {"s2": (R.SUM, F.col("v")), "l2": (R.LAST, F.col("v"))}, reverse=True, before=True).collect()}
    groups = defaultdict(list)
    for g, k, v in sorted(rows, key=lambda x: x[1]):
        groups[g].append((k, v))
    for g, own in groups.items():
        known = []
        for k, v in own:
            known += [v] if v is not None else []
            x = down[k]
            assert (x.g, x.s, x.m, x.l) == (g, sum(known), min(known, default=None), known[-1] if known else None)
        after = []
        for k, v in reversed(own):
            assert (down[k].s2, down[k].l2) == (sum(after), after[-1] if after else None)
            after += [v] if v is not None else []


def test_largest_task_stays_level_as_a_group_grows(spark):
    for n in (2000, 20000):
        sizes = R.ranged(spark.range(n).select(F.lit("g").alias("g"), F.col("id").alias("v")), ["g"], ["v"]).groupBy("_range").count().collect()
        assert max(x["count"] for x in sizes) < 2 * n / len(sizes) and len(sizes) > 4


def test_two_means_of_any_ties(spark):
    r = random.Random(8)
    rows = [("a", 1.0)] * 4 + [("b", 2.0)] + [(g, float(r.choice((1, 1, 1, 2, 5, 9, 9)))) for g in "cdefgh" for _ in range(r.randrange(2, 30))] + [(None, 1.0), (None, 4.0)]
    got = {x.g: x for x in N.two_means(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    groups = defaultdict(list)
    for g, v in rows:
        groups[g].append(v)
    for g, v in groups.items():
        v = np.sort(v)
        if len(v) < 2:
            assert g not in got
            continue
        within = [round(((v[:i] - v[:i].mean()) ** 2).sum() + ((v[i:] - v[i:].mean()) ** 2).sum(), 9) for i in range(1, len(v))]
        i = int(np.argmin(within)) + 1
        assert (got[g].cut, round(got[g].low_mean, 9), round(got[g].high_mean, 9)) == (v[i - 1], round(v[:i].mean(), 9), round(v[i:].mean(), 9))


def test_adjusted_with_nulls_and_ties(spark):
    r = random.Random(9)
    rows = [(i, r.choice(("x", "x", "y", None)), r.choice((None, 0.01, 0.02, 0.5, r.random()))) for i in range(400)]
    got = {x.i: x.p_adjusted for x in W.adjust(spark.createDataFrame(rows, "i int, g string, p double"), ["g"], "p").collect()}
    assert len(got) == len(rows)
    for g in ("x", "y", None):
        own = sorted((p, i) for i, h, p in rows if h == g and p is not None)
        least = 1.0
        for at in range(len(own) - 1, -1, -1):
            p, i = own[at]
            last = max(k for k, (q, _) in enumerate(own) if q == p) + 1
            least = min(least, p * len(own) / last)
            assert abs(got[i] - least) < 1e-12
    assert all(got[i] is None for i, _, p in rows if p is None)


def test_nested_bins(spark):
    r = random.Random(10)
    span = lambda: (a := r.randrange(10**8), a + int(10 ** r.uniform(0, 8)))
    left = [(i, r.randrange(3), *span()) for i in range(150)] + [(1000, 0, None, 5), (1001, 0, 9, 3)]
    right = [(i, r.randrange(3), *span()) for i in range(150)] + [(1000, 0, 16383, 16384), (1001, 0, 0, 10**8 * 3)]
    a, b = spark.createDataFrame(left, "i int, c int, s long, e long"), spark.createDataFrame(right, "j int, k int, s2 long, e2 long")
    got = I.nested_join(a, b, ("s", "e"), ("s2", "e2"), (("c", "k"),)).select("i", "j").collect()
    want = sorted((x[0], y[0]) for x in left for y in right if x[2] is not None and x[2] <= x[3] and x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted(map(tuple, got)) == want


def test_ingest_survives_a_kill_between_batches(spark, tmp_path):
    r = random.Random(11)
    rows = [(r.randrange(40), i, 1_000_000 + i * 10) for i in range(600)]
    source, path = str(tmp_path / "in"), str(tmp_path / "store")
    for part in range(6):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], "k int, n int, at long").withColumn("at", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    calls, apply = [], ingest.Store.apply

    class Dies(ingest.Store):
        def apply(self, batch, number, time=None, delay=0):
            calls.append(number)
            if len(calls) == 3:  # the table was written, the stream's own mark wasn't
                apply(self, batch, number, time, delay)
                raise RuntimeError("killed")
            return apply(self, batch, number, time, delay)

    store = Dies(spark, path, ["k"], ["n"], 8)
    start = lambda s: ingest.upserted(events.files(spark, source, schema, per_trigger=1), s, str(tmp_path / "mark"))
    with pytest.raises(Exception, match="killed"):
        start(store).awaitTermination()
    start(store).awaitTermination()
    assert calls.count(2) == 2 and store.commits() == list(range(6))  # done again, passed over
    want = {}
    for k, n, _ in rows:
        want[k] = max(want.get(k, -1), n)
    assert {x.k: x.n for x in store.rows().collect()} == want and store.late() is None


def test_late_rows_go_apart_and_batches_are_put_in_once(spark, tmp_path):
    store = ingest.Store(spark, str(tmp_path / "s"), ["k"], ["n"], 4)
    assert store.rows() is None
    frame = lambda rows: spark.createDataFrame(rows, "k int, n int, t long").withColumn("t", F.timestamp_seconds("t"))
    assert store.apply(frame([(1, 1, 1000), (2, 1, 900)]), 0, "t", 50)  # nothing is late in the first
    assert store.apply(frame([(1, 2, 940), (2, 2, 960), (None, 3, None)]), 1, "t", 50)
    assert not store.apply(frame([(9, 9, 9)]), 1, "t", 50)
    assert store.apply(frame([]), 2, "t", 50)
    assert sorted(map(tuple, store.rows().select("k", "n").collect()), key=str) == [(1, 1), (2, 2), (None, 3)]
    assert [tuple(x)[:2] for x in store.late().collect()] == [(1, 2)]
