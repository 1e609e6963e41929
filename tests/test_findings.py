"""What a review of larger tables found: whole results where many rows are equal, and work that doesn't grow with their pairs."""

import random
import re

from pyspark.sql import functions as F

from helixtab.operators import copynumber as N
from helixtab.operators import counting as C
from helixtab.operators import intervals as I  # noqa: E741
from helixtab.operators import joins as J
from helixtab.operators import sequencing as Q
from helixtab.plans import structural


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_ties_go_to_the_first_normal(spark):
    lr = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5 + 1e-13), ("u", "a", 2.0), ("u", "b", 1.0)], "tumor string, normal string, lr double")
    assert [(r.tumor, r.normal) for r in N.best_normals(lr).orderBy("tumor").collect()] == [("t", "a"), ("u", "b")]


def _copies(spark):
    """Points and intervals with many copies, nulls and reversed intervals; pairs by brute force."""
    r = random.Random(5)
    at = [r.choice([1.0, 2.5, 2.5, 7.25, 30.0, None]) for _ in range(60)]
    spans = [(r.choice([0.5, 2.5, 6.0]), r.choice([1.0, 2.5, 7.25, 9.0])) for _ in range(50)] + [(None, 3.0), (1.0, None)]
    points = spark.createDataFrame(list(enumerate(at)), "i int, v double")
    bands = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(spans)], "k int, lo double, hi double")
    held = {i: [(a, b, k) for k, (a, b) in enumerate(spans) if None not in (v, a, b) and a <= v <= b] for i, v in enumerate(at)}
    return points, bands, held


def test_intervals_of_copies(spark, monkeypatch):
    monkeypatch.setattr(I, "LIST", 3)
    points, bands, held = _copies(spark)
    pairs = I.class_join(points, bands, ("v", "v"), ("lo", "hi"), width=2).select("i", "k")
    assert rows(pairs) == sorted([(i, k) for i, h in held.items() for _, _, k in h], key=repr)
    first = I.first_holder(points, bands, "v", ("lo", "hi"), ["k"], width=2).select("i", "k")
    assert rows(first) == sorted([(i, min(h)[2]) for i, h in held.items() if h], key=repr)
    text = I.all_holders(points, bands, "v", ("lo", "hi"), F.struct("lo", "k"), "k", "ks", width=2).select("i", "ks")
    assert rows(text) == sorted([(i, ",".join(str(k) for _, k in sorted((a, k) for a, _, k in h))) for i, h in held.items() if h], key=repr)
    totals = I.holder_totals(points, bands, "v", ("lo", "hi"), "k", width=2).select("i", "total", "n")
    assert rows(totals) == sorted([(i, sum(k for _, _, k in h), len(h)) for i, h in held.items() if h], key=repr)
    ends = points.withColumn("e", F.col("v"))
    args = (bands, ("v", "e"), ("lo", "hi"), ["i"])
    assert rows(I.overlap_semi(ends, *args, width=2).select("i")) == sorted([(i,) for i, h in held.items() if h], key=repr)
    assert rows(I.overlap_anti(ends, *args, width=2).select("i")) == sorted([(i,) for i, h in held.items() if not h], key=repr)


def test_annotation_lists_a_place_once(spark):
    sv = spark.createDataFrame([(1, "1", 2.0, "chr1", 7.0), (2, "1", 7.0, "2", 2.0), (3, "1", None, "1", 50.0)], "i int, chrom string, pos double, chrom2 string, end double")
    repeats = spark.createDataFrame([("chr1", 1.0, 3.0, "b"), ("1", 1.0, 8.0, "a"), ("1", 0.0, 2.0, None), ("2", 2.0, 2.0, "c")], "chrom string, start double, end double, name string")
    got = rows(structural.annotated(sv, repeats, ["i"], width=2).select("i", "repeats"))
    assert got == [(1, "a<=>b<=>a"), (2, "a<=>c"), (3, "")]


def test_annotation_moves_copies_as_counts(spark, monkeypatch):
    """Many equal regions at a place: what goes to its breakpoints has the name once, and no row that goes on has names laid out."""
    moved, per_position = [], I.per_position

    def seen(points, position, found, how="inner"):
        for df in (points, found):
            for c, kind in df.dtypes:
                if kind.startswith("array"):
                    moved.append(df.agg(F.max(F.size(c))).first()[0])
        return per_position(points, position, found, how)

    monkeypatch.setattr(I, "per_position", seen)
    sv = spark.createDataFrame([(1, "1", 2.0, "1", 5.0), (2, "1", 2.0, "1", 5.0), (3, None, 2.0, "2", 5.0), (4, "1", None, "chr1", 2.0)], "i int, chrom string, pos double, chrom2 string, end double")
    repeats = spark.createDataFrame([("chr1", 1.0, 3.0, "b"), ("1", 1.0, 4.0, "b"), ("1", 1.0, 9.0, None), ("1", 0.0, 2.0, "z")] + [("1", 1.0, 9.0, "a")] * 50, "chrom string, start double, end double, name string")
    got = rows(structural.annotated(sv, repeats, ["i"], width=2).select("i", "repeats"))
    first, second = ["z", *["a"] * 50, "b", "b"], ["a"] * 50
    assert got == [(1, "<=>".join(first + second)), (2, "<=>".join(first + second)), (3, ""), (4, "<=>".join(first))]
    assert moved and max(moved) <= 3


def test_totals_of_overlaps_without_pairs(spark):
    r = random.Random(9)
    own = [(i, r.randrange(3), a, a + r.choice([-1, 0, 5, 400])) for i, a in enumerate(r.randrange(1000) for _ in range(80))]
    other = [(r.randrange(3), a, a + r.choice([0, 3, 90, 2000])) for a in (r.randrange(1000) for _ in range(120))]
    left, right = spark.createDataFrame(own, "i int, k int, s long, e long"), spark.createDataFrame([*other, (None, 1, 9)], "c int, a long, b long")
    got = I.overlap_totals(left, right, ("s", "e"), ("a", "b"), (("k", "c"),), width=64).select("i", "n", "total", "first")
    want = []
    for i, k, s, e in own:
        met = [(a, b) for c, a, b in other if c == k and s <= e and a <= e and s <= b]
        want += [(i, len(met), sum(b - a for a, b in met), min(a for a, _ in met))] if met else []
    assert rows(got) == sorted(want, key=repr)


def test_discordance_of_equal_samples(spark, monkeypatch):
    monkeypatch.setattr(I, "LIST", 2)
    r = random.Random(4)
    g = {(s, site): r.choice("ab-") for s in range(12) for site in "xyz"[: 1 + s % 3]}
    df = spark.createDataFrame([(s, site, v.replace("-", "--")) for (s, site), v in g.items()], "sample int, site string, v string")
    want = []
    for a in range(12):
        for b in range(12):
            both = [x for x in "xyz" if a != b and g.get((a, x), "-") != "-" and g.get((b, x), "-") != "-"]
            differ = sum(g[a, x] != g[b, x] for x in both)
            want += [(a, b, len(both), differ, differ / len(both))] if both else []
    assert rows(J.discordance(df, "sample", "site", "v")) == sorted(want, key=repr)


def test_join_on_few_keys_is_dealt_out(spark):
    a, b = spark.range(300).selectExpr("id % 2 key", "id a"), spark.range(200).selectExpr("id % 2 key", "id b")
    out = J.dealt_join(a, b, "key")
    assert rows(out) == rows(a.join(b, "key"))
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 300 * 200 / 2 / 2  # a task had half of all pairs


def test_models_from_counts_keep_rows_spread(spark):
    reads = spark.range(40).selectExpr("'l' library", "65 + 32 flag", "cast(if(id % 2 = 0, id, 100 + id) as int) + 1 insert_size")
    (m,) = Q.fragment_models(reads, "library").collect()
    length = sorted(i + 1 if i % 2 == 0 else 101 + i for i in range(40))
    median = (length[19] + length[20]) / 2
    away = sorted(abs(x - median) for x in length)
    assert (m.pairs, m.median, m.mad) == (40, median, (away[19] + away[20]) / 2)
    plan = Q.resolved(reads, Q.fragment_models(reads, "library"), "library")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_optical_places_are_not_shuffled_to_their_neighbours(spark):
    r = random.Random(3)
    names = [(f"{i}:{r.randrange(2)}:{r.randrange(400)}:{r.randrange(400)}", r.randrange(3), r.randrange(4)) for i in range(120)]
    reads = [(0, n, flag, "1", pos + 50 * (flag > 80), "10M", w) for n, pos, w in names for flag in (65, 145)]
    found = Q.fragments(spark.createDataFrame(reads, "library int, read_name string, flag int, chrom string, pos0 int, cigar string, weight int"), "library")
    marked = Q.marked_fragments(found, "library")
    want = set()
    for n, pos, w in names:
        for m, q, v in names:
            a, b = ([int(x) for x in k.split(":")[1:]] for k in (n, m))
            if q == pos and (-v, m) < (-w, n) and a[0] == b[0] and max(abs(a[1] - b[1]), abs(a[2] - b[2])) <= 100:
                want.add(n)
    assert {x.read_name for x in marked.where("optical").collect()} == want
    assert 0 < len(want) < 120
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(library") <= 7 and "cx#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def _shuffled(spark, run):
    """Rows that the stages of run's jobs wrote to shuffles."""
    spark.sparkContext.setJobGroup("shuffled", "")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {k for j in tracker.getJobIdsForGroup("shuffled") for k in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(k).shuffleWriteRecords() for k in stages)


def test_base_counts_by_fragment_and_without_pairs(spark):
    r = random.Random(7)
    reads = []
    for i in range(300):
        # single reads, pairs that overlap, pairs that don't, three of one name
        for k in range((1, 2, 2, 3)[i % 4]):
            cigar = r.choice(["30M", "10M2D20M", "12M3I15M", "2S10M5N18M", "15M1I", "10M2I2D18M"])
            size = sum(int(n) for n, o in re.findall(r"(\d+)([MIS])", cigar))
            quals = "".join(r.choice("I#") for _ in range(size)) if i % 9 == 0 else "I" * size
            reads.append((f"r{i}", r.choice((0, 16)), 100 + i % 40 + 60 * k * (i % 4 == 1), cigar, "".join(r.choice("AC") for _ in range(size)), quals))
    sites = [(p, *r.choice([("A", "C"), ("AC", "A"), ("A", "AAC"), ("AGT", "A")])) for p in range(95, 230)]

    def shown(read, p, ref, alt):
        _, _, at, cigar, query, quals = read
        ops, place, out = [(int(n), o) for n, o in re.findall(r"(\d+)(\w)", cigar)], 0, None
        for j, (n, o) in enumerate(ops):
            if o in "MDN" and at <= p < at + n:
                here, after = place + p - at, ops[j + 1 :][:1] if p == at + n - 1 else [(0, "inside")]
                if len(ref) != len(alt):
                    if not after:
                        return None
                    (m, kind), more = after[0], len(alt) - len(ref)
                    if kind == "I" and m == more and query[place + n * (o == "M") :][:m] == alt[len(ref) :] or kind == "D" and m == -more:
                        return "alt"
                    return "ref" if kind not in "ID" and o == "M" else "other"
                if o != "M":
                    return "U" if o == "D" else "other"
                if quals[here] == "#":
                    return None
                return {ref: "ref", alt: "alt"}.get(query[here], "other")
            at, place = at + n * (o in "MDN"), place + n * (o in "MIS")
        return out

    want = {}
    for k, (p, ref, alt) in enumerate(sites):
        seen = [(x[0], x[1], s) for x in reads if (s := shown(x, p, ref, alt))]
        f = {}
        for name, flag, s in seen:
            f.setdefault(name, []).append((flag, s))
        share = lambda own, s: 0 if max(sum(g == b for g, _ in own) for b in (0, 16)) > 1 else 0.5 * (s in {x for _, x in own}) * (2 - ({"ref", "alt"} <= {x for _, x in own}))
        if seen:
            want[k] = (len(seen), *(sum(x[2] == s for x in seen) for s in ("ref", "alt")), sum(x[1] == 0 for x in seen), len(f), *(sum(share(own, s) for own in f.values()) for s in ("ref", "alt")))
    kind = "sample string, read_name string, flag int, chrom string, pos0 long, mapq int, cigar string, query string, quals string"
    table = lambda some: spark.createDataFrame([("s", n, f, "1", at, 60, *rest) for n, f, at, *rest in some], kind)
    variants = spark.createDataFrame([(k, "1", *x) for k, x in enumerate(sites)], "variant_id int, chrom string, pos0 long, ref string, alt string")
    out = C.base_counts(table(reads), variants).collect()
    assert {x.variant_id: (x.dp, x.rd, x.ad, x.dpp, x.dpf, x.rdf, x.adf) for x in out} == want
    single = [(f"s{i}", *x[1:]) for i, x in enumerate(reads * 4)]
    assert _shuffled(spark, C.base_counts(table(single), variants).collect) < 20_000 < sum(x[0] for x in want.values()) * 4


def test_contexts_are_counted_in_batches():
    """Null and short queries, letters of several bytes, groups that are null, batches cut anywhere."""
    import pyarrow as pa

    r = random.Random(2)
    table = []
    for i in range(200):
        seq = "".join(r.choice("ACGTN") for _ in range(r.choice((2, 3, 30))))
        query = None if i % 17 == 0 else "".join(r.choice("ACGTNé") for _ in range(r.randrange(40)))
        table.append((r.choice(("a", None, "b")), i % 2 == 0, i % 3 == 0, seq, query, r.randrange(4)))
    want = {}
    for g, rev, first, seq, query, offset in table:
        for i in range(len(seq) - 2):
            base = (query or "")[offset + i : offset + i + 1]
            if re.match("[ACGT][CG][ACGT]$", seq[i : i + 3]) and base and base in "ACGT":
                key = (g, rev, first, seq[i : i + 3], base)
                want[key] = want.get(key, 0) + 1
    names = ["g", "_reverse", "_first", "_seq", "_query", "_offset"]
    kinds = [pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*table, strict=True), kinds, strict=True)], names=names)
    for cut in (200, 7):
        got = {}
        for b in Q._context_counts((batch.slice(i, cut) for i in range(0, 200, cut)), names[:3]):
            for *key, n in zip(*b.to_pydict().values(), strict=True):
                got[tuple(key)] = got.get(tuple(key), 0) + n
        assert got == want
    assert [b.num_rows for b in Q._parts([batch], "_seq", 100)] != [200] and sum(b.num_rows for b in Q._parts([batch], "_seq", 100)) == 200


def test_records_are_laid_out_many_at_a_time(tmp_path):
    """Blocks, virtual offsets and the index as by one record after the other; bins alike."""
    import numpy as np

    from helixtab.sources import bgzf

    r = random.Random(4)
    starts = sorted((r.randrange(2), r.randrange(1 << 22)) for _ in range(3000))
    table = [(ref, at, at + r.choice((1, 50, 40_000)), r.choice((40, 300, 70_000) if i % 500 == 0 else (40, 300))) for i, (ref, at) in enumerate(starts)]
    one, many = bgzf.Writer(str(tmp_path / "one")), bgzf.Writer(str(tmp_path / "many"))
    index, other = bgzf.Index(2), bgzf.Index(2)
    for k, (ref, start, end, size) in enumerate(table):
        if one.held and len(one.held) + size > bgzf.TEXT:
            one.flush()
        first = one.tell()
        one.write(bytes([k % 251]) * size)
        index.add(ref, start, end, first, one.tell())
    for i in range(0, len(table), 700):
        ref, start, end, size = (np.array(c) for c in zip(*table[i : i + 700], strict=True))
        bins = bgzf.bins_of(start, end)
        assert bins.tolist() == [bgzf.bin_of(*x) for x in zip(start.tolist(), end.tolist(), strict=True)]
        first, last = many.write_all(b"".join(bytes([(i + k) % 251]) * n for k, n in enumerate(size.tolist())), np.cumsum(size))
        other.add_all(ref, start, end, bins, first, last)
    one.close(), many.close()
    assert (tmp_path / "one").read_bytes() == (tmp_path / "many").read_bytes() and index.body() == other.body()


def test_lines_of_variants_are_made_by_columns():
    """As text row by row: nulls, empty lists, flags, an INFO of its own, numbers in their shortest form."""
    import pyarrow as pa

    from helixtab.sources import variants

    table = {
        "CHROM": ["1", "1", "2"], "POS": [5, 6, 1], "REF": ["A", None, "é"], "QUAL": [None, 0.1, 30.0], "INFO": [".", None, "OLD=1"], "INFO_DP": [3, None, 10**12],
        "INFO_AF": [[0.5, None], None, []], "INFO_DB": [True, False, None], "s1": ["0/1", None, "1/1"],
    }
    batch = pa.RecordBatch.from_pydict(table)
    writer = object.__new__(variants.VcfWriter)
    writer.info = [n for n in table if n.startswith("INFO_")]
    columns = [*variants.FIXED, "s1"]
    want = ["1\t5\t.\tA\t.\t.\t.\tDP=3;AF=0.5,.;DB\t.\t0/1\n", "1\t6\t.\t.\t.\t0.1\t.\t.\t.\t.\n", "2\t1\t.\té\t.\t30.0\t.\tDP=1000000000000;AF=;OLD=1\t.\t1/1\n"]
    assert writer._lines(batch, columns).to_pylist() == want
    assert [x for i in range(3) for x in writer._lines(batch.slice(i, 1), columns).to_pylist()] == want
