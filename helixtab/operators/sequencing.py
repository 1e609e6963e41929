"""What a sequencing run's report computes from alignments: capture, bias by composition, strand errors, fragments, duplicates.

Alignments: chrom, pos0 (0-based start), flag, cigar, query and whatever columns they are grouped by. All of it is column functions (but for letters and their contexts, counted in Arrow batches),
joins and grouped sums; no window holds more than a tile of a target, a chunk of reference or a histogram.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators import intervals as I  # noqa: E741
from helixtab.operators.scans import kept

#: Fixed values of the usual report: depths that are reported, bases around a bait that are near it, window of composition, unknown bases in one.
LEVELS, NEAR, GC_WINDOW, MOST_UNKNOWN = (1, 2, 10, 20, 30, 40, 50, 100), 250, 100, 4
#: Bases of a target that are scanned at once.
TILE = 4096


def aligned_blocks(cigar: Column, pos0: Column) -> Column:
    """array of struct(start, end, offset): the stretches of reference (0-based, closed) that a read lies on without a gap, and where each begins in the read."""
    kind = "array<struct<start: long, end: long, offset: int>>"
    zero = F.struct(pos0.cast("long").alias("ref"), F.lit(0).alias("read"), F.expr("array()").cast(kind).alias("blocks"))

    def step(a: Column, o: Column) -> Column:
        both = o["op"].isin("M", "=", "X")
        ref = a["ref"] + F.when(both | o["op"].isin("D", "N"), o["n"]).otherwise(0)
        read = a["read"] + F.when(both | o["op"].isin("I", "S"), o["n"]).otherwise(0)
        own = F.struct(a["ref"].alias("start"), (a["ref"] + o["n"] - 1).alias("end"), a["read"].alias("offset"))
        return F.struct(ref.alias("ref"), read.alias("read"), F.when(both, F.array_append(a["blocks"], own)).otherwise(a["blocks"]).alias("blocks"))

    return F.aggregate(X.cigar_operations(cigar), zero, step, lambda a: a["blocks"])


def unclipped_end(cigar: Column, pos0: Column, reverse: Column) -> Column:
    """Where the first base that was read would lie on the reference, clipped ones counted (0-based)."""
    clip = lambda pattern: F.aggregate(F.regexp_extract_all(F.regexp_extract(cigar, pattern, 0), F.lit(r"(\d+)"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    length = F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return F.when(reverse, pos0 + length - 1 + clip(r"(?:\d+[SH])+$")).otherwise(pos0 - clip(r"^(?:\d+[SH])+"))


# ---------------------------------------------------------------- capture


def _shared(blocks: DataFrame, regions: DataFrame, group: str, name: str) -> DataFrame:
    """(group, name): bases of blocks in regions that don't overlap each other."""
    own = regions.select(F.col("chrom").alias("r_chrom"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    met = I.overlap_join(blocks, own, ("start", "end"), ("r_start", "r_end"), (("chrom", "r_chrom"),))
    return met.groupBy(group).agg(F.sum(F.least("end", "r_end") - F.greatest("start", "r_start") + 1).alias(name))


def target_depths(blocks: DataFrame, targets: DataFrame, group: str, tile: int = TILE) -> DataFrame:
    """(group, chrom, target, target_end, depth, n): runs of n bases of equal depth, above 0, in targets that don't overlap each other.

    Targets are cut into tiles, and places where the depth changes are summed before the running sum, so neither a
    long target nor one that most reads lie on is more than a tile's places.
    """
    cut = lambda k: F.explode(F.sequence(F.floor(F.col("start") / k), F.floor(F.col("end") / k)))
    pieces = targets.select(F.col("chrom").alias("t_chrom"), F.col("start").alias("target"), F.col("end").alias("target_end"), cut(tile).alias("_t"))
    pieces = pieces.withColumn("_from", F.greatest("target", F.col("_t") * tile)).withColumn("_to", F.least("target_end", (F.col("_t") + 1) * tile - 1))
    own = blocks.select(group, "chrom", "start", "end", cut(tile).alias("_tile"))
    met = own.join(pieces, (F.col("chrom") == F.col("t_chrom")) & (F.col("_tile") == F.col("_t")) & (F.col("start") <= F.col("_to")) & (F.col("end") >= F.col("_from")))
    clipped = met.select(group, "chrom", "target", "target_end", "_t", F.greatest("start", "_from").alias("_a"), F.least("end", "_to").alias("_b"))
    keys = [group, "chrom", "target", "target_end", "_t"]
    changes = I.depth(clipped, keys, "_a", "_b")
    after = F.lead("position").over(Window.partitionBy(*keys).orderBy("position"))
    return changes.withColumn("n", after - F.col("position")).where("depth > 0").select(*keys[:-1], "depth", "n")


def _least_depth(share: float, running: str, none: str, total: str) -> Column:
    """The smallest depth that holds a share of total bases, of which none have depth 0; an aggregate over a histogram."""
    wanted = F.first(total) * share
    return F.when(F.first(none) >= wanted, 0).otherwise(F.min(F.when(F.col(running) + F.col(none) >= F.col(total) * share, F.col("depth"))))


def capture_metrics(blocks: DataFrame, targets: DataFrame, baits: DataFrame, group: str, near: int = NEAR, levels: tuple[int, ...] = LEVELS, tile: int = TILE) -> DataFrame:
    """How well targets are covered, a row per group.

    blocks: group, chrom, start, end (closed), one for each aligned stretch of a read; targets, baits: chrom, start, end, which may
    overlap. Returns n_targets, target_bases, bases (all aligned), on_bait, near_bait, off_bait, on_target (bases), mean_coverage,
    median_coverage, fold_80 (mean over the depth that 80 % of bases reach, in targets that have a read; null where that is 0),
    zero_targets (share of targets without a read), share_ge_N (of target bases). A group without a read on target has zeros.
    """
    own = blocks.select(group, "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    spans = lambda df, by: I.merge(df.select("chrom", (F.col("start").cast("long") - by).alias("start"), (F.col("end").cast("long") + by).alias("end")), ["chrom"], "start", "end", width=1 << 20)
    target, bait, around = spans(targets, 0), spans(baits, 0), spans(baits, near)
    runs = target_depths(own, target, group, tile)
    total = target.agg(F.count("*").alias("n_targets"), F.coalesce(F.sum(F.col("end") - F.col("start") + 1), F.lit(0)).alias("target_bases"))
    seen = runs.groupBy(group, "chrom", "target").agg(F.first(F.col("target_end") - F.col("target") + 1).alias("size")).groupBy(group).agg(F.count("*").alias("seen"), F.sum("size").alias("seen_bases"))
    histogram = runs.groupBy(group, "depth").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(group)
    histogram = histogram.join(seen, group).join(F.broadcast(total)).withColumn("running", F.sum("n").over(by.orderBy("depth"))).withColumn("covered", F.sum("n").over(by))
    histogram = histogram.withColumn("none", F.col("target_bases") - F.col("covered")).withColumn("seen_none", F.col("seen_bases") - F.col("covered"))
    on_target = F.sum(F.col("depth") * F.col("n"))
    found = histogram.groupBy(group).agg(
        on_target.alias("on_target"), _least_depth(0.5, "running", "none", "target_bases").alias("median_coverage"), _least_depth(0.2, "running", "seen_none", "seen_bases").alias("_low"),
        F.first("seen").alias("_seen"), F.first("seen_bases").alias("_seen_bases"), *(F.sum(F.when(F.col("depth") >= k, F.col("n")).otherwise(0)).alias(f"_ge_{k}") for k in levels),
    )
    every = own.groupBy(group).agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"))
    out = every.join(F.broadcast(total)).join(_shared(own, bait, group, "_bait"), group, "left").join(_shared(own, around, group, "_around"), group, "left").join(found, group, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = lambda c, of: F.when(F.col(of) > 0, c / F.col(of))
    return out.select(
        group, "n_targets", "target_bases", "bases", zero("_bait").alias("on_bait"), (zero("_around") - zero("_bait")).alias("near_bait"), (F.col("bases") - zero("_around")).alias("off_bait"), zero("on_target").alias("on_target"),
        share(zero("on_target"), "target_bases").alias("mean_coverage"), zero("median_coverage").alias("median_coverage"), F.when(F.col("_low") > 0, F.col("on_target") / F.col("_seen_bases") / F.col("_low")).alias("fold_80"),
        share(F.col("n_targets") - zero("_seen"), "n_targets").alias("zero_targets"), *(share(zero(f"_ge_{k}"), "target_bases").alias(f"share_ge_{k}") for k in levels),
    )


# ---------------------------------------------------------------- bias by composition


def composition_windows(reference: DataFrame, size: int = GC_WINDOW, most_unknown: int = MOST_UNKNOWN) -> DataFrame:
    """(chrom, pos0, gc): the percentage of G and C (rounded down) of each window of size bases that has most_unknown N at most.

    reference: ref_chrom, chunk_no, seq, chunks of one length of size - 1 bases or more. A chunk borrows the first bases of the next one, so
    windows over their border are counted once; sums run within a chunk.
    """
    following = reference.select(F.col("ref_chrom").alias("_c"), (F.col("chunk_no") - 1).alias("_k"), F.substring("seq", 1, size - 1).alias("_more"))
    whole = reference.join(following, (F.col("ref_chrom") == F.col("_c")) & (F.col("chunk_no") == F.col("_k")), "left")
    longest = reference.agg(F.max(F.length("seq")).alias("_chunk"))
    bases = whole.select("ref_chrom", "chunk_no", F.length("seq").alias("_own"), F.posexplode(F.split(F.upper(F.concat("seq", F.coalesce("_more", F.lit("")))), "")).alias("_at", "_base"))
    by = Window.partitionBy("ref_chrom", "chunk_no").orderBy("_at")
    is_gc, unknown = F.col("_base").isin("G", "C").cast("int"), (F.col("_base") == "N").cast("int")
    sums = bases.withColumn("_gc", F.sum(is_gc).over(by)).withColumn("_n", F.sum(unknown).over(by)).withColumn("_gc0", F.col("_gc") - is_gc).withColumn("_n0", F.col("_n") - unknown)
    last = lambda c: F.lead(c, size - 1).over(by)
    windows = sums.withColumn("_gc", last("_gc") - F.col("_gc0")).withColumn("_n", last("_n") - F.col("_n0")).where((F.col("_at") < F.col("_own")) & (F.col("_n") <= most_unknown))
    return windows.join(F.broadcast(longest)).select(F.col("ref_chrom").alias("chrom"), (F.col("chunk_no") * F.col("_chunk") + F.col("_at")).alias("pos0"), F.floor(F.col("_gc") * 100 / size).cast("int").alias("gc"))


def composition_bias(alignments: DataFrame, windows: DataFrame, group: str, size: int = GC_WINDOW) -> DataFrame:
    """(group, gc, windows, reads, coverage, error): reads that start a window of each composition, and that over what an even spread gives.

    alignments: group, chrom, pos0, end0 (exclusive), flag. A read of the reverse strand starts the window that it ends. error is
    coverage over the root of reads. All 101 percentages with windows have a row for each group.
    """
    reverse = F.col("flag").bitwiseAND(16) != 0
    starts = alignments.where(F.col("flag").bitwiseAND(4) == 0).select(group, F.col("chrom").alias("_c"), F.when(reverse, F.col("end0") - size).otherwise(F.col("pos0")).alias("_p"))
    counted = starts.groupBy(group, "_c", "_p").agg(F.count("*").alias("reads"))
    hit = counted.join(windows, (F.col("_c") == F.col("chrom")) & (F.col("_p") == F.col("pos0"))).groupBy(group, "gc").agg(F.sum("reads").alias("reads"))
    levels = windows.groupBy("gc").agg(F.count("*").alias("windows"))  # 101 rows at most
    every = alignments.select(group).distinct().withColumn("gc", F.explode(F.sequence(F.lit(0), F.lit(100)))).join(F.broadcast(levels), "gc")
    out = every.join(hit, [group, "gc"], "left").withColumn("reads", F.coalesce("reads", F.lit(0)))
    by = Window.partitionBy(group)
    mean = F.sum("reads").over(by) / F.sum("windows").over(by)
    out = out.withColumn("_mean", mean).withColumn("coverage", F.when(F.col("_mean") > 0, F.col("reads") / F.col("windows") / F.col("_mean")))
    return out.withColumn("error", F.when(F.col("reads") > 0, F.col("coverage") / F.sqrt("reads"))).select(group, "gc", "windows", "reads", "coverage", "error")


# ---------------------------------------------------------------- strand errors


#: Letters that have a context, by number; other letters are 4.
_LETTERS = "ACGT"
_NUMBERS = np.full(256, 4, np.int64)
_NUMBERS[list(_LETTERS.encode())] = range(4)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts (null: empty), one for each character, and where each begins and the last ends."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    if pc.sum(pc.binary_length(texts)).as_py() != pc.sum(pc.utf8_length(texts)).as_py():
        texts = pc.replace_substring_regex(texts, "[^\\x00-\\x7F]", "N")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8), bounds


def _parts(batches, column: str, most: int = 1 << 20):
    """Batches cut so that the texts of a column have so many bytes in each, or are one."""
    for b in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(b[column]), 0).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(total // most)) + 1).tolist(), b.num_rows]
        yield from (b.slice(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False) if y > x)


def _context_counts(batches, own: list[str]):
    """(own, context, base, n) of rows (own, _seq, _query, _offset): base i of the query from _offset on stands below letter i + 1 of _seq, whose context it counts for."""
    for b in _parts(batches, "_seq"):
        keys = pa.Table.from_batches([b.select(own)]).append_column("_row", pa.array(np.arange(b.num_rows)))
        groups = keys.group_by(own).aggregate([("_row", "list")])
        group = np.empty(b.num_rows, np.int64)
        rows = groups["_row_list"].combine_chunks()
        group[rows.flatten().to_numpy()] = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
        (seq, s), (query, q), offset = _bytes(b["_seq"]), _bytes(b["_query"]), b["_offset"].to_numpy().astype(np.int64)
        n = np.clip(np.minimum(np.diff(s) - 2, np.diff(q) - offset), 0, None)
        if not n.sum():
            continue
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(s[:-1], n) + nth
        letters = [_NUMBERS[seq[at + i]] for i in range(3)] + [_NUMBERS[query[np.repeat(q[:-1] + offset, n) + nth]]]
        good = (np.maximum.reduce(letters) < 4) & ((letters[1] == 1) | (letters[1] == 2))
        code = np.repeat(group, n)
        for x in letters:
            code = code * 4 + x
        count = np.bincount(code[good], minlength=256 * len(groups))
        found = np.flatnonzero(count)
        text = [np.array(list(_LETTERS))[found >> 2 * i & 3] for i in (3, 2, 1, 0)]
        context = pa.array(["".join(x) for x in zip(*text[:3], strict=True)], pa.string())
        part = groups.select(own).take(pa.array(found >> 8)).combine_chunks()
        values = [part[c].combine_chunks() if isinstance(part[c], pa.ChunkedArray) else part[c] for c in own]
        yield pa.RecordBatch.from_arrays([*values, context, pa.array(text[3].tolist(), pa.string()), pa.array(count[found])], names=[*own, "context", "base", "n"])


def strand_context_errors(alignments: DataFrame, reference: DataFrame, group: str, chunk: int) -> DataFrame:
    """(group, context, bases, ref_marked, alt_marked, ref_other, alt_other, rate, quality): errors C>A (or G>T) by the bases on both sides of a C.

    Oxidised bases are read as G>T in first reads and C>A in second ones, in a read's own direction (marked); true variants are in
    both directions (other). rate: the surplus of marked errors over all bases, 1e-10 at least; quality: the same in Phred. alignments: group, chrom, pos0, flag,
    cigar, query; reference: ref_chrom, chunk_no, seq with chunk bases a row. Bases at a sequence's ends or beside one that isn't A, C, G
    or T have no context. Counts are summed by what is seen before they are turned to the strand of the C.
    """
    blocks = alignments.select(group, "chrom", "flag", "query", F.explode(aligned_blocks(F.col("cigar"), F.col("pos0"))).alias("_b"))
    first = F.greatest(F.col("_b.start"), F.lit(1))  # the first base of a sequence has none before it
    blocks = blocks.select(group, "chrom", "flag", "query", first.alias("_start"), F.col("_b.end").alias("_end"), (F.col("_b.offset") + first - F.col("_b.start")).cast("int").alias("_offset")).where("_start <= _end")
    blocks = blocks.withColumn("_from", F.col("_start")).withColumn("_to", F.col("_end") + 2)  # 1-based, with a base on each side
    seen = I.fetch(blocks, reference, "chrom", "_from", "_to", "_seq", chunk)
    seen = seen.where("_seq is not null").select(group, (F.col("flag").bitwiseAND(16) != 0).alias("_reverse"), (F.col("flag").bitwiseAND(128) == 0).alias("_first"), F.upper("_seq").alias("_seq"), F.upper("query").alias("_query"), "_offset")
    own = [group, "_reverse", "_first"]
    kind = seen.select(*own).schema.add("context", "string").add("base", "string").add("n", "long")
    counts = seen.mapInArrow(lambda batches: _context_counts(batches, own), kind).groupBy(*own, "context", "base").agg(F.sum("n").alias("n"))
    on_c = F.substring("context", 2, 1) == "C"
    turned = counts.select(
        group, F.when(on_c, F.col("context")).otherwise(X.reverse_complement(F.col("context"))).alias("context"), F.when(on_c, F.col("base")).otherwise(X.complement(F.col("base"))).alias("_base"),
        ((on_c == F.col("_reverse")) == F.col("_first")).alias("_marked"), "n",
    )
    total = lambda base, marked: F.sum(F.when((F.col("_base") == base) & (F.col("_marked") == marked), F.col("n")).otherwise(0))
    out = turned.where("_base in ('C', 'A')").groupBy(group, "context").agg(F.sum("n").alias("bases"), total("C", True).alias("ref_marked"), total("A", True).alias("alt_marked"), total("C", False).alias("ref_other"), total("A", False).alias("alt_other"))
    rate = F.greatest((F.col("alt_marked") - F.col("alt_other")) / F.col("bases"), F.lit(1e-10))
    return out.withColumn("rate", rate).withColumn("quality", -10 * F.log10("rate"))


# ---------------------------------------------------------------- fragments


def orientation(flag: Column, insert_size: Column) -> Column:
    """Which way a pair's ends point, left end first: as F1R2 for a first read forward on the left of its mate."""
    bit = lambda n: flag.bitwiseAND(n) != 0
    way, number = lambda b: F.when(b, "R").otherwise("F"), lambda b: F.when(b, "1").otherwise("2")
    own, mate = F.concat(way(bit(16)), number(bit(64))), F.concat(way(bit(32)), number(~bit(64)))
    return F.when(insert_size >= 0, F.concat(own, mate)).otherwise(F.concat(mate, own))


def _pairs(alignments: DataFrame) -> DataFrame:
    """Alignments of pairs on one sequence, with the pair's model and length."""
    usable = (F.col("flag").bitwiseAND(1) != 0) & (F.col("flag").bitwiseAND(4 + 8 + 256 + 2048) == 0) & (F.col("insert_size") != 0)
    return alignments.where(usable).withColumn("model", orientation(F.col("flag"), F.col("insert_size"))).withColumn("length", F.abs(F.col("insert_size")).cast("long"))


def fragment_models(alignments: DataFrame, group: str, deviations: float = 10.0, unlike: float = 0.1) -> DataFrame:
    """(group, pairs, model_1, model_2, median, mad, low, high, unlike, ambiguous): what a group's pairs look like.

    The two most frequent orientations are its models. Lengths are those of their pairs: median, median absolute deviation, and the
    bounds median +- deviations * mad (1 at least), which leave chimeric tails out. unlike: share of pairs of other orientations; ambiguous if that is
    above the limit or a second orientation isn't the first one's mirror. Of each pair the first read counts. Alignments: group, flag, insert_size.
    """
    first = _pairs(alignments).where(F.col("flag").bitwiseAND(64) != 0)
    lengths = first.groupBy(group, "model", "length").agg(F.count("*").alias("n"))  # all that follows is counted from these
    counts = lengths.groupBy(group, "model").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(group)
    ranked = counts.withColumn("nth", F.row_number().over(by.orderBy(F.desc("n"), "model"))).withColumn("pairs", F.sum("n").over(by))
    top = ranked.where("nth <= 2").groupBy(group).agg(F.first("pairs").alias("pairs"), F.max(F.when(F.col("nth") == 1, F.col("model"))).alias("model_1"), F.max(F.when(F.col("nth") == 2, F.col("model"))).alias("model_2"), F.sum("n").alias("_n"))
    own = lengths.join(top, group).where((F.col("model") == F.col("model_1")) | (F.col("model") == F.col("model_2")))
    middle = own.groupBy(group).agg(F.percentile("length", 0.5, F.col("n")).alias("median"))
    spread = own.join(middle, group).groupBy(group).agg(F.first("median").alias("median"), F.percentile(F.abs(F.col("length") - F.col("median")), 0.5, F.col("n")).alias("mad"))
    mirror = F.translate(F.col("model_1"), "12", "21")
    share = 1 - F.col("_n") / F.col("pairs")
    return top.join(spread, group).select(
        group, "pairs", "model_1", "model_2", "median", "mad", F.greatest(F.lit(1.0), F.col("median") - deviations * F.col("mad")).alias("low"), (F.col("median") + deviations * F.col("mad")).alias("high"),
        share.alias("unlike"), ((share > unlike) | (F.coalesce(F.col("model_2") != mirror, F.lit(False)))).alias("ambiguous"),
    )


def resolved(alignments: DataFrame, models: DataFrame, group: str) -> DataFrame:
    """alignments of pairs with proper: whether the pair has one of its group's models and a length within bounds; never in an ambiguous group. models has one row for each group and goes to every task: by group, a few tasks would hold all rows."""
    bounds = models.select(group, "model_1", "model_2", "low", "high", "ambiguous")
    fits = F.col("length").between(F.col("low"), F.col("high")) & ((F.col("model") == F.col("model_1")) | F.coalesce(F.col("model") == F.col("model_2"), F.lit(False)))
    return _pairs(alignments).join(F.broadcast(bounds), group).withColumn("proper", fits & ~F.col("ambiguous")).select(*alignments.columns, "proper")


# ---------------------------------------------------------------- duplicates


def library_size(pairs: Column, unique: Column, steps: int = 60) -> Column:
    """Fragments in a library of which so many pairs were read and so many are different: the x with unique / x = 1 - exp(-pairs / x).

    Bisection in a column expression; null unless some, but not all, pairs are duplicates.
    """
    n, c = pairs.cast("double"), unique.cast("double")
    value = lambda m: c / (m * c) - 1 + F.exp(-n / (m * c))  # noqa: E731  falls through 0 at the answer, m times unique
    wide = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.lit(100.0), lambda m, _: F.when(value(m) > 0, m * 10).otherwise(m))
    zero = F.struct(F.lit(1.0).alias("low"), wide.alias("high"))

    def step(a: Column, _: Column) -> Column:
        mid = (a["low"] + a["high"]) / 2
        return F.when(value(mid) > 0, F.struct(mid.alias("low"), a["high"].alias("high"))).otherwise(F.struct(a["low"].alias("low"), mid.alias("high")))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, step, lambda a: c * (a["low"] + a["high"]) / 2)
    return F.when((pairs > unique) & (unique > 0), F.floor(found))


def fragments(alignments: DataFrame, library: str) -> DataFrame:
    """(library, read_name, paired, chrom_a, end_a, reverse_a, chrom_b, end_b, reverse_b, weight): a row for each mapped read pair or single read, by its unclipped 5' ends, the lesser first.

    alignments: library, read_name, flag, chrom, pos0, cigar, weight (such as the sum of base qualities). Secondary and supplementary
    alignments are left out.
    """
    reverse = F.col("flag").bitwiseAND(16) != 0
    end = F.struct(F.col("chrom").alias("chrom"), unclipped_end(F.col("cigar"), F.col("pos0"), reverse).alias("end"), reverse.alias("reverse"))
    mapped = alignments.where(F.col("flag").bitwiseAND(4 + 256 + 2048) == 0).select(library, "read_name", "weight", end.alias("_e"))
    by = mapped.groupBy(library, "read_name").agg(F.min("_e").alias("a"), F.max("_e").alias("b"), F.count("*").alias("_n"), F.sum("weight").alias("weight"))
    paired = F.col("_n") > 1
    other = lambda c: F.when(paired, F.col(f"b.{c}")).alias(f"{c}_b")
    return by.select(library, "read_name", paired.alias("paired"), *(F.col(f"a.{c}").alias(f"{c}_a") for c in ("chrom", "end", "reverse")), *map(other, ("chrom", "end", "reverse")), "weight")


def marked_fragments(found: DataFrame, library: str, distance: int = 100, name: str = r"(\d+):(\d+):(\d+)$") -> DataFrame:
    """fragments() with duplicate and optical.

    Of pairs with equal ends the one of the largest weight (then the least name) is no duplicate; a single read is also one if a pair has its
    end. Optical: a duplicate pair that lies on the tile of another of its set of better rank, within distance on both axes; name takes tile, x and y from the read's name. Places of a tile meet by
    neighbouring squares, each once for all its pairs, and only the best pair of a place counts for others.
    """
    ends = [library, "chrom_a", "end_a", "reverse_a", "chrom_b", "end_b", "reverse_b"]
    found = kept(found, "fragments")  # pairs, their places and single reads each read it
    best = Window.partitionBy(*ends).orderBy(F.desc("weight"), "read_name")
    part = lambda i: F.regexp_extract("read_name", name, i).try_cast("long")
    pairs = found.where("paired").withColumn("rank", F.row_number().over(best)).select("*", part(1).alias("tile"), part(2).alias("x"), part(3).alias("y"))
    # of the pairs at a place of a tile the best is enough; the keys begin with the ends, by which pairs lie together already
    place = [*ends, "tile", "x", "y"]
    places = pairs.where("tile is not null and x is not null and y is not null").groupBy(*place).agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
    cell = lambda c: F.floor(F.col(c) / (distance + 1))
    spread = F.explode(F.array(*(F.struct((cell("x") + i).alias("cx"), (cell("y") + j).alias("cy"), F.lit(i == j == 0).alias("own")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    # a square and those around it have at most 9 * (distance + 1) ** 2 places, so they are looked at in one list
    at = F.struct("x", "y", "least")
    squares = places.select(*ends, "tile", at.alias("_at"), "most", spread.alias("_c")).groupBy(*ends, "tile", "_c.cx", "_c.cy").agg(F.collect_list("_at").alias("_near"), F.collect_list(F.when(F.col("_c.own") & (F.col("most") > 1), F.struct("_at.x", "_at.y"))).alias("_own"))
    close = lambda o: (F.abs(o["x"] - F.col("_p.x")) <= distance) & (F.abs(o["y"] - F.col("_p.y")) <= distance)
    asked = squares.select(*ends, "tile", "_near", F.explode("_own").alias("_p"))
    around = asked.select(*(F.col(c).alias(f"n_{c}") for c in (*ends, "tile")), F.col("_p.x").alias("n_x"), F.col("_p.y").alias("n_y"), F.array_min(F.transform(F.filter("_near", close), lambda o: o["least"])).alias("_around"))
    pairs = pairs.join(around, reduce(and_, [F.col(c) == F.col(f"n_{c}") for c in place]), "left")
    pairs = pairs.withColumn("duplicate", F.col("rank") > 1).withColumn("optical", F.coalesce(F.col("_around") < F.col("rank"), F.lit(False)))
    one = [library, "chrom_a", "end_a", "reverse_a"]
    at = lambda s: found.where("paired").select(library, *(F.col(f"{c}_{s}").alias(f"{c}_a") for c in ("chrom", "end", "reverse")))
    taken = at("a").unionAll(at("b")).distinct().withColumn("_taken", F.lit(True))
    single = found.where("not paired").join(taken, one, "left")
    nth = F.row_number().over(Window.partitionBy(*one).orderBy(F.desc("weight"), "read_name"))
    single = single.withColumn("duplicate", (nth > 1) | F.coalesce("_taken", F.lit(False))).withColumn("optical", F.lit(False))
    columns = [*found.columns, "duplicate", "optical"]
    return pairs.select(*columns).unionAll(single.select(*columns))


def duplicate_metrics(marked: DataFrame, library: str) -> DataFrame:
    """(library, pairs, singles, duplicate_pairs, duplicate_singles, optical_pairs, share, library_size) of marked_fragments(); share is of reads, optical pairs don't count in the library's size."""
    n = lambda c: F.count_if(c)
    paired, duplicate = F.col("paired"), F.col("duplicate")
    out = marked.groupBy(library).agg(
        n(paired).alias("pairs"), n(~paired).alias("singles"), n(paired & duplicate).alias("duplicate_pairs"), n(~paired & duplicate).alias("duplicate_singles"), n(F.col("optical")).alias("optical_pairs")
    )
    reads, repeats = F.col("singles") + 2 * F.col("pairs"), F.col("duplicate_singles") + 2 * F.col("duplicate_pairs")
    size = library_size(F.col("pairs") - F.col("optical_pairs"), F.col("pairs") - F.col("duplicate_pairs"))
    return out.withColumn("share", F.when(reads > 0, repeats / reads)).withColumn("library_size", size)
