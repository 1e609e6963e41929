"""SimHash near-dedup by deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that, at the distance allowed, one of
them differs by at most one bit. Each segment is indexed once per wildcard bit; links are
found by equality joins on those variants and verified on the whole fingerprint.

Texts of five-word similarity 0.8 differ by far more bits than segments can allow for, so where that similarity
counts (deduplicated) texts are linked by bands of least shingle hashes too, see similar(), and the pairs of different
components that bands leave are found by prefixes of their shingle sets, see missed().
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.llm import _hashes as H
from helixtab.llm._components import components
from helixtab.llm._util import dropped, in_arrow, read, renamed, shared_dir, stored, tidy

#: Where more different fingerprints than this meet, they are not paired up but cut further.
BUSY = 24
#: Bytes of text from which its words are not held all at once.
LONG = 1 << 20
#: Columns of a row's hash.
ROW = ("_row_a", "_row_b")


def _stretches(text: bytes, size: int):
    """The words of a text, in stretches that overlap by size - 1 words if it is long."""
    if len(text) <= LONG:
        yield text.split()  # of bytes: ASCII white space
        return
    start, end = H.word_bounds(np.frombuffer(text, np.uint8))
    step = LONG // 8
    for at in range(0, max(1, len(start) - size + 1), step):
        part = slice(at, at + step + size - 1)
        yield [text[s:e] for s, e in zip(start[part].tolist(), end[part].tolist(), strict=True)]


def simhash(text: bytes, size: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is in over half of the XXH64 of shingles of size words, repeats included."""
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), 0
    for words in _stretches(text.lower(), size):  # of bytes: A-Z
        if not words:
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :] or ends[-1:], strict=False)]
        n += len(hashes)
        for i in range(0, len(hashes), 4096):
            part = np.array(hashes[i : i + 4096], np.uint64)
            counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) of each row, and its keys (longs)."""

    def run(batches):
        for b in batches:
            fp = [simhash(t.as_buffer().to_pybytes(), size) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp, pa.int64()), *(b[k] for k in keys)], names=["doc_id", "fp", *keys])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keys)
    return in_arrow(rows, run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keys)))


def _long(bits) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _of(values: list, index: str):
    """The element of a fixed list that a column picks."""
    kind = (lambda v: F.array(*map(F.lit, v))) if isinstance(values[0], list) else F.lit
    return F.element_at(F.array(*map(kind, values)), F.col(index) + 1)


def _stars(rows: DataFrame, key: list[str]) -> DataFrame:
    """A link from each fp to the least under its key."""
    least = rows.groupBy(*key).agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n").hint("merge")
    return rows.join(least, key).where("fp != b").select(F.col("fp").alias("a"), "b")


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): links that connect all fp of distance or fewer differing bits; fps: distinct fp.

    Bits are cut into two halves, one of which differs by one bit at most. Either it differs in
    one bit: fingerprints meet under that half with this bit as a wildcard, on different sides
    of it, and the other half may differ by distance - 1. Or it is equal: they meet under it,
    and the other half may differ by distance. Where few meet, pairs are verified. Where many
    do, those of the first kind meet again under variants of the other half with as many
    wildcards as it may differ by, and are linked to the least of them, as all that agree there
    are near; those of the second kind have their other half cut in the same way, then to
    variants. So no group's pairs are all made, and no link between groups is lost. Variants are 64-fold what Spark
    takes them for, as it sizes tables by the files that they come from: their joins are told not to broadcast.
    """
    if not 1 <= distance <= 3:
        raise ValueError("distance must be 1, 2 or 3")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found: list[DataFrame] = []

    def wildcards(rest: list[int], k: int) -> list[int]:
        return [_long(set(rest) - set(gone)) for gone in combinations(rest, min(k, len(rest)))]

    branches: list[tuple[list[int], list[int]]] = [([], list(range(64)))]  # bits that are equal, the others
    # each is taken 64-fold, so they are dealt out first, by a number that adaptive execution keeps
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fps.select("fp", F.lit(0).alias("branch")).repartition(n, F.xxhash64("fp"))
    for depth in range(2):
        cross, equal = [], []  # (branch, mask, bit, other half), (branch, mask, equal bits, other half)
        for i, (same, rest) in enumerate(branches):
            halves = rest[: len(rest) // 2], rest[len(rest) // 2 :]
            for half, other in (halves, halves[::-1]):
                equal.append((i, _long(same + half), same + half, other))
                cross += [(i, _long(set(same + half) - {bit}), bit, other) for bit in half]
        ids = [[j for j, x in enumerate(cross) if x[0] == i] for i in range(len(branches))]
        variants = rows.select("fp", F.explode(_of(ids, "branch")).alias("id")).select("fp", "id", F.col("fp").bitwiseAND(_of([x[1] for x in cross], "id")).alias("part"))
        variants = variants.withColumn("bit", _of([x[2] for x in cross], "id")).withColumn("side", F.expr("shiftright(fp, bit) & 1"))
        sizes = variants.groupBy("id", "part").agg(F.count("*").alias("n"), F.sum("side").alias("ones")).where("ones > 0 and ones < n").hint("merge")
        met = stored(variants.join(sizes, ["id", "part"]).withColumn("fewer", F.least("ones", F.expr("n - ones"))), f"variants{depth}")
        few = met.where(F.col("fewer") <= BUSY)
        zeros, ones = (few.where(F.col("side") == i).select("id", "part", F.col("fp").alias(c)) for i, c in enumerate("ab"))
        found.append(zeros.join(ones.hint("merge"), ["id", "part"]).where(near).select("a", "b"))
        many = met.where(F.col("fewer") > BUSY).select("fp", "id", "part", F.posexplode(_of([wildcards(x[3], distance - 1) for x in cross], "id")).alias("nth", "mask"))
        found.append(_stars(many.select("fp", "id", "part", "nth", F.col("fp").bitwiseAND(F.col("mask")).alias("rest")), ["id", "part", "nth", "rest"]))

        ids = [[j for j, x in enumerate(equal) if x[0] == i] for i in range(len(branches))]
        alike = rows.select("fp", F.explode(_of(ids, "branch")).alias("id")).select("fp", "id", F.col("fp").bitwiseAND(_of([x[1] for x in equal], "id")).alias("part"))
        sizes = alike.groupBy("id", "part").agg(F.count("*").alias("n")).where("n > 1").hint("merge")
        met = stored(alike.join(sizes, ["id", "part"]), f"equal{depth}")
        few = met.where(F.col("n") <= BUSY).select("id", "part", F.col("fp").alias("a"))
        found.append(few.join(few.withColumnRenamed("a", "b").hint("merge"), ["id", "part"]).where(near & F.expr("a < b")).select("a", "b"))
        rows = met.where(F.col("n") > BUSY).select("fp", F.col("id").alias("branch"), "part")
        branches = [(x[2], x[3]) for x in equal]
    last = rows.select("fp", "branch", "part", F.posexplode(_of([wildcards(rest, distance) for _, rest in branches], "branch")).alias("nth", "mask"))
    found.append(_stars(last.select("fp", "branch", "part", "nth", F.col("fp").bitwiseAND(F.col("mask")).alias("rest")), ["branch", "part", "nth", "rest"]))
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    return every.distinct()


def _rooted(classes: DataFrame, distance: int, more: DataFrame | None = None) -> DataFrame:
    """classes (one row for each fp) with root, the least fp of the component; more: further links."""
    known = links(classes.select("fp"), distance)
    reached = components(known if more is None else known.unionAll(more)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return classes.join(reached, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


#: Least hashes of a text's shingles, and how many of them make a band: a pair of similarity 0.8 shares one of 21 with probability 0.998.
MINIMA, BAND = 128, 6
#: Centres of a band at a time.
CENTRES = 16
#: Standard errors below the similarity asked up to which the share of equal minima lets a pair be compared whole: fewer than 1 of 10,000 pairs that are alike stay under it.
SLACK = 4
_FACTORS = H.mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(H.BASE)) | np.uint64(1)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The different hashes of a text's shingles, sorted; a text of fewer words is one shingle, one without words none."""
    values = H.word_values(np.frombuffer(text.lower(), np.uint8))
    return np.unique(H.mix(H.every(H.prefix(values), min(size, len(values))))) if len(values) else values


def minima(hashes: np.ndarray) -> np.ndarray | None:
    """The least of a text's shingle hashes under each of MINIMA orders; None without any."""
    if not len(hashes):
        return None
    out = np.full(MINIMA, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(out, (hashes[at : at + 1024, None] * _FACTORS).min(axis=0), out=out)
    return out


def alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether the sets x and y (sorted) have that share of their union in common, or more."""
    most = min(len(x), len(y))
    if most < similarity * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate((x, y)), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def _banded(docs: DataFrame, size: int, words: int, keys: tuple[str, ...]) -> DataFrame:
    """(doc_id, fp, text_key, minima, bands, shingles, low) of each row, and its keys; minima: 16 bits of each; shingles: the upper 32 bits of each hash, sorted; low: the next 16."""

    def run(batches):
        for b in batches:
            texts = [t.as_buffer().to_pybytes() for t in b["text"]]
            fp = [simhash(t, size) for t in texts]
            sets = [shingle_hashes(t, words) for t in texts]
            least = [minima(x) for x in sets]
            text_key = np.array([xxhash.xxh64_intdigest(t, 7) for t in texts], np.uint64).view(np.int64)
            short = [None if m is None else (m >> np.uint64(48)).astype(np.uint16).tobytes() for m in least]
            bands = [[] if m is None else [xxhash.xxh64_intdigest(m[i : i + BAND].tobytes(), i) - (1 << 63) for i in range(0, MINIMA - BAND + 1, BAND)] for m in least]
            whole = [(x >> np.uint64(32)).astype(np.uint32).tobytes() for x in sets]
            low = [(x >> np.uint64(16)).astype(np.uint16).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp, pa.int64()), pa.array(text_key), pa.array(short, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(whole, pa.binary()), pa.array(low, pa.binary()), *(b[k] for k in keys)], names=["doc_id", "fp", "text_key", "minima", "bands", "shingles", "low", *keys])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keys)
    return in_arrow(rows, run, "doc_id long, fp long, text_key long, minima binary, bands array<long>, shingles binary, low binary" + "".join(f", {k} long" for k in keys))


def _by_text(rows: DataFrame) -> tuple[str, DataFrame]:
    """The name of a table and it: (fp, text_key, minima, shingles, low, n, no), each text once, dealt out by fp and text_key: what is joined with it moves, not the sets. n: its shingles; no: its number."""
    spark = rows.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"helixtab_sets_{uuid.uuid4().hex}"
    own = rows.select("fp", "text_key", "minima", "shingles", "low").repartition(n, "fp", "text_key").dropDuplicates(["fp", "text_key"])
    own = own.select("*", F.expr("octet_length(shingles) div 4").alias("n"), F.monotonically_increasing_id().alias("no"))
    path = f"{shared_dir(spark)}/helixtab/{name}"
    own.write.format("parquet").option("path", path).bucketBy(n, "fp", "text_key").saveAsTable(name)
    out = spark.table(name)
    out.helixtab_path = path
    return name, out


#: A pair of texts.
PAIR = ("fp", "text_key", "c_fp", "c_key")


def _verified(asked: DataFrame, sets: DataFrame, similarity: float, least: float | None = None) -> DataFrame:
    """The pairs asked whose sets of shingles are alike; least: share of equal minima under which they aren't compared."""
    minima = [] if least is None else ["minima"]

    def run(batches):
        for b in batches:
            close = [True] * b.num_rows
            if least is not None:
                x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint16).reshape(-1, MINIMA) for c in ("x_minima", "y_minima"))
                close = ((x == y).mean(axis=1) >= least).tolist()
            two = (tuple(np.frombuffer(s.as_buffer(), np.uint32) for s in both) for both in zip(b["x_shingles"], b["y_shingles"], strict=True))
            good = pa.array([c and alike(*both, similarity) for c, both in zip(close, two, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b[c].filter(good) for c in PAIR], names=PAIR)

    brought = [*minima, "shingles"]
    x = asked.join(sets.select("fp", "text_key", *(F.col(c).alias(f"x_{c}") for c in brought)), ["fp", "text_key"])
    both = x.join(sets.select(F.col("fp").alias("c_fp"), F.col("text_key").alias("c_key"), *(F.col(c).alias(f"y_{c}") for c in brought)), ["c_fp", "c_key"])
    return in_arrow(both.select(*PAIR, *(f"{side}_{c}" for side in "xy" for c in brought)), run, ", ".join(f"{c} long" for c in PAIR))


def similar(texts: DataFrame, sets: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(a, b): fp of texts (fp, text_key, bands; rows that repeat a text count once; sets: see _by_text) whose shingle sets are alike enough, as stars.

    Texts meet under equal bands. Where few do, pairs are compared. Where many do, of some classes of hashes the texts that meet
    most others are centres: those that are like one are linked to it and leave the band with the centres. The others meet
    again only where they share a further band too (alike ones share several), and so on, so unlike texts with a passage in
    common part quickly. No group's pairs are all made. A text that is like one that left, but unlike its centre and all others it meets, isn't linked
    there. The share of equal minima rules pairs out that are far from alike; all others are compared by their whole sets of shingles, so no link is made below similarity.
    Links that are left out here, missed() finds.
    """
    least = similarity - SLACK * (similarity * (1 - similarity) / MINIMA) ** 0.5
    band = F.xxhash64("used").alias("band")  # used: the bands that texts under this key share
    spark = texts.sparkSession
    texts = stored(texts.select("fp", "text_key", "bands").dropDuplicates(["fp", "text_key"]), "texts")
    members = stored(texts.select("fp", "text_key", F.explode("bands").alias("used")).select("fp", "text_key", F.array("used").alias("used")).select("*", band), "bands")
    found = None

    name = F.struct("fp", "text_key")
    other = F.struct("c_fp", "c_key")
    while True:
        sizes = stored(members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        met = stored(members.join(sizes, "band"), "met")
        dropped(members, sizes)
        if met.isEmpty():
            dropped(met, texts)
            return spark.createDataFrame([], "a long, b long") if found is None else found
        few, many = met.where(F.col("n") <= BUSY), met.where(F.col("n") > BUSY)
        weighed = many.withColumn("weight", F.sum("n").over(Window.partitionBy("fp", "text_key")))  # a text has few bands
        centres = weighed.groupBy("band", F.pmod("text_key", F.lit(CENTRES))).agg(F.max(F.struct("weight", "fp", "text_key")).alias("c"))
        centres = centres.groupBy("band").agg(F.collect_list(F.struct(F.col("c.fp").alias("c_fp"), F.col("c.text_key").alias("c_key"))).alias("centres"))
        led = stored(many.select("fp", "text_key", "band", "used").join(stored(centres, "centres"), "band"), "led")
        own = few.select("band", F.col("fp").alias("c_fp"), F.col("text_key").alias("c_key"))
        pairs = few.select("fp", "text_key", "band").join(own, "band").where(name > other).select(*PAIR)
        # of all bands of a text at once, so that a centre of several of them is asked for once
        starred = led.groupBy("fp", "text_key").agg(F.collect_set("centres").alias("c")).select("fp", "text_key", F.explode(F.array_distinct(F.flatten("c"))).alias("c")).select("fp", "text_key", "c.*").where(name != other)
        asked = stored(pairs.unionAll(starred).distinct(), "asked")
        like = stored(_verified(asked, sets, similarity, least), "alike")
        dropped(met, asked)
        new = like.where("fp != c_fp").select(F.col("fp").alias("a"), F.col("c_fp").alias("b"))
        found = new if found is None else found.unionAll(new)
        near = like.groupBy("fp", "text_key").agg(F.collect_list(other).alias("near"))
        gone = F.arrays_overlap("centres", "near") | F.array_contains("centres", F.struct(F.col("fp").alias("c_fp"), F.col("text_key").alias("c_key")))
        left = led.join(near, ["fp", "text_key"], "left").where(~F.coalesce(gone, F.lit(False))).select("fp", "text_key", "used").join(texts.select("fp", "text_key", "bands"), ["fp", "text_key"])
        further = left.select("fp", "text_key", "used", F.explode(F.array_except("bands", "used")).alias("more"))
        members = stored(further.select("fp", "text_key", F.array_sort(F.array_append("used", F.col("more"))).alias("used")).distinct().select("*", band), "bands")
        dropped(led)


def _first(n: int, similarity: float) -> int:
    """Of n shingles, put in any order that holds for all texts, so many hold one of the first of every text that is alike."""
    return n - math.ceil(similarity * n - 1e-6) + 1


#: Tokens that are put in order at once, and about as many as meet in a bucket.
BLOCK = 1 << 21
#: Parts, by token, in which tokens of whole texts are dealt out one after the other: less lies on disks at once.
PARTS = 2
#: Bits of the number of a text that tell the texts of one file of sets apart.
IN_FILE = 33


def _packed(values: np.ndarray) -> bytes:
    """Longs byte by byte, all first bytes and so on, compressed."""
    return pa.compress(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n).T.copy().view(np.int64).ravel()


def _tokens(high: pa.Scalar, low: pa.Scalar) -> np.ndarray:
    """48 bits of the hashes of a text's shingles, in order."""
    return np.frombuffer(high.as_buffer(), np.uint32).astype(np.int64) << 16 | np.frombuffer(low.as_buffer(), np.uint16)


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(no, root_no, tokens): the first tokens (see _first) of sets with last; those whose places are in last, an array or null, come after all others."""

    def run(batches):
        for b in batches:
            tokens = [np.zeros(0, np.int64)]
            for high, low, last in zip(b["shingles"], b["low"], b["last"], strict=True):
                own = _tokens(high, low)
                if last.is_valid:
                    late = np.zeros(len(own), bool)
                    late[last.values.to_numpy(zero_copy_only=False)] = True
                    own = np.concatenate((own[~late], own[late]))
                tokens.append(own[: _first(len(own), similarity)])
            ends = pa.array(np.cumsum([0, *map(len, tokens[1:])]), pa.int32())
            yield pa.RecordBatch.from_arrays([b["no"], b["root_no"], pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tokens)))], names=["no", "root_no", "tokens"])

    return in_arrow(sets.select("no", "root_no", "shingles", "low", "last"), run, "no long, root_no long, tokens array<long>")


def _meeting(rows: DataFrame, buckets: int, found: Callable, schema: str, part: int | None = None) -> DataFrame:
    """What found gives for all texts of the same tokens. rows: no, root_no and tokens (array), or else shingles and low. part: of PARTS by token, else all.

    Tokens are dealt into that many buckets. A block of texts gives each bucket its tokens in order, with the number and root of the text of each and the place there, packed. found
    gets arrays by token: where each different one begins, tokens, numbers, places, and whether its texts have different roots.
    """
    columns, parts = ["token", "at", "own", "root"], PARTS

    def deal(batches):
        def out():
            each = [len(h[2]) for h in held]
            no, root = (np.repeat(np.array([h[i] for h in held], np.int64), each) for i in (0, 1))
            token, at = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            order = np.argsort(token % buckets << 48 | token)
            token, no, root, at = (x[order] for x in (token, no, root, at))
            edge = np.searchsorted(token % buckets, np.arange(buckets + 1))
            own = no & (1 << IN_FILE) - 1
            dealt = [(i, file, e - s, *map(_packed, (np.diff(token[s:e], prepend=0), at[s:e], own[s:e], (root - no)[s:e]))) for i, (s, e) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if s < e]
            kinds = (pa.int64(), pa.int64(), pa.int64(), *(pa.binary() for _ in columns))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*dealt, strict=True), kinds, strict=True)], names=["bucket", "file", "n", *columns])

        held, size, file = [], 0, None
        for b in batches:
            tokens = (x.values.to_numpy(zero_copy_only=False) for x in b["tokens"]) if "tokens" in b.schema.names else map(_tokens, b["shingles"], b["low"])
            for no, root, own in zip(b["no"].to_pylist(), b["root_no"].to_pylist(), tokens, strict=True):
                at = np.arange(len(own)) if part is None else np.flatnonzero(own % parts == part)
                own = own[at]
                if not len(own):
                    continue
                if held and (size + len(own) > BLOCK or no >> IN_FILE != file):
                    yield out()
                    held, size = [], 0
                file = no >> IN_FILE
                held.append((no, root, own, at))
                size += len(own)
        if size:
            yield out()

    def meet(table: pa.Table) -> pa.Table:
        got = {c: [] for c in columns}
        for i, file in enumerate(table["file"].to_pylist()):
            token, at, own, root = (_unpacked(table[c][i].as_buffer(), table["n"][i].as_py()) for c in columns)
            no = own | file << IN_FILE
            for c, x in zip(columns, (np.cumsum(token), at, no, no + root), strict=True):
                got[c].append(x)
        token, at, no, root = (np.concatenate(got.pop(c)) for c in columns)
        order = np.argsort(token, kind="stable")
        token, at, no, root = (x[order] for x in (token, at, no, root))
        begin = np.flatnonzero(np.diff(token, prepend=-1))
        return found(begin, token, no, at, np.minimum.reduceat(root, begin) < np.maximum.reduceat(root, begin))

    kept = rows.select(*(c for c in ("no", "root_no", "tokens", "shingles", "low") if c in rows.columns))
    return in_arrow(kept, deal, "bucket long, file long, n long" + "".join(f", {c} binary" for c in columns)).groupBy("bucket").applyInArrow(meet, schema)


def _last(sets: DataFrame, buckets: int, part: int | None = None) -> DataFrame:
    """(no, last): the places, in each text, of tokens that more than BUSY texts have, not all of one root."""
    busy = BUSY

    def found(begin, token, no, at, crossing):
        rows = np.diff(begin, append=len(token))
        kept = np.repeat(crossing & (rows > busy), rows)
        no, at = no[kept], at[kept].astype(np.int32)
        order = np.argsort(no, kind="stable")
        no = no[order]
        first = np.flatnonzero(np.diff(no, prepend=-1))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(no)), pa.int32()), pa.array(at[order]))
        return pa.table({"no": pa.array(no[first]), "last": lists})

    return _meeting(sets, buckets, found, "no long, last array<int>", part).groupBy("no").agg(F.flatten(F.collect_list("last")).alias("last"))


def missed(texts: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the roots of any two texts that are alike and have different ones.

    texts: fp, text_key, root, each text once; sets: see _by_text. In whatever order all shingles are put, one of the first of a text is
    among the first of each that is like it. The order is by hash, but shingles that many texts have come last, so texts with a passage in common
    meet only if such passages are most of what they hold. Where all texts that meet have one root, nothing is compared. No group is capped.
    Shingles of whole texts are neither stored nor shuffled row by row: see _meeting.
    """
    name = ["fp", "text_key"]
    known = texts.join(sets.select(*name, "no", "n"), name)
    known = stored(known.join(known.groupBy("root").agg(F.min("no").alias("root_no")).hint("merge"), "root"), "numbered")
    size = known.agg(F.sum("n")).first()[0] or 0
    buckets = min(1 + size // BLOCK, 1 << 14)
    whole = sets.select(*name, "shingles", "low").join(known.select(*name, "no", "root_no"), name)
    late = [stored(_last(whole, buckets, i), "late") for i in range(PARTS)]
    last = reduce(DataFrame.unionAll, late).groupBy("no").agg(F.flatten(F.collect_list("last")).alias("last"))
    last = known.select(*name, "no").join(last.hint("merge"), "no").drop("no")
    first = stored(_prefixes(whole.join(last.hint("merge"), name, "left"), similarity), "prefixes")

    def crossing(begin, token, no, at, several):
        kept = np.repeat(several, np.diff(begin, append=len(token)))
        return pa.table({"token": pa.array(token[kept]), "no": pa.array(no[kept]), "at": pa.array(at[kept])})

    dropped(*late)
    met = _meeting(first, buckets, crossing, "token long, no long, at long")
    each = stored(met.join(known.select("no", *name, "root", "n").hint("merge"), "no").drop("no"), "meeting")
    dropped(first, known)
    other = each.select("token", *(F.col(c).alias(f"c_{c}") for c in (*name, "root", "n", "at"))).withColumnRenamed("c_text_key", "c_key")
    most = F.lit(1) + F.least(F.expr("n - at - 1"), F.expr("c_n - c_at - 1"))  # in common, if this is the first token that is
    could = most >= F.lit(similarity) * (F.col("n") + F.col("c_n") - most) - 1e-6
    pairs = each.join(other, "token").where(F.expr("root < c_root")).where(could)
    asked = stored(pairs.select(*PAIR, "root", "c_root").distinct(), "asked")
    found = stored(_verified(asked.select(*PAIR), sets, similarity).join(asked, list(PAIR)).select(F.col("root").alias("a"), F.col("c_root").alias("b")).distinct(), "missed")
    dropped(each, asked)
    return found


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2) -> DataFrame:
    """Each row's fingerprint and component.

    docs: doc_id, text; other columns are ignored. Words are lower-cased (A-Z); a text of fewer
    than size words is one shingle, one without words or null has fingerprint zero and links
    like any other. Returns doc_id, fp (long), fingerprint (16 hexadecimal digits) and
    component_id: the least doc_id that links reach, null ids left out (null if there are no
    others). Repeated rows get a row each. An empty table gives none.
    """
    rows = stored(fingerprints(docs, size), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _rooted(classes, distance)
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(roots, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words: int = 5, similarity: float = 0.8, size: int = 3, distance: int = 2) -> DataFrame:
    """docs without near duplicates, same columns: of each component the row of the least doc_id stays (null is the largest).

    Linked are texts whose sets of shingles of so many words have that similarity or more (see similar), and those whose
    SimHash over shingles of size words differs by distance bits or fewer. Rows are told apart by a
    128-bit hash of all their columns, so unlike texts may share a doc_id or have none. Of a component's rows
    of that doc_id the least hash stays, of equal rows one. A null or empty text is like others without words. Columns of any name
    stay. An empty table gives none.
    """
    own = renamed(docs)
    values = [*own.columns, *(F.col(c).isNull() for c in own.columns)]  # a hash leaves nulls out
    keyed = own.select("*", *(F.xxhash64(F.lit(i), *values).alias(k) for i, k in enumerate(ROW)))
    doc_id = own.columns[docs.columns.index("doc_id")]
    spark = docs.sparkSession
    with tidy(spark):
        banded = _banded(keyed.withColumnRenamed(doc_id, "doc_id"), size, words, ROW)
        rows = stored(banded.drop("minima", "shingles", "low"), "fingerprints")
        name, sets = _by_text(banded.where("minima is not null"))  # read again: together they would lie on disks twice
        classes = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW)).alias("least"))
        rooted = stored(_rooted(classes, distance, similar(rows.where("size(bands) > 0"), sets, similarity)), "rooted")
        texts = stored(rows.where("size(bands) > 0").select("fp", "text_key").distinct().join(rooted.select("fp", "root"), "fp"), "known")
        dropped(rows)
        more = components(missed(texts, sets, similarity))
        spark.sql(f"DROP TABLE {name}")
        dropped(sets, texts)
        rooted = rooted.join(more.select(F.col("a").alias("root"), F.col("b").alias("first")), "root", "left").withColumn("root", F.coalesce("first", "root"))
        stay = rooted.groupBy("root").agg(F.min("least").alias("least")).select(*(f"least.{k}" for k in ROW))
        stay = stored(stay, "stay")
    return keyed.join(stay, list(ROW)).dropDuplicates(list(ROW)).select(*own.columns).toDF(*docs.columns)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
