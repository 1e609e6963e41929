"""Substring dedup of byte strings: suffixes sorted by hashes.

Two suffixes are compared by their longest common extension, found by binary search over
prefix polynomial hashes; a merge sort on that comparison orders the suffixes that can be
equal for `window` bytes, in batches of whole keys; equal neighbours are verified byte by byte.
Regions that claim to repeat another one whole are sorted with it in the same way, each as one suffix.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from helixtab.llm import _hashes as H
from helixtab.llm._repeats import ALL_BITS, BLOCK, Tokens, cut, first_of, place, size_of
from helixtab.llm._util import read, to_rows, with_variant

#: Bytes of regions sorted at a time; bytes of the k-gram that routes a window.
BATCH, GRAM = 400_000, 24
#: Claims that are sorted at a time, and those of one stretch of a long text.
CLAIMS, STRETCH = 20_000, 5_000


def extension(p: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many values from a and from b on are the same, most at most."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = H.stretch(p, a, a + mid) == H.stretch(p, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def merge_sort(at: np.ndarray, group: np.ndarray, data: np.ndarray, p: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The order of suffixes by their first bytes (length of them, the same in a group) within each group; stable.

    at: where suffixes start in data; group: numbers, not descending. All runs of a level
    are merged at once: each suffix finds its rank in the run beside its own by binary search.
    """
    head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.concatenate((head, [len(at)])))
    begin, total = np.repeat(head, size), np.repeat(size, size)
    whole = H.stretch(p, at, at + length)
    order = np.arange(len(at))
    run = 1
    while True:
        place_of = np.flatnonzero(total > run)
        if not len(place_of):
            return order
        g, n = begin[place_of], total[place_of]
        nth = (place_of - g) // run
        beside = nth ^ 1
        other = g + beside * run
        low, high = np.zeros(len(g), np.int64), np.clip(n - beside * run, 0, run)
        mine, right = order[place_of], nth & 1
        while len(act := np.flatnonzero(low < high)):
            mid = (low[act] + high[act]) >> 1
            x, y = order[other[act] + mid], mine[act]
            sign = np.zeros(len(act), np.int64)
            differ = np.flatnonzero(whole[x] != whole[y])
            a, b, most = at[x[differ]], at[y[differ]], length[x[differ]]
            same = np.minimum(extension(p, a, b, most), most - 1)
            sign[differ] = np.sign(data[a + same].astype(np.int64) - data[b + same])
            before = sign < right[act]
            low[act] = np.where(before, mid + 1, low[act])
            high[act] = np.where(before, high[act], mid)
        to = g + (nth >> 1) * 2 * run + (place_of - g - nth * run) + low
        order[to] = mine
        run *= 2


def suffix_sort(window: int, k: int, bits: int = ALL_BITS):
    def settle(key, doc, where, context):
        text = b"".join(context)
        data = np.frombuffer(text, np.uint8)
        keys, docs, places = np.array(key, np.int64), np.array(doc, np.int64), np.array(where, np.int64)
        length = np.array([len(c) for c in context], np.int64)
        base = np.cumsum(length) - length
        size = length - window + 1
        own = np.repeat(np.arange(len(key)), size)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        at = base[own] + nth
        p = H.prefix(H.byte_values(data))
        gram = (H.mix(H.every(p, k)) & np.uint64(bits)).view(np.int64)
        hits = np.flatnonzero(gram == np.repeat(keys, length)[: len(gram)])
        offset = hits[np.minimum(np.searchsorted(hits, at), len(hits) - 1)] - at
        # equal windows share a key and the place of its k-gram in them
        first = np.lexsort((places[own], docs[own], offset, keys[own]))
        at, own, nth, offset = at[first], own[first], nth[first], offset[first]
        group = np.cumsum(np.concatenate(([0], (keys[own][1:] != keys[own][:-1]) | (offset[1:] != offset[:-1]))))
        order = merge_sort(at, group, data, p, np.full(len(at), window))
        a, b = order[:-1], order[1:]
        near = np.flatnonzero((group[a] == group[b]) & (H.stretch(p, at[a], at[a] + window) == H.stretch(p, at[b], at[b] + window)))
        view = np.lib.stride_tricks.sliding_window_view(data, window)
        same = np.zeros(len(near), bool)
        for i in range(0, len(near), 50_000):
            part = near[i : i + 50_000]
            same[i : i + 50_000] = (view[at[a[part]]] == view[at[b[part]]]).all(axis=1)
        later = order[near[same] + 1]
        if not same.all():  # collisions: groups that have one, by their text
            broken = np.unique(group[a[near[~same]]])
            later = later[~np.isin(group[later], broken)]
            seen: set[tuple[int, bytes]] = set()
            more = []
            for i in np.flatnonzero(np.isin(group, broken)).tolist():
                one = int(group[i]), text[at[i] : at[i] + window]
                if one in seen:
                    more.append(i)
                seen.add(one)
            later = np.concatenate((later, np.array(more, np.int64)))
        later = later[np.lexsort((nth[later], own[later]))]
        o, s = own[later], nth[later]
        cuts = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)))) if len(o) else np.zeros(0, np.int64)
        many = np.diff(np.concatenate((cuts, [len(o)])))
        w = places[o[cuts]]
        return list(zip(docs[o[cuts]].tolist(), place(w >> 42, first_of(w) + s[cuts], many).tolist(), strict=True))

    return settle


def claimed(window: int):
    """Regions that claim to repeat others, sorted with these as suffixes; equal neighbours are compared byte by byte."""

    def confirm(documents):
        held: list[set[int]] = [set() for _ in documents]
        units: list[tuple] = []

        def flush():
            if not units:
                return
            blocks = {(rep_doc, rep >> 42, first_of(rep) // BLOCK[False] + j): part for _, _, claims in units for _, rep_doc, rep, parts in claims for j, part in enumerate(parts)}
            laid, start, parts = {}, 0, []
            for name in sorted(blocks):  # so that a region's blocks lie side by side
                laid[name] = start
                parts.append(blocks[name])
                start += len(blocks[name])
            rows = []  # (region's document, region, whether it is a claim, start, document, place)
            for i, tokens, claims in units:
                low = first_of(claims[0][0])
                high = max(first_of(c[0]) + size_of(c[0]) for c in claims) + window - 1
                parts.append(tokens.stretch(low, high))
                rows += [(rep_doc, rep, 1, start + first_of(where) - low, i, where) for where, rep_doc, rep, _ in claims]
                start += len(parts[-1])
            for rep_doc, rep in {r[:2] for r in rows}:
                at = first_of(rep)
                rows.append((rep_doc, rep, 0, laid[rep_doc, rep >> 42, at // BLOCK[False]] + at % BLOCK[False], -1, 0))
            rows.sort(key=lambda r: r[:3])
            text = b"".join(parts)
            data = np.frombuffer(text, np.uint8)
            p = H.prefix(H.byte_values(data))
            rep_doc, rep, claim, at, i, where = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            group = np.cumsum(np.concatenate(([0], (rep_doc[1:] != rep_doc[:-1]) | (rep[1:] != rep[:-1]))))
            length = size_of(rep) + window - 1
            order = merge_sort(at, group, data, p, length)
            starts, ends = at[order].tolist(), (at + length)[order].tolist()
            of = group[order].tolist()
            run, runs = 0, [0]
            for j in range(1, len(order)):
                if of[j] != of[j - 1] or text[starts[j] : ends[j]] != text[starts[j - 1] : ends[j - 1]]:
                    run += 1
                runs.append(run)
            runs = np.array(runs)
            region = np.zeros(group[-1] + 1, np.int64)
            own = claim[order] == 0
            region[group[order[own]]] = runs[own]
            for j in order[~own & (runs == region[group[order]])].tolist():
                held[i[j]].add(int(where[j]))
            units.clear()

        n = 0
        for i, (_, tokens, claims) in enumerate(documents):
            for at in range(0, len(claims), STRETCH):
                units.append((i, tokens, claims[at : at + STRETCH]))
                n += len(units[-1][2])
                if n >= CLAIMS:
                    flush()
                    n = 0
        flush()
        return [(h, list(h)) for h in held]

    return confirm


def dedup(docs: DataFrame, window: int = 100, with_text: bool = True, hash_bits: int = ALL_BITS) -> DataFrame:
    """Remove the bytes of strings of window bytes that also start earlier.

    Earlier: in a smaller doc_id, or before in the same document. docs: doc_id, text; other
    columns are ignored. Returns, for each row, doc_id, n_bytes, n_removed, n_spans, kept_hex
    (null without with_text) and kept_sha256. A null text is empty; a null doc_id counts as larger than all
    others; texts that share a doc_id count in their own order, equal rows as one document.
    Bytes are judged on the input. An empty table gives none. Very long texts are searched in pieces that overlap.
    hash_bits: the bits of a routing hash that are used; fewer make collisions, which the result does not depend on.
    """
    rows, repeated = with_variant(docs)

    def finish(tokens: Tokens, gone: np.ndarray):
        kept = np.frombuffer(tokens.text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        return tokens.n, int(gone.sum()), spans, kept.hex() if with_text else None, hashlib.sha256(kept).hexdigest()

    k = min(GRAM, window)
    schema = "n_bytes long, n_removed long, n_spans long, kept_hex string, kept_sha256 string"
    out = cut(rows, window, k, False, suffix_sort(window, k, hash_bits), BATCH, claimed(window), finish, schema, hash_bits)
    if repeated:
        out = rows.join(out, ["doc", "variant"])
    return to_rows(docs, out, repeated)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: Every window of every document side by side: for small tables.
OP5_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1 AS again FROM s),
g AS (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 < i, true) AS fresh FROM f WHERE again),
r AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM g) GROUP BY doc_id, n),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM r),
o AS (SELECT p.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || any_value(substr(h, 2 * e + 1)) AS kept
  FROM p JOIN d ON p.doc_id = d.doc_id JOIN (SELECT doc_id, max(b) AS e FROM r GROUP BY doc_id) l ON l.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, length(h)::BIGINT // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN o ON d.doc_id = o.doc_id
"""
