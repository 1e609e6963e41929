"""Substring dedup of passages by words: repeated-phrase automata.

Recurring passages are found by hash, compiled into Aho-Corasick automata (pyahocorasick, words
as letters), one for each shard, and the texts that can hold them are streamed through their
shard's automaton, which finds every occurrence. Two kinds of shard: regions of documents that differ
under a key (settle), with every window that recurs among them as a phrase; and documents with
the regions that they claim to repeat whole (confirm), each region a phrase. Letters are
numbers given to words by a dictionary of the shard, so an occurrence is one of the words themselves.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession

from helixtab.llm import _hashes as H
from helixtab.llm._repeats import ALL_BITS, BLOCK, Tokens, cut, first_of, place, size_of
from helixtab.llm._util import read, to_rows, with_variant

#: Bytes of regions for one automaton; words in the k-gram that routes a window.
SHARD, GRAM = 400_000, 12
#: Claims that one automaton serves at most, and that one stretch of a long text is streamed for.
CLAIMS, STRETCH = 10_000, 2_000


class Phrases:
    """An automaton over phrases (tuples of letters), with a value for each: the least given."""

    def __init__(self):
        self.number: dict[tuple[int, ...], int] = {}
        self.least: list[int] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)

    def add(self, letters: tuple[int, ...], value: int) -> int:
        n = self.number.setdefault(letters, len(self.least))
        if n == len(self.least):
            self.least.append(value)
            self.automaton.add_word(letters, n)
        self.least[n] = min(self.least[n], value)
        return n

    def occurrences(self, letters: tuple[int, ...]):
        """(first letter, number of the phrase, its length)."""
        if not self.least:
            return
        if self.automaton.kind != ahocorasick.AHOCORASICK:
            self.automaton.make_automaton()
            self.length = [0] * len(self.least)
            for word, n in self.number.items():
                self.length[n] = len(word)
        for end, n in self.automaton.iter(letters):
            yield end - self.length[n] + 1, n, self.length[n]


def _recurring(letters: list[np.ndarray], doc: np.ndarray, window: int, bits: int) -> list[tuple[int, int, int]]:
    """(text, start, least doc) for each different window that is in more than one document."""
    values = [H.mix(x.astype(np.uint64) * np.uint64(H.BASE)) for x in letters]
    hashes = [H.mix(H.every(H.prefix(v), window)) & np.uint64(bits) for v in values]
    own = np.repeat(np.arange(len(letters)), [len(h) for h in hashes])
    at = np.concatenate([np.arange(len(h)) for h in hashes])
    every = np.concatenate(hashes)
    order = np.lexsort((doc[own], every))
    h, own, at = every[order], own[order], at[order]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    size = np.diff(np.concatenate((start, [len(h)])))
    recurs = doc[own[start + size - 1]] > doc[own[start]]
    if not recurs.any():
        return []
    head, some = np.repeat(start, size), np.repeat(recurs, size)
    base = np.cumsum([0, *(len(x) for x in letters[:-1])])
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate(letters), window)
    where = base[own] + at
    unlike = np.zeros(len(h), bool)
    todo = np.flatnonzero(some & (head != np.arange(len(h))))
    for i in range(0, len(todo), 50_000):
        part = todo[i : i + 50_000]
        unlike[part] = (windows[where[part]] != windows[where[head[part]]]).any(axis=1)
    broken = np.isin(head, head[unlike])  # hashes that unlike windows share
    good = start[recurs & ~broken[start]]
    out = list(zip(own[good].tolist(), at[good].tolist(), doc[own[good]].tolist(), strict=True))
    by_text: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(broken & some).tolist():
        first = by_text.setdefault(windows[where[i]].tobytes(), [i, int(doc[own[i]]), int(doc[own[i]])])
        first[2] = max(first[2], int(doc[own[i]]))
    return out + [(int(own[i]), int(at[i]), least) for i, least, most in by_text.values() if most > least]


def automata(window: int, bits: int = ALL_BITS):
    def settle(key, doc, where, context):
        ids: dict[bytes, int] = {}
        letters = [tuple([ids.setdefault(w, len(ids) + 1) for w in c.split()]) for c in context]
        phrases = Phrases()
        for i, at, least in _recurring([np.array(x, np.int64) for x in letters], np.array(doc, np.int64), window, bits):
            phrases.add(letters[i][at : at + window], least)
        found = []
        for d, at, word in zip(doc, where, letters, strict=True):
            hits = [s for s, n, _ in phrases.occurrences(word) if d > phrases.least[n]]
            run = 0
            for i, s in enumerate(hits):
                if i + 1 == len(hits) or hits[i + 1] != s + 1:
                    found.append((d, place(at >> 42, first_of(at) + hits[run], i + 1 - run)))
                    run = i + 1
        return found

    return settle


def passages(window: int):
    """Documents with their claims, streamed through automata of the regions that they claim."""

    def confirm(documents):
        held: list[set[int]] = [set() for _ in documents]
        places: list[list[int]] = [[] for _ in documents]
        units: list[tuple] = []

        def flush():
            ids: dict[bytes, int] = {}
            blocks: dict[bytes, tuple[int, ...]] = {}
            phrases, number = Phrases(), {}

            def letters_of(block: bytes) -> tuple[int, ...]:
                if (known := blocks.get(block)) is None:
                    known = blocks[block] = tuple([ids.setdefault(w, len(ids) + 1) for w in block.split()])
                return known

            for _, _, _, claims in units:
                for _, rep_doc, rep, parts in claims:
                    if (rep_doc, rep) not in number:
                        skip, n = first_of(rep) % BLOCK[True], size_of(rep) + window - 1
                        number[rep_doc, rep] = phrases.add(sum(map(letters_of, parts), ())[skip : skip + n], rep_doc)
            for i, doc, tokens, claims in units:
                low = first_of(claims[0][0])
                high = max(first_of(c[0]) + size_of(c[0]) for c in claims) + window - 1
                letters = tuple([ids.get(w, 0) for w in tokens.stretch(low, high).split()])
                variant = claims[0][0] >> 42
                hits = set()
                for s, n, length in phrases.occurrences(letters):
                    if doc > phrases.least[n]:
                        hits.add((low + s, n))
                        places[i].append(place(variant, low + s, length - window + 1))
                held[i].update(where for where, rep_doc, rep, _ in claims if (first_of(where), number[rep_doc, rep]) in hits)
            units.clear()

        for i, (doc, tokens, claims) in enumerate(documents):
            for at in range(0, len(claims), STRETCH):
                units.append((i, doc, tokens, claims[at : at + STRETCH]))
                if sum(len(u[3]) for u in units) >= CLAIMS:
                    flush()
        flush()
        return list(zip(held, places, strict=True))

    return confirm


def dedup(docs: DataFrame, window: int = 50, with_text: bool = True, hash_bits: int = ALL_BITS) -> DataFrame:
    """Remove the words of windows that also start in a document with a smaller doc_id.

    docs: doc_id, text; other columns are ignored. Returns, for each row, doc_id, n_words,
    n_removed, kept (text: the words kept, joined by one space; null without with_text) and kept_sha256. A null text
    has no words; a null doc_id counts as larger than all others; rows with one doc_id do
    not remove from each other. Words are judged on the input. An empty table gives none. Very long texts
    are searched in pieces that overlap. hash_bits: the bits of a routing hash that are used; fewer make
    collisions, which the result does not depend on.
    """
    rows, repeated = with_variant(docs)

    def finish(tokens: Tokens, gone: np.ndarray):
        kept = b" ".join(tokens.text[s:e] for s, e in zip(tokens.start[~gone].tolist(), tokens.end[~gone].tolist(), strict=True))
        return tokens.n, int(gone.sum()), kept.decode() if with_text else None, hashlib.sha256(kept).hexdigest()

    out = cut(rows, window, min(GRAM, window), True, automata(window, hash_bits), SHARD, passages(window), finish, "n_words long, n_removed long, kept string, kept_sha256 string", hash_bits)
    if repeated:
        out = rows.join(out, ["doc", "variant"])
    return to_rows(docs, out, repeated)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Every window of every document side by side: for small tables.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT x, min(doc_id) AS least FROM s GROUP BY x),
g AS (SELECT DISTINCT doc_id, i + j AS k FROM (SELECT doc_id, i FROM s JOIN f USING (x) WHERE doc_id > least), range(50) AS r(j)),
k AS (SELECT d.doc_id, u.k, w[u.k] AS word FROM d, (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k FROM d) u WHERE u.doc_id = d.doc_id),
o AS (SELECT k.doc_id, count(*) - count(g.k) AS n_kept, string_agg(word, ' ' ORDER BY k.k) FILTER (g.k IS NULL) AS kept FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.k = g.k GROUP BY k.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN o ON d.doc_id = o.doc_id
"""
