"""Exact word numbers over UTF-8 bytes (numpy): hashes sort the words, bytes decide."""

from __future__ import annotations

import io

import numpy as np
import xxhash

from helixtab.llm import _hashes as H

#: Bytes in words of letters, digits and whatever isn't ASCII.
IN_TERM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
#: A-Z to a-z, all else as it is.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def lowered(text: bytes) -> np.ndarray:
    return LOWER[np.frombuffer(text, np.uint8)]


def bounds(data: np.ndarray, inside: np.ndarray = IN_TERM) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that inside holds."""
    edge = np.diff(np.concatenate(([False], inside[data], [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def equal(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the stretches of a equal those of b, pair by pair, by their bytes."""
    size = a_end - a_start
    same = size == b_end - b_start
    pairs = np.flatnonzero(same & (size > 0))
    ends = np.cumsum(size[pairs])
    done = 0
    while done < len(pairs):  # a million bytes or a word at a time
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + (1 << 20), "right")))
        some = pairs[done:upto]
        n = size[some]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        unlike = a[np.repeat(a_start[some], n) + place] != b[np.repeat(b_start[some], n) + place]
        if unlike.any():
            same[some] = ~np.logical_or.reduceat(unlike, first)
        done = upto
    return same


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """64 bits for each word, given in order; salt 0 is the fast way, others are for sets of words in which that has a collision."""
    if not salt:
        out = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):  # a quarter of a million bytes or a word at a time
            upto = max(at + 1, int(np.searchsorted(end, start[at] + (1 << 18))))
            first = start[at]
            out[at:upto] = H.mix(H.stretch(H.prefix(H.BYTE_VALUE[data[first : end[upto - 1]]]), start[at:upto] - first, end[at:upto] - first))
            at = upto
        return out
    return np.array([xxhash.xxh64_intdigest(data[s:e].tobytes(), salt) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.uint64)


class Dictionary:
    """The different words of data[start:end], in order of their hashes, and where each first is; ids: the number of each word."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.salt = 0
        while True:
            value = hashes(data, start, end, self.salt)
            order = np.argsort(value)
            value = value[order]
            head = np.ones(len(value), bool)
            head[1:] = value[1:] != value[:-1]
            nth = np.cumsum(head) - 1
            first = order[head]
            self.ids = np.empty(len(order), np.int64)
            self.ids[order] = nth
            if equal(data, start, end, data, start[first][self.ids], end[first][self.ids]).all():
                break
            self.salt += 1
        self.hash, self.data, self.start, self.end = value[head], data, start[first], end[first]

    def __len__(self) -> int:
        return len(self.hash)

    def packed(self) -> dict[str, np.ndarray]:
        """What find() needs."""
        n = self.end - self.start
        last = np.cumsum(n)
        at = np.repeat(self.start - (last - n), n) + np.arange(int(n.sum()))
        return {"salt": np.array(self.salt), "hash": self.hash, "words": self.data[at], "word_end": last.astype(np.int32)}


def find(known: dict[str, np.ndarray], data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The number that a packed dictionary has for each word of data, -1 for others."""
    if not len(start) or not len(known["hash"]):
        return np.full(len(start), -1)
    value = hashes(data, start, end, int(known["salt"]))
    at = np.minimum(np.searchsorted(known["hash"], value), len(known["hash"]) - 1)
    last = known["word_end"].astype(np.int64)
    first = np.concatenate(([0], last[:-1]))
    same = (known["hash"][at] == value) & equal(data, start, end, known["words"], first[at], last[at])
    return np.where(same, at, -1)


def to_bytes(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def from_bytes(blob) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as found:
        return {k: found[k] for k in found.files}
