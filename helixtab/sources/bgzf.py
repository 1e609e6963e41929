"""Blocked gzip files and the binning index over them, on any file system that pyarrow opens.

A block holds up to 64 kB, so a file can be read from any block on. A virtual offset is a block's place in the file, shifted by
16 bits, and a place in the block. The index keeps, for each reference, stretches of virtual offsets by bin (five levels, 8 to 1)
and, for each 16 kb of reference, the least offset of what overlaps them.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow.fs as pafs

#: Fixed values of the format: bytes of text in a block at most, the empty block that ends a file, bits of the finest bin, levels.
TEXT = 65280
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
FINEST, LEVELS = 14, 5


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def listed(path: str, suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files in a folder that end so, by name."""
    fs, at = located(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.Directory:
        found = [f for f in fs.get_file_info(pafs.FileSelector(at, recursive=True)) if f.is_file and f.path.endswith(suffixes) and not f.base_name.startswith(("_", "."))]
    elif info.is_file:
        found = [info]
    else:
        raise FileNotFoundError(path)
    scheme = re.match(r"(\w+://[^/]*)", path)
    lead = scheme[1] if scheme and not path.startswith("file:") else ""
    return sorted((f"{lead}/{f.path.lstrip('/')}" if lead else f.path, f.size) for f in found)


def whole(path: str) -> bytes | None:
    """A small file's content, None if there is no such file."""
    fs, at = located(path)
    if not fs.get_file_info(at).is_file:
        return None
    with fs.open_input_file(at) as f:
        return f.read()


def block(text: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = packer.compress(text) + packer.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


def block_size(data: bytes, at: int = 0) -> int:
    """Bytes of the block that starts at a place in data, 0 if none does (or its head isn't whole)."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or len(data) < at + 18:
        return 0
    end = at + 12 + struct.unpack_from("<H", data, at + 10)[0]
    at += 12
    while at + 6 <= min(end, len(data)):
        a, b, n, size = struct.unpack_from("<2BHH", data, at)
        if (a, b, n) == (66, 67, 2):
            return size + 1
        at += 4 + n
    return 0


class Reader:
    """Text of blocks, one after the other, with where each came from."""

    def __init__(self, path: str):
        fs, at = located(path)
        self.file = fs.open_input_file(at)
        self.size = self.file.size()
        self.held, self.at = b"", 0

    def _bytes(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.held):
            self.held, self.at = self.file.read_at(max(n, 1 << 20), at), at
        return self.held[at - self.at : at - self.at + n]

    def first_block(self, at: int) -> int:
        """Where the first block that starts at a place or later is; a block is one if another, or the end, follows it."""
        while at < self.size:
            data = self._bytes(at, min(1 << 17, self.size - at))
            place = data.find(b"\x1f\x8b\x08\x04")
            if place < 0:
                at += max(1, len(data) - 3)
                continue
            at += place
            size = block_size(self._bytes(at, min(64, self.size - at)))
            if size and (at + size == self.size or at + size < self.size and block_size(self._bytes(at + size, min(64, self.size - at - size)))):
                return at
            at += 1
        return self.size

    def text(self, at: int) -> tuple[bytes, int]:
        """The text of the block at a place, and where the next one is."""
        size = block_size(self._bytes(at, min(64, self.size - at)))
        if not size:
            raise ValueError(f"no block at {at}")
        data = self._bytes(at, size)
        skip = 12 + struct.unpack_from("<H", data, 10)[0]
        return zlib.decompress(data[skip:-8], -15), at + size

    def close(self) -> None:
        self.file.close()


class Writer:
    def __init__(self, path: str):
        fs, at = located(path)
        self.file, self.held, self.at = fs.open_output_stream(at, compression=None), bytearray(), 0

    def tell(self) -> int:
        return self.at << 16 | len(self.held)

    def write(self, data: bytes) -> None:
        """A record; it begins a block if it doesn't fit the one begun."""
        if self.held and len(self.held) + len(data) > TEXT:
            self.flush()
        while len(data) > TEXT:
            self.held += data[:TEXT]
            data = data[TEXT:]
            self.flush()
        self.held += data

    def write_all(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Records that lie end to end, as write() does them, with their virtual offsets and those after them."""
        first, last, i = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64), 0
        starts = np.concatenate(([0], ends))[:-1]
        while i < len(ends):
            begin = int(starts[i])
            k = int(np.searchsorted(ends, begin + TEXT - len(self.held), "right"))
            if k > i:
                own = self.tell() - begin
                first[i:k], last[i:k] = own + starts[i:k], own + ends[i:k]
                self.held += data[begin : int(ends[k - 1])]
                i = k
            elif self.held:
                self.flush()
            else:
                first[i] = self.tell()
                self.write(data[begin : int(ends[i])])
                last[i] = self.tell()
                i += 1
        return first, last

    def flush(self) -> None:
        if self.held:
            packed = block(bytes(self.held))
            self.file.write(packed)
            self.at += len(packed)
            self.held.clear()

    def close(self) -> None:
        self.flush()
        self.file.write(END)
        self.file.close()


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    for level in range(LEVELS, 0, -1):
        shift = FINEST + 3 * (LEVELS - level)
        if start >> shift == max(start, end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def bins_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """bin_of() of many."""
    out, last = np.zeros(len(start), np.int64), np.maximum(start, end - 1)
    for level in range(1, LEVELS + 1):
        shift = FINEST + 3 * (LEVELS - level)
        out = np.where(start >> shift == last >> shift, ((1 << 3 * level) - 1) // 7 + (start >> shift), out)
    return out


class Index:
    """For each reference: stretches by bin, and least offsets by 16 kb."""

    def __init__(self, references: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(references)]
        self.linear: list[list[int]] = [[] for _ in range(references)]

    def add(self, reference: int, start: int, end: int, first: int, last: int) -> None:
        """A record over [start, end) of a reference, from one virtual offset to another; records come in order."""
        own = self.bins[reference].setdefault(bin_of(start, end), [])
        if own and own[-1][1] >> 16 == first >> 16:
            own[-1][1] = last
        else:
            own.append([first, last])
        linear = self.linear[reference]
        for i in range(start >> FINEST, (max(start, end - 1) >> FINEST) + 1):
            if i >= len(linear):
                linear.extend([0] * (i + 1 - len(linear)))
            linear[i] = linear[i] or first

    def add_all(self, reference: np.ndarray, start: np.ndarray, end: np.ndarray, bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """add() of many records in order; those without a reference (-1) are left out. Records of one bin that begin in one block are a stretch."""
        placed = reference >= 0
        reference, start, end, bins, first, last = (x[placed] for x in (reference, start, end, bins, first, last))
        if not len(reference):
            return
        keys = np.stack((reference, bins, first >> 16))
        change = np.concatenate(([True], (np.diff(keys[:, order := np.lexsort((np.arange(len(bins)), keys[2], keys[1], keys[0]))]) != 0).any(axis=0)))
        at = np.flatnonzero(change)
        ends = np.maximum.reduceat(last[order], at)
        for r, b, x, y in zip(reference[order][at].tolist(), bins[order][at].tolist(), first[order][at].tolist(), ends.tolist(), strict=True):
            own = self.bins[r].setdefault(b, [])
            if own and own[-1][1] >> 16 == x >> 16:
                own[-1][1] = y
            else:
                own.append([x, y])
        spans = np.stack((reference, start >> FINEST, np.maximum(start, end - 1) >> FINEST))
        _, firsts = np.unique(spans, axis=1, return_index=True)
        for i in sorted(firsts.tolist()):
            r, low, high = spans[:, i].tolist()
            linear = self.linear[r]
            linear.extend([0] * (high + 1 - len(linear)))
            for k in range(low, high + 1):
                linear[k] = linear[k] or int(first[i])

    def chunks(self, reference: int, start: int, end: int) -> list[tuple[int, int]]:
        """Stretches of virtual offsets that hold all records over [start, end)."""
        linear, found = self.linear[reference], []
        window = start >> FINEST
        least = linear[window] if window < len(linear) else 0  # 0 where nothing overlaps: the bins alone tell
        top = 1 << FINEST + 3 * LEVELS
        for level in range(LEVELS + 1):
            shift, base = FINEST + 3 * (LEVELS - level), ((1 << 3 * level) - 1) // 7
            low, high = base + (start >> shift), base + (min(end, top) - 1 >> shift)
            found += [c for b, own in self.bins[reference].items() if low <= b <= high for c in own if c[1] > least]
        out: list[list[int]] = []
        for a, b in sorted((max(c[0], least), c[1]) for c in found):
            if out and a >> 16 <= out[-1][1] >> 16:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [tuple(c) for c in out]

    def body(self) -> bytes:
        out = [struct.pack("<i", len(self.bins))]
        for bins, linear in zip(self.bins, self.linear, strict=True):
            out.append(struct.pack("<i", len(bins)))
            for b, own in sorted(bins.items()):
                out.append(struct.pack("<Ii", b, len(own)) + b"".join(struct.pack("<QQ", *c) for c in own))
            out.append(struct.pack("<i", len(linear)) + struct.pack(f"<{len(linear)}Q", *linear))
        return b"".join(out)

    @staticmethod
    def parse(data: bytes, at: int, references: int) -> Index:
        out = Index(references)
        for ref in range(references):
            (n,) = struct.unpack_from("<i", data, at)
            at += 4
            for _ in range(n):
                b, many = struct.unpack_from("<Ii", data, at)
                at += 8
                values = struct.unpack_from(f"<{2 * many}Q", data, at)
                at += 16 * many
                if b < ((1 << 3 * (LEVELS + 1)) - 1) // 7:  # others hold counts
                    out.bins[ref][b] = [list(c) for c in zip(values[::2], values[1::2], strict=True)]
            (n,) = struct.unpack_from("<i", data, at)
            out.linear[ref] = list(struct.unpack_from(f"<{n}Q", data, at + 4))
            at += 4 + 8 * n
        return out
