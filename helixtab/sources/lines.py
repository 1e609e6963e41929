"""Lines of text files, plain, gzipped or in gzip blocks, in stretches that tasks read on their own."""

from __future__ import annotations

import zlib

from pyspark.sql.datasource import InputPartition

from helixtab.sources import bgzf

#: Bytes of a task; text that is handed on at once, in whole lines.
SPLIT, BATCH = 32 << 20, 4 << 20


class Stretch(InputPartition):
    """Lines of a file from first on, up to last: places in it (kind bytes or blocks), virtual offsets (kind records), or all (kind gzip)."""

    def __init__(self, path: str, kind: str, first: int, last: int):
        super().__init__(None)
        self.path, self.kind, self.first, self.last = path, kind, first, last


def is_blocked(path: str) -> bool:
    fs, at = bgzf.located(path)
    with fs.open_input_file(at) as f:
        return bool(bgzf.block_size(f.read_at(64, 0)))


def planned(path: str, size: int, split: int = SPLIT) -> list[Stretch]:
    packed = path.endswith((".gz", ".bgz"))
    if packed and not is_blocked(path):
        return [Stretch(path, "gzip", 0, size)]
    return [Stretch(path, "blocks" if packed else "bytes", at, min(size, at + split)) for at in range(0, max(size, 1), split)]


def _bytes(part: Stretch):
    """(text, place from which the next line end is the last, None for none); a line is its stretch's in which it starts, that is after the line end before."""
    fs, path = bgzf.located(part.path)
    with fs.open_input_file(path) as f:
        at, size = max(0, part.first - 1), f.size()
        while at < size:
            data = f.read_at(min(BATCH, size - at), at)
            yield data, max(0, part.last - 1 - at) if part.last - 1 < at + len(data) else None
            at += len(data)


def _blocks(part: Stretch):
    """The same of blocks. What ends at the first line end of the first block that isn't the stretch's is its own, so it begins after that of its first."""
    reader = bgzf.Reader(part.path)
    at = reader.first_block(part.first)
    while at < reader.size and (at < part.last or part.first < part.last):
        text, after = reader.text(at)
        if text:
            yield text, 0 if at >= part.last else None
        at = after
    reader.close()


def _records(part: Stretch):
    reader = bgzf.Reader(part.path)
    at, skip = part.first >> 16, part.first & 0xFFFF
    while at < part.last >> 16 or at == part.last >> 16 and part.last & 0xFFFF:
        text, after = reader.text(at)
        yield text[skip : part.last & 0xFFFF if at == part.last >> 16 else None], None
        at, skip = after, 0
    reader.close()


def _gzip(part: Stretch):
    fs, path = bgzf.located(part.path)
    with fs.open_input_file(path) as f:
        unpack = zlib.decompressobj(31)
        while data := f.read(1 << 20):
            while data:
                yield unpack.decompress(data), None
                data, unpack = (unpack.unused_data, zlib.decompressobj(31)) if unpack.eof else (b"", unpack)


def read(part: Stretch):
    """The lines of a stretch, a few megabytes at a time; each ends with a line end."""
    drop = part.kind in ("bytes", "blocks") and part.first > 0
    held = b""
    for text, stop in {"bytes": _bytes, "blocks": _blocks, "records": _records, "gzip": _gzip}[part.kind](part):
        begin = 0
        if drop:
            end = text.find(b"\n")
            if end < 0:
                continue
            if stop is not None and end >= stop:
                return
            drop, begin = False, end + 1
        last = text.find(b"\n", stop) if stop is not None else -1
        held += text[begin:] if last < 0 else text[begin : last + 1]
        if last >= 0:
            break
        if len(held) >= BATCH and (end := held.rfind(b"\n") + 1):
            yield held[:end]
            held = held[end:]
    if held:
        yield held if held.endswith(b"\n") else held + b"\n"
